import glob
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodgegrid.llm.token_order import op4_training_order, plan_layout, read_shards, sequences, shard_index, write_shards
from lodgegrid.llm.tokens import encoder

from .conftest import FOLDER


@pytest.fixture
def stored(small, tmp_path):
    """The small table in several files, each a split of its own."""
    small.repartition(5, "doc_id").write.parquet(str(tmp_path / "docs"))
    return str(tmp_path / "docs")


@pytest.fixture
def one_file_a_split(spark):
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))
    yield
    spark.conf.unset("spark.sql.files.openCostInBytes")


def expected_records(docs, length):
    """The padded sequences of each split, in order."""
    out = {}
    for r in docs.select(F.spark_partition_id().alias("split"), "text").collect():
        out.setdefault(r.split, []).append(encoder().closed_ids(r.text))
    cut = {}
    for split, parts in out.items():
        ids = np.concatenate(parts).astype("<u2")
        ids = np.concatenate([ids, np.full(-len(ids) % length, 50_256, "<u2")])
        cut[split] = ids.reshape(-1, length)
    return cut


def test_shards_hold_every_sequence_in_slot_order(spark, stored, tmp_path, one_file_a_split):
    docs, path = spark.read.parquet(stored), str(tmp_path / "shards")
    layout = write_shards(docs, path, sequence=512, shard=256)
    assert len(layout.splits) > 1
    wanted = {}
    for split, _, _, base in layout.splits:
        for i, ids in enumerate(expected_records(docs, 512)[split]):
            wanted[base + i] = ids.tolist()
    rows = read_shards(spark, path, layout).collect()
    found = {int(layout.number_of(np.array([r.slot]))[0]): np.frombuffer(r.ids, "<u2").tolist() for r in rows}
    assert len(rows) == len(found) and found == wanted
    order = [(r.shard, r.byte_offset) for r in sorted(rows, key=lambda r: r.slot)]
    assert order == sorted(order)
    for r in rows:
        assert r.slot // 256 == r.shard and int(layout.slot_of(layout.number_of(np.array([r.slot])))[0]) == r.slot
    for shard in {r.shard for r in rows}:
        file, = glob.glob(os.path.join(path, f"shard={shard}", "part-*"))
        own = sorted((r for r in rows if r.shard == shard), key=lambda r: r.slot)
        assert os.path.getsize(file) == layout.stride * len(own)
        with open(file, "rb") as f:
            f.seek(own[-1].byte_offset + 8)
            assert f.read(1024) == own[-1].ids
    later = read_shards(spark, path, layout, from_slot=300).collect()
    assert sorted(r.slot for r in later) == sorted(r.slot for r in rows if r.slot >= 300)
    # steps are the ranks of the slots, and reading goes on from any of them
    ranked = sorted(rows, key=lambda r: r.slot)
    assert [r.step for r in ranked] == list(range(len(rows)))
    index = shard_index(spark, path, layout)
    assert index.steps == len(rows)
    for step in (0, 1, len(rows) // 2, len(rows) - 1):
        found = read_shards(spark, path, layout, from_step=step).collect()
        assert sorted(r.step for r in found) == list(range(step, len(rows)))
        record = ranked[step]
        assert index.shard_of(step) == record.shard
        assert (step - index.first_step(record.shard)) * layout.stride == record.byte_offset
    assert read_shards(spark, path, layout, from_step=len(rows)).count() == 0
    assert read_shards(spark, path, layout, from_slot=layout.numbers).count() == 0


def test_query_covers_every_id(spark):
    rows = op4_training_order(spark, FOLDER).collect()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert len({r.slot for r in rows}) == len(rows) == sum(map(len, expected_records(docs, 2048).values()))


def test_changed_splits_are_noticed(spark, stored):
    docs = spark.read.parquet(stored)
    layout = plan_layout(docs, 512, 64, 2, 1)
    with pytest.raises(Exception, match="other documents"):
        sequences(docs.filter("doc_id > 3"), layout).count()


def test_odd_rows(spark, make_docs, odd_rows, tmp_path):
    docs = make_docs(odd_rows, ["shard", "slot", "ids", "value"])
    layout = write_shards(docs, str(tmp_path / "s"), sequence=64, shard=1000)
    rows = read_shards(spark, str(tmp_path / "s"), layout).collect()
    assert len(rows) == sum(map(len, expected_records(docs, 64).values()))
    layout = write_shards(make_docs([]), str(tmp_path / "e"))
    assert layout.numbers == 0 and read_shards(spark, str(tmp_path / "e"), layout).count() == 0


def test_a_large_shard_is_read_in_several_ranges(spark, stored, tmp_path):
    path = str(tmp_path / "one")
    layout = write_shards(spark.read.parquet(stored), path, sequence=512, shard=1 << 20)
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("mapreduce.input.fileinputformat.split.maxsize", str(layout.stride * 10 + 7))
    try:
        read = read_shards(spark, path, layout, from_step=15)
        assert layout.shards == 1 and read.rdd.getNumPartitions() > 3
        rows = sorted(read.collect(), key=lambda r: r.step)
    finally:
        hadoop.unset("mapreduce.input.fileinputformat.split.maxsize")
    assert [r.byte_offset for r in rows] == [i * layout.stride for i in range(15, 15 + len(rows))]
    assert len({r.slot for r in rows}) == len(rows) == shard_index(spark, path, layout).steps - 15


def test_a_torn_shard_is_noticed(spark, stored, tmp_path):
    path = str(tmp_path / "torn")
    layout = write_shards(spark.read.parquet(stored), path, sequence=512, shard=1 << 20)
    file, = glob.glob(os.path.join(path, "shard=0", "part-*"))
    with open(file, "ab") as f:
        f.write(b"x")
    with pytest.raises(RuntimeError, match="whole records"):
        shard_index(spark, path, layout)
