"""What jobs of several writes leave on disk while they run."""

import glob
import os
import tempfile
import time

from pyspark.sql import functions as F

from lodgegrid.plans import queries, tpch_mapping as tm
from lodgegrid.session import cut_lineage
from lodgegrid.sinks import store

SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark):
    top = spark.conf.get("spark.local.dir", tempfile.gettempdir())
    return set(glob.glob(f"{top}/**/blockmgr-*/*/shuffle_*.data", recursive=True))


def left_after(spark, before, seconds=20):
    """Shuffle files that are still there once removal, which runs beside the job, has had time."""
    end = time.time() + seconds
    while (left := shuffle_files(spark) - before) and time.time() < end:
        time.sleep(0.2)
    return left


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    usual = spark.conf.get(SETTING, None)
    before = shuffle_files(spark)
    rows = spark.range(20_000).select((F.col("id") % 500).alias("k"), "id").repartition(3, "k")
    kept = [rows.groupBy("k").agg(F.sum("id").alias("total"))]
    kept.append(cut_lineage(kept[0], "test"))
    store.replace_partitions(kept[0], str(tmp_path / "by_key"), ["k"])
    store.replace_table(kept[0], str(tmp_path / "table"))
    store.write_version(kept[0], str(tmp_path / "versions"))
    assert not left_after(spark, before)
    assert spark.conf.get(SETTING, None) == usual
    # what was written is read as often as one likes
    assert kept[1].count() == kept[1].count() == kept[0].count() == 500


def test_slices_hold_whole_months_and_all_rows(spark, monkeypatch):
    rows = [(m, str(i)) for i, m in enumerate([199501, 199502, 199503, 199504, None, 199601, 199602] * 30)]
    delivered = spark.createDataFrame(rows, "snapshot int, id string").repartition(4)
    monkeypatch.setattr(queries, "_SLICE_BYTES", 500)
    before = set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/delivered-*"))
    found = [[tuple(r) for r in part.collect()] for part in queries._month_slices(delivered)]
    assert len(found) > 3
    assert sorted(sum(found, []), key=repr) == sorted(((m, i) for m, i in rows), key=repr)
    months = [{m for m, _ in part} for part in found]
    assert sum(map(len, months)) == len(set().union(*months)) == 7
    # the rows kept for the slices are gone
    assert set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/delivered-*")) == before


def test_month_files_are_the_same_in_slices(spark, monkeypatch):
    rows = [(m, str(i), f"host, {i}", None if i % 3 else "") for i, m in enumerate([199501, 199506, 199507, 199612] * 25)]
    schema = "snapshot int, id string, host_name string, price string"
    monkeypatch.setattr(tm, "delivered_listings", lambda spark, folder: spark.createDataFrame(rows, schema).repartition(3))

    def files():
        folder = queries._month_files(spark, "", columns=["price", "id", "beds", "host_name"])
        return {name: sorted(open(os.path.join(folder, name)).read().splitlines()) for name in store.child_names(spark, folder)}

    whole = files()
    monkeypatch.setattr(queries, "_SLICE_BYTES", 300)
    assert files() == whole
    assert sorted(whole) == ["0_01_1995.csv", "0_06_1995.csv", "0_07_1995.csv", "0_12_1996.csv"]
    assert all(len(lines) == 26 and "price,id,beds,host_name" in lines for lines in whole.values())
