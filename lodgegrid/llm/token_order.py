"""Training-order materialisation: sequences in a keyed pseudorandom order, in fixed-stride shards.

Each input split is one stream of ids, every document closed by the end id, cut into sequences of
``SEQUENCE`` ids of which the last is padded. A split's sequences are numbered from a base that leaves
room for as many as its text bytes could give (an id stands for at least one byte), so numbers are known
before anything is encoded and ids are encoded and shuffled once. A keyed Feistel permutation with
cycle-walking over all numbers gives every sequence its global slot. Numbers that no sequence uses leave
slots empty; the training order is the order of the slots that are used, and ``step`` counts it without
gaps.

Ranges of ``SHARD`` slots are shards. A shard is one file of records in slot order, each of the same
number of bytes: the slot, the ids, and the line feed with which Spark's text writer ends it. The files'
lengths tell how many records each shard holds, so a step's shard is found by bisection over the shards
and its place in the file by multiplication. Files are read in ranges of whole records, whatever their
size; a reader that goes on from a step or a slot opens no earlier shard.

The second pass over the splits checks that each holds as many documents and bytes as the first counted
and fails otherwise.

Cases
-----
* NULL and empty texts are the end id alone. ``doc_id`` is not read, so NULL and repeated ids and
  repeated rows are documents like others.
* No documents, no sequences and no shards.
* Columns beyond ``text`` are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from lodgegrid.session import scratch_path

from .common import documents, small_batches
from .feistel import permute, unpermute
from .tokens import VOCABULARY, encoder

SEQUENCE = 2048
SHARD = 16_384
PAD_ID = 50_256
WIDTH = 2
KEY = 11
HELD_SEQUENCES = 256


@dataclass(frozen=True)
class Layout:
    """How sequences are numbered and laid out; ``splits`` holds (split, documents, bytes, base)."""

    splits: tuple[tuple[int, int, int, int], ...]
    numbers: int
    sequence: int
    shard: int
    width: int
    key: int

    @property
    def shards(self) -> int:
        return math.ceil(self.numbers / self.shard)

    @property
    def ids_bytes(self) -> int:
        return self.sequence * self.width

    @property
    def stride(self) -> int:
        return 8 + self.ids_bytes + 1

    def slot_of(self, number: np.ndarray) -> np.ndarray:
        return permute(number, self.numbers, self.key)

    def number_of(self, slot: np.ndarray) -> np.ndarray:
        return unpermute(slot, self.numbers, self.key)


def plan_layout(docs: DataFrame, sequence: int, shard: int, width: int, key: int) -> Layout:
    """Bases from each split's documents and bytes: one row per split reaches the driver."""
    counted = docs.select(F.spark_partition_id().alias("split"), F.octet_length("text").alias("size")).groupBy(
        "split").agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))
    splits, base = [], 0
    for r in counted.orderBy("split").collect():
        splits.append((r.split, r.documents, r.bytes, base))
        base += math.ceil((r.documents + r.bytes) / sequence)
    return Layout(tuple(splits), base, sequence, shard, width, key)


def sequences(docs: DataFrame, layout: Layout, vocabulary: str = VOCABULARY) -> DataFrame:
    """``shard, slot, record``: every sequence of ``docs`` with its slot in front."""
    known = {split: (documents, size, base) for split, documents, size, base in layout.splits}
    length, kind = layout.sequence, f"<u{layout.width}"

    def rows(blocks: np.ndarray, first: int) -> pd.DataFrame:
        slots = layout.slot_of(np.arange(first, first + len(blocks), dtype=np.int64))
        return pd.DataFrame({
            "shard": slots // layout.shard, "slot": slots,
            "record": [int(s).to_bytes(8, "little") + b.tobytes() for s, b in zip(slots, blocks)]})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split, tokens = TaskContext.get().partitionId(), encoder(vocabulary)
        n_docs, n_bytes, number = known.get(split, (0, 0, 0))
        held: list[np.ndarray] = []
        waiting = 0
        for frame in frames:
            for text in frame["text"]:
                ids = tokens.closed_ids(text)
                n_docs, n_bytes = n_docs - 1, n_bytes - len((text or "").encode("utf-8", "surrogatepass"))
                held.append(ids)
                waiting += len(ids)
                if waiting >= HELD_SEQUENCES * length:
                    ids = np.concatenate(held).astype(kind)
                    whole = len(ids) // length
                    yield rows(ids[:whole * length].reshape(whole, length), number)
                    held, waiting, number = [ids[whole * length:]], len(ids) - whole * length, number + whole
        if (n_docs, n_bytes) != (0, 0):
            raise RuntimeError(f"split {split} has other documents than when the splits were counted")
        if waiting:
            ids = np.concatenate(held).astype(kind)
            ids = np.concatenate([ids, np.full(-len(ids) % length, PAD_ID, dtype=kind)])
            yield rows(ids.reshape(-1, length), number)

    return small_batches(docs).select("text").mapInPandas(run, "shard long, slot long, record binary")


def write_shards(docs: DataFrame, path: str, sequence: int = SEQUENCE, shard: int = SHARD, key: int = KEY,
                 width: int = WIDTH, vocabulary: str = VOCABULARY) -> Layout:
    """The shards of ``docs`` below ``path``, one file in ``shard=k`` each; ``docs`` reads files."""
    layout = plan_layout(docs, sequence, shard, width, key)
    dealt = sequences(docs, layout, vocabulary).repartitionById(max(layout.shards, 1), F.col("shard").cast("int"))
    (dealt.sortWithinPartitions("shard", "slot").select("shard", F.col("record").cast("string").alias("value"))
     .write.partitionBy("shard").option("lineSep", "\n").option("compression", "none").text(path))
    return layout


@dataclass(frozen=True)
class ShardIndex:
    """The shards that hold records, in order, the step of each one's first record, and all steps."""

    shards: np.ndarray
    first_steps: np.ndarray
    steps: int

    def first_step(self, shard: int) -> int:
        return int(self.first_steps[np.searchsorted(self.shards, shard)])

    def shard_of(self, step: int) -> int:
        """The shard that holds ``step``; one beyond the last where there is no such step."""
        if step >= self.steps:
            return int(self.shards[-1]) + 1 if len(self.shards) else 0
        return int(self.shards[np.searchsorted(self.first_steps, max(step, 0), side="right") - 1])


def shard_index(spark: SparkSession, path: str, layout: Layout) -> ShardIndex:
    """The index of the shards below ``path`` from their files' lengths: two numbers per shard reach the driver."""
    if not layout.numbers:
        return ShardIndex(np.zeros(0, np.int64), np.zeros(0, np.int64), 0)
    files = spark.read.format("binaryFile").option("basePath", path).load(path)
    sizes = files.groupBy(F.col("shard").cast("long").alias("shard")).agg(
        F.sum("length").alias("size")).orderBy("shard").collect()
    broken = [r.shard for r in sizes if r["size"] % layout.stride]
    if broken:
        raise RuntimeError(f"shards {broken} do not hold whole records")
    records = np.array([r["size"] // layout.stride for r in sizes], dtype=np.int64)
    ends = np.cumsum(records)
    return ShardIndex(np.array([r.shard for r in sizes], dtype=np.int64), ends - records, int(ends[-1]))


def read_shards(spark: SparkSession, path: str, layout: Layout, from_slot: int = 0, from_step: int = 0) -> DataFrame:
    """``slot, shard, step, byte_offset, ids`` of the records from ``from_slot`` and ``from_step`` on."""
    schema = "slot long, shard long, step long, byte_offset long, ids binary"
    index = shard_index(spark, path, layout)
    first = max(from_slot // layout.shard, index.shard_of(from_step))
    wanted = index.shards[index.shards >= first].tolist()
    if not wanted:
        return spark.createDataFrame([], schema)
    stride, end = layout.stride, 8 + layout.ids_bytes
    known = dict(zip(index.shards.tolist(), index.first_steps.tolist()))

    def run(records: Iterator[tuple[int, bytes]]) -> Iterator[tuple]:
        for place, record in records:
            slot = int.from_bytes(record[:8], "little")
            shard = slot // layout.shard
            step = known[shard] + place
            if slot >= from_slot and step >= from_step:
                yield slot, shard, step, place * stride, bytes(record[8:end])

    # all shards by pattern, or the later ones by name
    folders = f"{path}/shard=*" if len(wanted) == len(index.shards) else ",".join(f"{path}/shard={n}" for n in wanted)
    # Spark's input format for files of fixed-length records; its keys are their numbers in the file
    records = spark.sparkContext.newAPIHadoopFile(
        folders, "org.apache.spark.input.FixedLengthBinaryInputFormat", "org.apache.hadoop.io.LongWritable",
        "org.apache.hadoop.io.BytesWritable",
        conf={"org.apache.spark.input.FixedLengthBinaryInputFormat.recordLength": str(stride)}, batchSize=HELD_SEQUENCES)
    return spark.createDataFrame(records.mapPartitions(run), schema, verifySchema=False)


def op4_training_order(spark: SparkSession, folder: str) -> DataFrame:
    """``number, slot, shard, step, byte_offset, ids_crc32`` of every record, read back from the shards."""
    path = scratch_path(spark, "token-shards")
    layout = write_shards(documents(spark, folder), path)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield frame.assign(number=layout.number_of(frame["slot"].to_numpy()))

    columns = "slot long, shard long, step long, byte_offset long, ids_crc32 long"
    return read_shards(spark, path, layout).select(
        "slot", "shard", "step", "byte_offset", F.crc32("ids").alias("ids_crc32"),
    ).mapInPandas(run, f"{columns}, number long")
