"""Document fingerprints from closed syncmers.

A k-mer of code points is an anchor if the smallest of its inner s-mers, by hash, is the first or the
last. Whether it is depends on the k-mer alone, so the same passage gives the same anchors wherever it
stands. A fingerprint is the sequence of a text's distinct anchors, each with its hash and the place
where it first stands. Of texts with more than ``SKETCH`` of them it keeps the anchors with hashes in the
lowest half, quarter or eighth of their range, so it grows with the text and two fingerprints can be
compared on the smaller share. Texts with up to ``SKETCH`` anchors are compared exactly.

Fingerprints are matched by position: anchors of one hash are paired, and a pair counts if the pair
before or after it is shifted by the same distance, give or take ``DRIFT`` code points. A common passage
is a stretch of such pairs, while a k-mer that two texts share by chance counts for nothing. The likeness
is the number of pairs that count over the number of different anchors in both.
``anchors`` gives all anchors of a text, ``anchor_table`` those of all documents.

Each document is also compared to an edited text, its last quarter replaced by the beginning of the
next document, and to that next document. The next document is found by range: documents go to tasks by
ranges of ``doc_id`` and are sorted there, and each range also gets the first document of the one after.
Texts are shuffled once.

Cases
-----
* A NULL text is empty. A text shorter than a k-mer has one anchor, itself; an empty text has none, and
  two texts without anchors are alike by 1, an empty and another one by 0. Where a fingerprint has one
  anchor, there is no other pair to ask for and the hash decides.
* A NULL ``doc_id`` sorts first. Rows that share a ``doc_id`` are ordered by their texts; repeated rows
  follow each other. A single document is its own next.
* No documents, no rows. Columns beyond ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import documents, id_carried, id_restored, small_batches

K = 20
S = 11
SKETCH = 256
LEVELS = 3
DRIFT = 64
CHUNK = 1 << 18

_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _C2
    return x ^ (x >> np.uint64(29))


def _rolled(codes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all windows of ``width`` codes."""
    n = len(codes) - width + 1
    total = np.zeros(n, dtype=np.uint64)
    for i in range(width):
        total = total * _C1 + codes[i:n + i]
    return _mix(total + np.uint64(width))


def anchors(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Positions and 32-bit hashes of the text's closed syncmers, in order."""
    text = text or ""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    if len(codes) < K:
        own = _rolled(codes.astype(np.uint64), len(codes)) ^ np.uint64(len(codes))
        return np.zeros(1, np.int64), (own >> np.uint64(32)).astype(np.uint32)
    places, hashes = [], []
    for low in range(0, len(codes) - K + 1, CHUNK):
        part = codes[low:low + CHUNK + K - 1].astype(np.uint64)
        inner = _rolled(part, S)
        n, span = len(part) - K + 1, K - S + 1
        lowest = inner[:n].copy()
        for i in range(1, span):
            np.minimum(lowest, inner[i:n + i], out=lowest)
        at = np.flatnonzero((inner[:n] == lowest) | (inner[span - 1:n + span - 1] == lowest))
        places.append(at + low)
        # only the anchors' own k-mers are hashed
        total = np.zeros(len(at), dtype=np.uint64)
        for i in range(K):
            total = total * _C1 + part[at + i]
        hashes.append((_mix(total + np.uint64(K)) >> np.uint64(32)).astype(np.uint32))
    return np.concatenate(places), np.concatenate(hashes)


class Fingerprint(NamedTuple):
    """Distinct anchors with hashes under ``2 ** (32 - level)``, in order of their first places."""

    level: int
    hashes: np.ndarray
    places: np.ndarray

    def at_level(self, level: int) -> Fingerprint:
        if level == self.level:
            return self
        kept = self.hashes < (1 << (32 - level))
        return Fingerprint(level, self.hashes[kept], self.places[kept])


def sketch(text: str | None) -> Fingerprint:
    """The text's fingerprint."""
    places, hashes = anchors(text)
    distinct, first = np.unique(hashes, return_index=True)
    level = 0
    while len(distinct) >> level > SKETCH and level < LEVELS:
        level += 1
    kept = np.sort(first[:np.searchsorted(distinct, 1 << (32 - level))])
    return Fingerprint(level, hashes[kept], places[kept])


def matched(x: Fingerprint, y: Fingerprint) -> tuple[float, int]:
    """Likeness of two fingerprints, and the code points of ``x`` in their longest common stretch."""
    if not len(x.hashes) or not len(y.hashes):
        return float(len(x.hashes) == len(y.hashes)), 0
    level = max(x.level, y.level)
    x, y = x.at_level(level), y.at_level(level)
    _, in_x, in_y = np.intersect1d(x.hashes, y.hashes, assume_unique=True, return_indices=True)
    if not len(in_x):
        return 0.0, 0
    order = np.argsort(in_x)
    at = x.places[in_x[order]]
    joined = np.abs(np.diff(y.places[in_y[order]] - at)) <= DRIFT
    counts = np.append(joined, False) | np.insert(joined, 0, False)
    if min(len(x.hashes), len(y.hashes)) == 1:
        counts[:] = True
    pairs = int(counts.sum())
    breaks = np.flatnonzero(~joined)
    starts, ends = np.append(0, breaks + 1), np.append(breaks, len(at) - 1)
    longest = np.where(counts[starts], at[ends] - at[starts] + K, 0).max()
    return pairs / (len(x.hashes) + len(y.hashes) - pairs), int(longest)


def likeness(x: Fingerprint, y: Fingerprint) -> float:
    """Share of the anchors of both texts that stand in common passages."""
    return matched(x, y)[0]


def encoded(print_: Fingerprint) -> str:
    """Level, hashes, and the steps from place to place: a byte each, 255 for those that follow in full."""
    steps = np.diff(print_.places, prepend=0)
    return base64.b64encode(
        bytes([print_.level]) + len(steps).to_bytes(4, "little") + print_.hashes.astype("<u4").tobytes()
        + np.minimum(steps, 255).astype("u1").tobytes() + steps[steps >= 255].astype("<u4").tobytes()).decode()


def decoded(value: str) -> Fingerprint:
    """The fingerprint that ``encoded`` wrote."""
    content = base64.b64decode(value)
    n = int.from_bytes(content[1:5], "little")
    hashes = np.frombuffer(content, "<u4", n, 5)
    steps = np.frombuffer(content, "u1", n, 5 + 4 * n).astype(np.int64)
    steps[steps == 255] = np.frombuffer(content, "<u4", -1, 5 + 5 * n)
    return Fingerprint(content[0], hashes.astype(np.uint32), np.cumsum(steps))


def anchor_table(docs: DataFrame) -> DataFrame:
    """``doc_id, position, anchor``: all anchors of all documents."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for doc_id, no_id, text in zip(frame["doc_id"], frame["_no_id"], frame["text"]):
                places, hashes = anchors(text)
                yield pd.DataFrame({"doc_id": [doc_id] * len(places), "_no_id": no_id,
                                    "position": places, "anchor": hashes.astype(np.int64)})

    return id_restored(id_carried(docs.select("doc_id", "text")).mapInPandas(
        run, f"doc_id {kind}, _no_id boolean, position long, anchor long"))


def id_ranges(docs: DataFrame, ranges: int) -> list[float]:
    """Inner bounds of about equal ranges of ``doc_id``."""
    steps = [i / ranges for i in range(1, ranges)]
    numbers = docs.select(F.col("doc_id").cast("double").alias("number"))
    return sorted(set(numbers.approxQuantile("number", steps, 0.1 / ranges))) if steps else []


def with_next(docs: DataFrame, ranges: int) -> DataFrame:
    """Documents by range of ``doc_id``: ``place`` is the range and ``edge`` marks the one after its last."""
    spark = docs.sparkSession
    bounds = id_ranges(docs, ranges)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))).alias("number"))
    if bounds:
        placed = Bucketizer(
            splits=[float("-inf"), *bounds, float("inf")], inputCol="number", outputCol="place").transform(rows)
    else:
        placed = rows.withColumn("place", F.lit(0.0))
    placed = placed.withColumn("place", F.col("place").cast("int"))
    # one row per range: its first id, NULL before all others
    firsts = placed.groupBy("place").agg(
        F.min(F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id")).alias("first")).orderBy("place").collect()
    if not firsts:
        return placed.select("place", "doc_id", "text", F.lit(0).alias("edge"))
    target = [(r.first.doc_id, firsts[i - 1].place) for i, r in enumerate(firsts)]
    kind = docs.schema["doc_id"].dataType.simpleString()
    edges = spark.createDataFrame(target, f"edge_id {kind}, edge_place int")
    edge_rows = placed.join(F.broadcast(edges), F.col("doc_id").eqNullSafe(F.col("edge_id")))
    # of rows that share the first id only the first by text is needed
    edge_rows = edge_rows.groupBy("edge_place").agg(F.min(F.struct("text", "doc_id")).alias("row")).select(
        F.col("edge_place").alias("place"), F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"),
        F.lit(1).alias("edge"))
    return placed.select("place", "doc_id", "text", F.lit(0).alias("edge")).unionByName(edge_rows)


def edited_text(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the beginning of ``following``."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def fingerprints(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` and, in code
    points, the longest stretch in common with the edited and the next text, ``common_edited, common_next``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    ranges = ranges or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = with_next(small_batches(docs), ranges)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before = None
        for frame in frames:
            out = []
            for doc_id, no_id, text, edge in zip(frame["doc_id"], frame["_no_id"], frame["text"], frame["edge"]):
                own = sketch(text)
                if before is not None:
                    last_id, last_no_id, last_text, last = before
                    edited = edited_text(last_text, text)
                    changed = sketch(edited) if edited != last_text else last
                    (near_edited, in_edited), (near_next, in_next) = matched(last, changed), matched(last, own)
                    out.append((
                        last_id, last_no_id, len(last_text),
                        hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                        encoded(last), encoded(changed), near_edited, near_next,
                        # a text under a k-mer is shorter than its anchor
                        min(in_edited, len(last_text)), min(in_next, len(last_text))))
                before = None if edge else (doc_id, no_id, text, own)
            yield pd.DataFrame(out, columns=[
                "doc_id", "_no_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
                "near_next", "common_edited", "common_next"])

    ordered = placed.repartitionById(ranges, F.col("place")).sortWithinPartitions("place", "edge", "doc_id", "text")
    return id_restored(id_carried(ordered).mapInPandas(
        run, f"doc_id {kind}, _no_id boolean, n_chars long, edited_sha256 string, fingerprint string, "
             "edited_fingerprint string, near_edited double, near_next double, common_edited long, common_next long"))


def op6_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints(documents(spark, folder))
