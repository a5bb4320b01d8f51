"""Line dedup on levelled sorted runs of line hashes.

The index of all lines seen so far is a set of runs, each a table of (line hash, first document) in
buckets of the hash, a file sorted by hash per bucket; a hash is in one run only. A new batch takes the
smallest document per hash, is moved to the buckets and sorted once, merge-anti-joins one run after the
other, and what is new becomes a run of level 0. Once a level holds ``fanout`` runs they are merged, two
at a time, into one of the next level. The runs' side of these joins is read bucket by bucket in its
stored order: nothing of the index is shuffled or sorted when a batch comes (``tests/llm/test_lines.py``
holds the plans to that). The list of current runs is itself a versioned table, so an index can be opened
again by a later load.

A document loses a line if the index names another document as its first. Texts move once: the
positions to drop, found on hashes alone, are joined to them.

Cases
-----
* NULL and empty texts are one empty line. Keys under ``MIN_KEY`` code points are never dropped.
* Rows with one ``doc_id`` are one document, so they do not take lines from each other; if their texts
  differ each keeps its own positions. Repeated rows give repeated results.
* A NULL ``doc_id`` sorts after all others.
* Lines are matched by 128-bit hashes of their keys.
* Columns beyond ``doc_id`` and ``text`` are not read by the operator.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lodgegrid.session import cut_lineage, scratch_path
from lodgegrid.sinks.bucketed import register_bucketed
from lodgegrid.sinks.store import read_version, versions, write_version

from .common import SPACE_CHARS, ascii_lower, boxed, documents, let, small_table, unboxed

MIN_KEY = 10
BATCHES = 4
FANOUT = 3


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(SPACE_CHARS)))


@contextmanager
def stored_order(spark: SparkSession, buckets: int):
    """Plans made inside shuffle into ``buckets`` and take bucketed tables, of one file per bucket, as sorted."""
    settings = {"spark.sql.legacy.bucketedTableScan.outputOrdering": "true", "spark.sql.shuffle.partitions": buckets}
    own = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, str(value))
        yield
    finally:
        for name, value in own.items():
            spark.conf.set(name, value)


class LineRuns:
    """The index below ``root``; opening it again finds the runs written before.

    A new index has ``buckets`` buckets, or as many as the session has shuffle partitions; one that is
    opened again keeps its own.
    """

    def __init__(self, spark: SparkSession, root: str, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.root, self.fanout = spark, root, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.columns = ""
        self.runs: list[tuple[int, str]] = []
        if versions(spark, f"{root}/runs"):
            # a handful of rows: under ``fanout`` runs per level
            state = read_version(spark, f"{root}/runs").collect()
            self.runs = [(r.level, r.path) for r in state]
            self.buckets, self.columns = state[0].buckets, state[0].columns

    def table(self) -> DataFrame:
        """``line_hash, first_doc`` of all lines seen."""
        return self.spark.read.schema(self.columns).parquet(*[path for _, path in self.runs])

    def add(self, keys: DataFrame) -> None:
        """Enter a batch of ``line_hash, doc_id`` rows; hashes seen before keep their first document."""
        if not self.runs:
            self.columns = f"line_hash binary, first_doc {keys.schema['doc_id'].dataType.simpleString()}"
        with stored_order(self.spark, self.buckets):
            self.runs.append((0, self._write(self.unseen(keys))))
            self._compact()
        state = small_table(
            self.spark, [(level, path, self.buckets, self.columns) for level, path in self.runs],
            "level int, path string, buckets int, columns string")
        write_version(state.coalesce(1), f"{self.root}/runs")

    def unseen(self, keys: DataFrame) -> DataFrame:
        """``line_hash, first_doc`` of the batch's lines that no run holds."""
        new = keys.groupBy("line_hash").agg(F.min("doc_id").alias("first_doc"))
        for _, path in self.runs:
            # an anti-join by another name: as such it would be moved before the aggregation, and all
            # rows of a frequent line would be shuffled to it
            run = self._open(path).select("line_hash", F.lit(True).alias("seen"))
            new = new.join(run.hint("merge"), "line_hash", "left").filter(F.col("seen").isNull()).drop("seen")
        return new

    def merged(self, x: str, y: str) -> DataFrame:
        """The rows of two runs, which share no hash, in the order of both."""
        left, right = self._open(x), self._open(y).withColumnsRenamed({"line_hash": "other", "first_doc": "other_doc"})
        return left.join(right.hint("merge"), F.col("line_hash") == F.col("other"), "full").select(
            F.coalesce("line_hash", "other").alias("line_hash"),
            F.when(F.col("other").isNull(), F.col("first_doc")).otherwise(F.col("other_doc")).alias("first_doc"))

    def _compact(self) -> None:
        level = 0
        while len(own := [run for run in self.runs if run[0] == level]) >= self.fanout:
            paths = [path for _, path in own]
            while len(paths) > 1:
                # the two that came last are the smallest, where batches are alike
                paths[-2:] = [self._write(self.merged(*paths[-2:]))]
            self.runs = [r for r in self.runs if r not in own] + [(level + 1, paths[0])]
            level += 1

    def _write(self, rows: DataFrame) -> str:
        """The rows, which are in their buckets' partitions, as a run: one sorted file per bucket."""
        name = f"run_{uuid.uuid4().hex}"
        path = f"{self.root}/{name}"
        rows.write.bucketBy(self.buckets, "line_hash").sortBy("line_hash").option("path", path).saveAsTable(name)
        # the catalog's entry goes, the files stay
        self.spark.sql(f"DROP TABLE {name}")
        return path

    def _open(self, path: str) -> DataFrame:
        """A run as a bucketed table; its catalog entry is only needed until it is resolved."""
        name = f"open_{uuid.uuid4().hex}"
        register_bucketed(self.spark, name, path, self.columns, "line_hash", self.buckets)
        run = self.spark.table(name)
        run.schema  # resolves it
        self.spark.sql(f"DROP TABLE {name}")
        return run


def line_table(docs: DataFrame, min_key: int = MIN_KEY) -> DataFrame:
    """``doc_id, text_hash, pos, line_hash`` of every line whose key is long enough."""
    lines = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"),
        F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("pos", "line"))
    return (
        lines.withColumn("key", line_key(F.col("line"))).filter(F.char_length("key") >= min_key)
        .select("doc_id", "text_hash", "pos", F.unhex(F.md5("key")).alias("line_hash"))
    )


def dropped_lines(docs: DataFrame, batches: int = BATCHES, min_key: int = MIN_KEY) -> DataFrame:
    """``doc_id, text_hash, drop``: positions of the lines each document loses.

    The documents are entered in ``batches`` ranges of ascending ``doc_id``, so the first document
    that the index holds for a line is the smallest.
    """
    spark = docs.sparkSession
    keys = cut_lineage(line_table(docs, min_key), "lines")
    index = LineRuns(spark, scratch_path(spark, "line-runs"))
    steps = [i / batches for i in range(1, batches)]
    numbers = docs.select(F.col("doc_id").cast("double").alias("n"))
    edges = sorted(set(numbers.approxQuantile("n", steps, 0.01))) if steps else []
    place = F.col("doc_id").cast("double")
    for low, high in zip([None, *edges], [*edges, None]):
        part = keys
        if low is not None:
            part = part.filter((place >= low) | F.col("doc_id").isNull() if high is None else place >= low)
        if high is not None:
            part = part.filter(place < high)
        index.add(part)
    owned = keys.join(index.table(), "line_hash").filter(
        F.col("first_doc").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("first_doc")))
    return owned.groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("drop"))


def dedup_lines(docs: DataFrame, batches: int = BATCHES, min_key: int = MIN_KEY) -> DataFrame:
    """``doc`` (the row of ``docs``), ``n_lines``, ``n_dropped`` and ``kept`` (the text left)."""
    drops = dropped_lines(docs, batches, min_key).withColumnsRenamed(
        {"doc_id": "drop_id", "text_hash": "drop_hash"})
    rows = boxed(docs, F.col("doc_id").alias("id"), F.xxhash64("text").alias("own_hash"),
                 F.coalesce("text", F.lit("")).alias("own_text"))
    joined = rows.join(
        drops, F.col("id").eqNullSafe(F.col("drop_id")) & (F.col("own_hash") == F.col("drop_hash")), "left")
    lines = F.split("own_text", "\n")
    drop = F.coalesce("drop", F.array().cast("array<int>"))
    kept = let(lines, lambda every: F.array_join(
        F.transform(
            F.array_except(F.sequence(F.lit(0), F.size(every) - 1), drop),
            lambda i: F.get(every, i)),
        "\n"))
    return joined.select(
        "doc", F.size(lines).alias("n_lines"), F.size(drop).alias("n_dropped"),
        F.when(F.size(drop) > 0, kept).otherwise(F.col("own_text")).alias("kept"))


def without_repeated_lines(docs: DataFrame, batches: int = BATCHES, min_key: int = MIN_KEY) -> DataFrame:
    """``docs`` with what is left of their texts; ``n_chars``, where there is one, follows."""
    new = {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.char_length("kept").cast(docs.schema["n_chars"].dataType)
    return unboxed(dedup_lines(docs, batches, min_key), docs.columns, **new)


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_lines(documents(spark, folder).select("doc_id", "text")).select(
        F.col("doc.doc_id").alias("doc_id"), F.col("n_lines").cast("long").alias("n_lines"),
        F.col("n_dropped").cast("long").alias("n_dropped"), F.sha2("kept", 256).alias("kept_sha256"))


OP5_SQL = """
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (
    SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM docs),
keyed AS (
    SELECT doc_id, pos, line,
           translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines),
owners AS (
    SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10
    GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
judged AS (
    SELECT k.*, o.first_doc IS NOT NULL AND o.first_doc <> k.doc_id AS dropped
    FROM keyed k LEFT JOIN owners o ON k.key = o.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
