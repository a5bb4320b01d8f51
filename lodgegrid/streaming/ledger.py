"""Keep the raw table equal to a folder of month files, with a ledger of what was loaded.

The ledger holds name, size, time of change and a digest of each file whose rows are in the raw
table. A run compares it with the folder: new files and files whose content changed are loaded, which
replaces their rows, and the rows of files that are gone, or hold none any more, are removed. The
ledger is written last, so a run that fails is made good by the next one, and a run that finds nothing
changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import BLANK_COLUMNS_BY_MONTH
from ..sinks.store import read_version, versions, write_version
from ..sources.listings_csv import load_snapshots, month_of_file, retract_files

LEDGER = "name string, path string, length long, modified timestamp, digest string"
KEPT_VERSIONS = 3


@dataclass(frozen=True)
class Changes:
    """Names of the files a run loaded and retracted, and the months they belong to."""

    loaded: list[str]
    retracted: list[str]

    @property
    def months(self) -> list[int]:
        return sorted({month_of_file(name) for name in [*self.loaded, *self.retracted]})


def files_in(spark: SparkSession, folder: str) -> DataFrame:
    """``name, path, length, modified`` of the CSV files in a folder; contents are not read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
    return listed.select(
        F.element_at(F.split("path", "/"), -1).alias("name"), "path", "length",
        F.col("modificationTime").alias("modified"))


def digests(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``name, digest`` of files of any size: the number of lines and the sum of their hashes, by split.

    Where a line stands counts only as the split it is in.
    """
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_block_start").alias("start"), "value")
    by_split = lines.groupBy("name", "start").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("value", "start").cast("decimal(38,0)")).alias("total"))
    return by_split.groupBy("name").agg(
        F.concat_ws(":", F.sum("n").cast("string"), F.sum("total").cast("string")).alias("digest"))


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    if versions(spark, ledger_path):
        return read_version(spark, ledger_path)
    return spark.createDataFrame([], LEDGER)


def sync_folder(
    spark: SparkSession,
    incoming: str,
    lookup: DataFrame,
    raw_path: str,
    ledger_path: str,
    missing_text: str | None = None,
    blanks: dict[int, list[str]] = BLANK_COLUMNS_BY_MONTH,
) -> Changes:
    """Loads what is new or changed in ``incoming`` and retracts what is gone.

    ``raw_path`` must be filled by this function alone. What the driver handles is file
    names; a file is known by its name, which must be unique.
    """
    known = {r.name: r for r in read_ledger(spark, ledger_path).collect()}
    found = {r.name: r for r in files_in(spark, incoming).collect()}
    suspects = [
        r for name, r in found.items()
        if name not in known or (r.length, r.modified) != (known[name].length, known[name].modified)]
    content = {r.name: r.digest for r in digests(spark, [r.path for r in suspects]).collect()} if suspects else {}
    # a file without a byte has no lines
    digest = {r.name: content.get(r.name, "0") for r in suspects}
    changed = [r for r in suspects if r.name not in known or digest[r.name] != known[r.name].digest]
    gone = sorted(set(known) - set(found))
    empty = sorted(r.name for r in changed if not r.length)
    load = sorted((r for r in changed if r.length), key=lambda r: r.name)
    if load:
        load_snapshots(spark, [r.path for r in load], lookup, raw_path, missing_text, blanks)
    retract_files(spark, raw_path, [*gone, *empty])
    if suspects or gone:
        rows = [
            (name, r.path, r.length, r.modified, digest.get(name) or known[name].digest) for name, r in found.items()]
        write_version(spark.createDataFrame(rows, LEDGER).coalesce(1), ledger_path, KEPT_VERSIONS)
    return Changes([r.name for r in load], [*gone, *empty])
