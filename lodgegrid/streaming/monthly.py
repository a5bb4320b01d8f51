"""Load month files as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..sources.listings_csv import load_snapshots, month_of_file

# The file source delivers paths; contents are read by the batch loader, which knows
# each file's header. The column list is the binary file source's own.
_FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def load_new_months(
    spark: SparkSession,
    incoming: str,
    lookup: DataFrame,
    raw_path: str,
    progress_path: str,
    after_load: Callable[[list[int]], None] | None = None,
    files_per_batch: int = 12,
    missing_text: str | None = None,
) -> None:
    """Load every file in ``incoming`` not loaded before, however old, then stop.

    A file is known by its path: one delivered again under its name is not loaded again;
    pass it to :func:`lodgegrid.sources.listings_csv.load_snapshots`, which replaces its rows.

    ``progress_path`` records which files are done. A batch repeated after a failure
    replaces what it wrote before, so no row is lost or doubled. ``after_load`` gets the
    months of each batch, to refresh results of those months.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema(_FILE_SCHEMA)
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", files_per_batch)
        # the source would skip files a week older than the newest one it has seen
        .option("maxFileAge", "36500d")
        .load(incoming)
        .select("path")
    )

    def load(batch: DataFrame, _batch_id: int) -> None:
        paths = [row.path for row in batch.collect()]  # at most files_per_batch names
        if not paths:
            return
        load_snapshots(spark, paths, lookup, raw_path, missing_text)
        if after_load:
            after_load(sorted({month_of_file(p) for p in paths}))

    query = (
        files.writeStream.foreachBatch(load)
        .option("checkpointLocation", progress_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
