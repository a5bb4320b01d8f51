"""Columns, words and small helpers that several operators share."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# The white space that separates words, and a word as a pattern.
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


#: Rows a Python task holds at once; a row may carry a whole text.
BATCH_ROWS = 1000


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches bounded for rows that carry whole texts.

    The setting stays, since ``df`` is only run later; it changes no result.
    """
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    own = int(df.sparkSession.conf.get(setting))
    if own <= 0 or own > BATCH_ROWS:
        df.sparkSession.conf.set(setting, str(BATCH_ROWS))
    return df


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows of the driver's as a table.

    Given as Arrow data they are a local relation; a list of rows is read by Python workers of its own,
    which stay in every executor's memory.
    """
    kind = StructType.fromDDL(schema)
    return spark.createDataFrame(
        pa.Table.from_pylist([dict(zip(kind.names, row)) for row in rows], schema=to_arrow_schema(kind)), kind)


def id_carried(df: DataFrame) -> DataFrame:
    """``df`` for a Python task: ``doc_id`` is never NULL, and ``_no_id`` says where it was.

    Among NULLs pandas holds whole numbers as doubles, which round ids above 2 ** 53.
    """
    kind = df.schema["doc_id"].dataType
    return df.withColumns({"doc_id": F.coalesce("doc_id", F.lit(0).cast(kind)), "_no_id": F.col("doc_id").isNull()})


def id_restored(df: DataFrame) -> DataFrame:
    """What ``id_carried`` took, NULL again."""
    return df.withColumn("doc_id", F.when(~F.col("_no_id"), F.col("doc_id"))).drop("_no_id")


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the value as text, modulo ``modulus``; NULL for NULL."""
    return F.crc32(F.col(column).cast("string")) % F.lit(modulus)


def ascii_lower(column: Column) -> Column:
    """A-Z to a-z; every other letter stays as it is."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(column: Column) -> Column:
    """The text's words as an array; NULL text has none."""
    return F.array_remove(F.split(F.coalesce(column, F.lit("")), SPACE_CLASS + "+"), "")


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once a row, also where ``use`` reads it in a loop."""
    return F.element_at(F.transform(F.array(value), use), 1)


def boxed(docs: DataFrame, *columns: Column) -> DataFrame:
    """Each row as the struct ``doc``, beside ``columns``; names inside cannot clash with others."""
    return docs.select(F.struct("*").alias("doc"), *columns)


def unboxed(df: DataFrame, names: list[str], **new: Column) -> DataFrame:
    """The rows in ``doc`` again, with ``new`` in place of the columns of that name."""
    return df.select(*[
        new[name].alias(name) if name in new else F.col("doc").getField(name).alias(name) for name in names])
