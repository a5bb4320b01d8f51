"""Stored tables: scan, count and preview."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_table(spark: SparkSession, folder: str, name: str, schema: str | None = None) -> DataFrame:
    """A stored table; with a schema given, no file is opened to infer one."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def preview(df: DataFrame, n: int, order_by: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows, of any order unless one is given."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
