"""Catalog tables bucketed and sorted by a key, so that joins on it move nothing.

Each table is a folder given by the caller; the catalog entry can be made anew from it. All rows of a
key are in one bucket, which one task reads: bucket by a key whose rows fit one, and leave others to the
ordinary tables, whose joins split hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def store_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> None:
    """Store ``df`` as the table ``name`` at ``path``: a file per bucket, sorted by ``key``."""
    # one task writes one bucket
    dealt = df.repartition(buckets, key)
    dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)


def register_bucketed(spark: SparkSession, name: str, path: str, columns: str, key: str, buckets: int) -> None:
    """Name the table at ``path`` in this session's catalog; ``columns`` is its schema as SQL text."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
