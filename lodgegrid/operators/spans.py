"""Results over any span of months from stored parts of single months.

Distinct hosts and medians of a span do not follow from those of its months. What is stored per month
here merges: the price histogram of a group, the set of its hosts as bitmaps over dense host numbers,
and, where an estimate will do, a sketch of that set. A reloaded month replaces its own part only, and
a span reads the parts of its months instead of their listings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.ratios import rounded_ratio
from ..sinks.keyed import merge_keyed, read_keyed, write_keyed
from ..sinks.store import versions
from .median import summarize_values

NUMBER_PARTS = 64
_SPREAD = 1024


def number_hosts(spark: SparkSession, path: str, hosts: DataFrame) -> DataFrame:
    """``host_id, number`` of all hosts seen so far, those of ``hosts`` included; stored at ``path``.

    A host keeps its number. New ones get the next numbers without gaps, so that bitmaps over them stay
    dense: rows are counted in hash ranges, and a host's number is its place in its range after those
    before it. A NULL host has no number.
    """
    if not versions(spark, path):
        write_keyed(spark.createDataFrame([], "host_id string, number long"), path, ["host_id"], NUMBER_PARTS)
    known = read_keyed(spark, path)
    new = hosts.select("host_id").filter("host_id IS NOT NULL").distinct().join(known, "host_id", "left_anti").withColumn(
        "range", F.pmod(F.xxhash64("host_id"), F.lit(_SPREAD)))
    counts = new.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    # a row per range
    before = counts.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before"))
    first = known.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
    place = F.row_number().over(Window.partitionBy("range").orderBy("host_id")) - 1
    numbered = new.withColumn("place", place).join(before, "range").select(
        "host_id", (F.lit(first) + F.col("before") + F.col("place")).alias("number"))
    merge_keyed(numbered, path)
    return read_keyed(spark, path)


def host_bitmaps(listings: DataFrame, numbers: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, bucket, hosts, superhosts``: the hosts of each group, and those that were superhost in it.

    A bucket is the bitmap of 32,768 host numbers, 4 KB before compression. Rows meet by group and bucket
    as plain numbers, so that each bitmap arises in one task only: combined on the map side, every task
    would send bitmaps of all groups and buckets, whose number grows with the hosts.
    """
    numbered = listings.select(*keys, "host_id", "host_is_superhost").join(numbers, "host_id", "left")
    together = numbered.select(
        *keys,
        F.bitmap_bucket_number("number").alias("bucket"),
        F.bitmap_bit_position("number").alias("_position"),
        (F.col("host_is_superhost") == "t").alias("_super"),
    ).repartition(*keys, "bucket")
    return together.groupBy(*keys, "bucket").agg(
        F.bitmap_construct_agg("_position").alias("hosts"),
        F.bitmap_construct_agg(F.when(F.col("_super"), F.col("_position"))).alias("superhosts"))


def hosts_over(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """Exact number of different hosts and share of superhosts over all rows of each group."""
    merged = bitmaps.groupBy(*keys, "bucket").agg(
        F.bitmap_or_agg("hosts").alias("hosts"), F.bitmap_or_agg("superhosts").alias("superhosts"))
    counted = merged.groupBy(*keys).agg(
        F.sum(F.bitmap_count("hosts")).alias("distinct_host_count"), F.sum(F.bitmap_count("superhosts")).alias("_supers"))
    return counted.select(
        *keys, "distinct_host_count",
        rounded_ratio(F.col("_supers"), F.col("distinct_host_count")).alias("superhost_rate"))


def host_sketches(listings: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, hosts``: a mergeable sketch of each group's hosts, some KB whatever their number."""
    return listings.groupBy(*keys).agg(F.hll_sketch_agg("host_id").alias("hosts"))


def hosts_about(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """The number of different hosts to about two percent."""
    return sketches.groupBy(*keys).agg(
        F.hll_sketch_estimate(F.hll_union_agg("hosts")).alias("distinct_host_count"))


def price_histogram(listings: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, price, n``: how many listings of each group have each price, 0 for a missing one."""
    return listings.groupBy(*keys, "price").agg(F.count("price").alias("n"))


def prices_over(histogram: DataFrame, keys: list[str]) -> DataFrame:
    """Minimum, maximum, exact discrete median and average price over all rows of each group."""
    merged = histogram.groupBy(*keys, "price").agg(F.sum("n").alias("n"))
    return summarize_values(merged, keys, "price", "n").select(
        *keys,
        F.col("lowest").alias("min_price"),
        F.col("highest").alias("max_price"),
        F.col("middle").alias("median_price"),
        rounded_ratio(F.col("total"), F.col("known")).alias("average_price"),
    )
