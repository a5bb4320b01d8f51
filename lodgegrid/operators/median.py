"""Exact discrete median, with the range and sum, per group of a value histogram."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# A band holds the values of one sign, number of whole digits and leading digits. A
# DECIMAL(19,2) amount has at most 17 whole digits, so a group has at most 2 * 17 * 10^5
# bands, and up to five whole digits a band holds at most 100 values.
LEADING = 5


def value_band(value: Column) -> Column:
    """The band of a value; bands are ordered as their values are."""
    whole = F.floor(F.abs(value)).cast("decimal(18,0)").cast("string")
    band = F.length(whole) * 10**LEADING + F.substring(whole, 1, LEADING).cast("int")
    return F.when(value < 0, -band).otherwise(band)


def summarize_values(histogram: DataFrame, keys: list[str], value: str, n: str) -> DataFrame:
    """Per ``keys``: ``lowest``, ``highest``, ``total``, ``known`` and ``middle`` value.

    ``n`` is the number of rows with that value, 0 for a missing value. ``middle`` is
    ``percentile_disc(0.5)``: the first value whose cumulative count reaches half.

    The builtin aggregate keeps every value of a group in one buffer. Here a group is
    first reduced to bands of values; the band holding the middle is found, and only
    that band's values are ranked. Both windows hold a bounded number of rows per group
    whatever the group's size. The histogram is shuffled once and read twice.
    """
    banded = histogram.select(
        # as one struct, keys that are missing compare equal in the join below
        F.struct(*keys, value_band(F.col(value)).alias("_band")).alias("_cell"),
        F.struct(*keys).alias("_group"),
        F.col(value).alias("_value"),
        F.col(n).alias("_n"),
    )
    bands = banded.groupBy("_cell", "_group").agg(
        F.min("_value").alias("lowest"),
        F.max("_value").alias("highest"),
        F.sum(F.col("_value") * F.col("_n").cast("decimal(18,0)")).cast("decimal(32,2)").alias("total"),
        F.sum("_n").alias("_n"),
    )
    group = Window.partitionBy("_group")
    upto = group.orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle_band = (
        bands.withColumns(
            {
                "_before": F.sum("_n").over(upto) - F.col("_n"),
                "known": F.sum("_n").over(group),
                "lowest": F.min("lowest").over(group),
                "highest": F.max("highest").over(group),
                "total": F.sum("total").over(group).cast("decimal(32,2)"),
            }
        )
        .filter(_holds_middle())
        .drop("_n", "_group")
    )
    in_band = Window.partitionBy("_cell").orderBy("_value")
    running = in_band.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        banded.drop("_group")
        .join(middle_band, "_cell")
        .withColumn("_before", F.col("_before") + F.sum("_n").over(running) - F.col("_n"))
        .filter(_holds_middle())
        .select(
            *[F.col("_cell")[k].alias(k) for k in keys],
            "lowest", "highest", "total", "known", F.col("_value").alias("middle"),
        )
    )


def _holds_middle() -> Column:
    """The entry whose cumulative count reaches half; the missing one of an empty group."""
    before, upto = 2 * F.col("_before"), 2 * (F.col("_before") + F.col("_n"))
    return ((before < F.col("known")) & (upto >= F.col("known"))) | (F.col("known") == 0)
