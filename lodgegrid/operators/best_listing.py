"""Which kind of listing earns most in each area."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .metrics import listing_revenue, number_of_stays

KIND = ["neighbourhood_cleansed", "property_type", "room_type", "accommodates"]


def revenue_per_kind(listings: DataFrame) -> DataFrame:
    """One row per different (kind, stays, price) with its revenue, not summed."""
    pairs = listings.select(*KIND, number_of_stays(), "price").distinct()
    return pairs.select(*KIND, listing_revenue().alias("revenue"))


def best_kind_per_area(listings: DataFrame, top: int = 5) -> DataFrame:
    """The highest-revenue kind of each area, for the ``top`` areas.

    ``row_number() == 1`` lets Spark drop all but one row per area before the shuffle.
    Ties go to the first kind in column order.
    """
    totals = revenue_per_kind(listings).groupBy(*KIND).agg(F.sum("revenue").alias("revenue_agg"))
    highest = [F.col("revenue_agg").desc_nulls_first()]
    kind = [F.col(c).asc_nulls_last() for c in KIND]
    rank = F.row_number().over(
        Window.partitionBy("neighbourhood_cleansed").orderBy(*highest, *kind[1:])
    )
    best = totals.withColumn("rank", rank).filter(F.col("rank") == 1)
    return best.orderBy(*highest, *kind).limit(top)
