"""The metric family over listing facts, at any grain.

Each function takes the listing frame and the grouping columns. Every ``groupBy`` is
either combined on the map side to one row per group, or keyed so finely (host, price,
stays) that a hot area spreads over many tasks before it is summed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.parsing import has_rating
from ..functions.ratios import relative_change, rounded_ratio
from .median import summarize_values
from .ordered_lag import global_lag

AREA = ["neighbourhood_cleansed", "year_month"]
PROPERTY = ["property_type", "room_type", "accommodates", "year_month"]
TIME = "year_month"
NIGHTS = 30  # fixed value: the window of availability_30

REVENUE = "estimated_revenue_per_active_listings"


def number_of_stays() -> Column:
    return (F.lit(NIGHTS) - F.col("availability_30")).alias("number_of_stays")


def flagged(flag: str) -> Column:
    return F.count_if(F.col("has_availability") == flag)


def month_summary(listings: DataFrame, keys: list[str]) -> DataFrame:
    """Everything five of the nine metrics need, in one pass over the listings."""
    rated = _rated()
    return listings.groupBy(*keys).agg(
        flagged("t").alias("active_listings"),
        flagged("f").alias("inactive_listings"),
        F.count(F.lit(1)).alias("total_listings"),
        F.sum(F.when(rated, _rating())).alias("rating_sum"),
        F.count_if(rated).alias("rated"),
        F.sum(number_of_stays()).alias("number_of_stays"),
    )


def _rated() -> Column:
    return (F.col("has_availability") == "t") & has_rating(F.col("review_scores_rating"))


def _rating() -> Column:
    return F.col("review_scores_rating").cast("decimal(12,6)")


def active_rate(listings: DataFrame, keys: list[str]) -> DataFrame:
    """Active and total listings and their rounded ratio."""
    counts = listings.groupBy(*keys).agg(
        flagged("t").alias("active_listings"), F.count(F.lit(1)).alias("total_listings")
    )
    return active_rate_of(counts, keys)


def active_rate_of(counts: DataFrame, keys: list[str]) -> DataFrame:
    rate = rounded_ratio(F.col("active_listings"), F.col("total_listings"))
    return counts.select(
        *keys, "active_listings", "total_listings", rate.alias("active_listings_rate")
    )


def price_stats(listings: DataFrame, keys: list[str]) -> DataFrame:
    """Minimum, maximum, exact discrete median and average price.

    All four come from one histogram keyed by price, so the facts are shuffled once.
    """
    histogram = listings.groupBy(*keys, "price").agg(F.count("price").alias("n"))
    return summarize_values(histogram, keys, "price", "n").select(
        *keys,
        F.col("lowest").alias("min_price"),
        F.col("highest").alias("max_price"),
        F.col("middle").alias("median_price"),
        rounded_ratio(F.col("total"), F.col("known")).alias("average_price"),
    )


def distinct_hosts(listings: DataFrame, keys: list[str]) -> DataFrame:
    """Number of different hosts; Spark shuffles on (keys, host) before it counts."""
    return listings.groupBy(*keys).agg(F.count_distinct("host_id").alias("distinct_host_count"))


def superhost_rate(listings: DataFrame, keys: list[str]) -> DataFrame:
    """Share of hosts that were superhost in any of the group's rows.

    One row per (keys, host) first: two distinct counts in one aggregate would make
    Spark read every row twice.
    """
    superhost = (F.col("host_is_superhost") == "t") & F.col("host_id").isNotNull()
    hosts = listings.groupBy(*keys, "host_id").agg(
        F.coalesce(F.bool_or(superhost), F.lit(False)).alias("_super")
    )
    counts = hosts.groupBy(*keys).agg(
        F.count_if("_super").alias("_supers"), F.count("host_id").alias("_hosts")
    )
    rate = rounded_ratio(F.col("_supers"), F.col("_hosts"))
    return counts.select(*keys, rate.alias("superhost_rate"))


def average_rating_active(listings: DataFrame, keys: list[str]) -> DataFrame:
    """Average rating of active listings that have one."""
    sums = listings.filter(_rated()).groupBy(*keys).agg(
        F.sum(_rating()).alias("rating_sum"), F.count(F.lit(1)).alias("rated")
    )
    return average_rating_of(sums, keys)


def average_rating_of(sums: DataFrame, keys: list[str]) -> DataFrame:
    average = rounded_ratio(F.col("rating_sum"), F.col("rated"))
    return sums.filter(F.col("rated") > 0).select(
        *keys, average.alias("average_review_scores_rating")
    )


def percentage_change(
    listings: DataFrame,
    keys: list[str],
    flag: str,
    scope: str = "global",
    drop_zero: bool = False,
    slices: int | None = None,
) -> DataFrame:
    """Change of the active (``t``) or inactive (``f``) count against the previous row.

    ``scope="global"`` takes the previous row of the whole ordered result, so a group's
    first month compares with the group before it. ``scope="group"`` starts each group
    anew. ``drop_zero`` removes zero counts before looking back.
    """
    counts = listings.groupBy(*keys).agg(flagged(flag).alias(_COUNT_OF[flag]))
    return percentage_change_of(counts, keys, flag, scope, drop_zero, slices)


_COUNT_OF = {"t": "active_listings", "f": "inactive_listings"}


def percentage_change_of(
    counts: DataFrame,
    keys: list[str],
    flag: str,
    scope: str = "global",
    drop_zero: bool = False,
    slices: int | None = None,
) -> DataFrame:
    name = _COUNT_OF[flag]
    groups = [k for k in keys if k != TIME]
    counts = counts.select(*keys, name)
    if drop_zero:
        counts = counts.filter(F.col(name) > 0)
    if scope == "global":
        placed = global_lag(counts, name, [*groups, TIME], "_previous", slices)
    elif scope == "group":
        # one row per month in each window
        months = Window.partitionBy(*groups).orderBy(F.col(TIME).asc_nulls_last())
        placed = counts.withColumn("_previous", F.lag(name).over(months))
    else:
        raise ValueError(f"scope must be 'global' or 'group', not {scope!r}")
    change = relative_change(F.col(name), F.col("_previous"))
    return placed.select(*keys, name, change.alias("running_diff_per"))


def stays(listings: DataFrame, keys: list[str]) -> DataFrame:
    """Booked nights of the next thirty, summed."""
    return listings.groupBy(*keys).agg(F.sum(number_of_stays()).alias("number_of_stays"))


def listing_revenue() -> Column:
    return F.col("number_of_stays").cast("decimal(10,0)") * F.col("price")


def revenue(listings: DataFrame, keys: list[str], dedup: bool = False) -> DataFrame:
    """Booked nights times price, summed.

    ``dedup`` counts equal (stays, price) pairs of a group once, which is not the same
    as counting equal products once.
    """
    nights = listings.select(*keys, number_of_stays(), "price")
    if dedup:
        nights = nights.distinct()
    return nights.groupBy(*keys).agg(F.sum(listing_revenue()).alias(REVENUE))


def distinct_hosts_by_lga(listings: DataFrame, lga: DataFrame) -> DataFrame:
    """Different hosts per local government area and month.

    Listings shrink to one row per (area, month, host) before they meet the area list.
    """
    hosts = listings.select(*AREA, "host_id").distinct()
    return distinct_hosts(_with_lga(hosts, lga), ["host_lga_cleansed", TIME])


def revenue_by_lga(listings: DataFrame, lga: DataFrame, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Revenue per local government area and month, optionally also per host.

    Revenue is summed per area first, so the join sees one row per area and month.
    """
    per_area = revenue(listings, [*extra_keys, *AREA])
    return (
        _with_lga(per_area, lga)
        .groupBy(*extra_keys, "host_lga_cleansed", TIME)
        .agg(F.sum(REVENUE).alias(REVENUE))
    )


def _with_lga(areas: DataFrame, lga: DataFrame) -> DataFrame:
    names = lga.select("neighbourhood_cleansed", F.col("lga_name").alias("host_lga_cleansed"))
    return areas.join(names, "neighbourhood_cleansed")
