"""Revenue against census: age-band shares per area and their averages."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame, functions as F

from ..functions.ratios import share
from ..schemas import AGE_TOPICS, CENSUS_CODE
from .metrics import REVENUE, revenue

# census person counts by age -> name of the share column
AGE_SHARES = {
    f"{topic}_P": "p"
    + topic.removeprefix("Age_").removesuffix("_yr").replace("85ov", "85_plus")
    for topic in AGE_TOPICS
}
SHARES = list(AGE_SHARES.values())


def revenue_by_code(listings: DataFrame, lga: DataFrame) -> DataFrame:
    """Revenue per area name and census code, summed per neighbourhood before the join."""
    per_area = revenue(listings, ["neighbourhood_cleansed"])
    areas = lga.select("neighbourhood_cleansed", "lga_name", "code_2016")
    return (
        per_area.join(areas, "neighbourhood_cleansed")
        .groupBy("lga_name", "code_2016")
        .agg(F.sum(REVENUE).alias("revenue"))
    )


def age_shares_by_lga(listings: DataFrame, lga: DataFrame, census: DataFrame) -> DataFrame:
    """Average revenue and average age-band shares per area name."""
    bands = [F.col(c) for c in AGE_SHARES]
    people = census.select(
        F.col(CENSUS_CODE).alias("code_2016"), *bands, reduce(add, bands).alias("_total")
    )
    shares = revenue_by_code(listings, lga).join(people, "code_2016").select(
        "lga_name",
        "revenue",
        *[share(F.col(c), F.col("_total")).alias(name) for c, name in AGE_SHARES.items()],
    )
    return shares.groupBy("lga_name").agg(
        F.avg("revenue").alias("agg_revenue"), *[F.avg(s).alias(s) for s in SHARES]
    )


def overall_age_shares(by_lga: DataFrame) -> DataFrame:
    """One row: the averages over all areas."""
    return by_lga.agg(
        F.avg("agg_revenue").alias("avg_revenue"), *[F.avg(s).alias(s) for s in SHARES]
    )


def average_share_of_top_lga(by_lga: DataFrame) -> DataFrame:
    """Mean of the band shares in the area with the highest revenue."""
    mean = reduce(add, [F.col(s) for s in SHARES]) / F.lit(len(SHARES))
    return (
        by_lga.orderBy(F.col("agg_revenue").desc_nulls_first(), F.col("lga_name").asc_nulls_last())
        .limit(1)
        .select(F.round(mean, 2).alias("average"))
    )
