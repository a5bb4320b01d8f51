"""Host analyses: home-area match and mortgage cover."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..schemas import CENSUS_CODE
from .metrics import listing_revenue, number_of_stays

def host_area_match(listings: DataFrame, lga: DataFrame) -> DataFrame:
    """Each host's total listing rows and areas, flagged where area and LGA name agree.

    Rows shrink to one per (host, area) first; the window then holds at most one row
    per area for each host.
    """
    areas = listings.groupBy("host_id", "neighbourhood_cleansed").agg(
        F.count(F.lit(1)).alias("_n")
    )
    total = F.sum("_n").over(Window.partitionBy("host_id")).alias("total_listings")
    names = lga.select("neighbourhood_cleansed", "lga_name").distinct()
    same = F.col("neighbourhood_cleansed") == F.col("lga_name")
    return (
        areas.filter(F.col("host_id").isNotNull())
        .select("host_id", "neighbourhood_cleansed", total)
        .join(names, "neighbourhood_cleansed")
        .select(
            "host_id",
            "total_listings",
            F.col("neighbourhood_cleansed").alias("property_lga"),
            F.col("lga_name").alias("host_lga"),
            F.when(same, 1).alias("match"),
        )
    )


def hosts_with_one_listing(listings: DataFrame) -> DataFrame:
    """Hosts with exactly one listing row over all months."""
    return (
        listings.groupBy("host_id")
        .agg(F.count("id").alias("_n"))
        .filter(F.col("_n") == 1)
        .select("host_id")
    )


def mortgage_by_area(lga: DataFrame, census: DataFrame) -> DataFrame:
    """Yearly median mortgage repayment per neighbourhood and census code."""
    medians = census.select(
        F.col(CENSUS_CODE).alias("code_2016"),
        (F.col("Median_mortgage_repay_monthly") * 12).alias("annualised_median_mortgage_repay"),
    )
    areas = lga.select("neighbourhood_cleansed", "code_2016")
    return areas.join(medians, "code_2016").distinct()


def _covered(pairs: DataFrame) -> DataFrame:
    covers = F.col("estimated_revenue") >= F.col("annualised_median_mortgage_repay")
    return pairs.select(
        "host_id",
        "neighbourhood_cleansed",
        "code_2016",
        "estimated_revenue",
        "annualised_median_mortgage_repay",
        F.when(covers, 1).otherwise(0).alias("covered"),
    )


def mortgage_cover(
    listings: DataFrame, lga: DataFrame, census: DataFrame, split_above: int = 10_000
) -> DataFrame:
    """Every listing revenue of a host against the mortgage in every area of that host.

    The result depends only on a host's different areas and different revenues, so both
    sides are made distinct before they meet on the host. A host with more than
    ``split_above`` revenues is joined in several parts, so that its combinations do not
    all arise in one task.
    """
    host_revenues = _host_revenues(listings)
    large = (
        host_revenues.groupBy("host_id")
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > split_above)
        .selectExpr("host_id", f"int(ceil(_n / {split_above})) AS _parts")
    )
    parts = "coalesce(_parts, 1)"
    mortgages = (
        _host_mortgages(listings, lga, census)
        .join(large, "host_id", "left")
        .withColumn("_part", F.expr(f"explode(sequence(0, {parts} - 1))"))
        .drop("_parts")
    )
    revenues = (
        host_revenues.join(large, "host_id", "left")
        .withColumn("_part", F.expr(f"int(pmod(xxhash64(estimated_revenue), {parts}))"))
        .drop("_parts")
    )
    return _covered(revenues.join(mortgages, ["host_id", "_part"]))


def mortgage_cover_by_revenue(listings: DataFrame, lga: DataFrame, census: DataFrame) -> DataFrame:
    """:func:`mortgage_cover` in descending order of revenue, missing ones first.

    A pair's place depends on its revenue alone. So a host's areas become bits, revenues are put in order with
    the bits of their host beside them, and the pairs arise afterwards, where their revenue stands: sorting the
    pairs would shuffle each of them, and form them twice, once for the sample. Equal revenues are spread by host.
    """
    # a number per area of the list, which is a dimension
    numbered = mortgage_by_area(lga, census).withColumn(
        "_area", F.dense_rank().over(Window.orderBy("neighbourhood_cleansed")) - 1)
    places = numbered.select(
        "neighbourhood_cleansed", F.expr("_area div 32").alias("_word"), (F.col("_area") % 32).alias("_bit")).distinct()
    host_areas = listings.select("host_id", "neighbourhood_cleansed").join(places, "neighbourhood_cleansed").groupBy(
        "host_id", "_word").agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("_bits"))
    placed = _host_revenues(listings).join(host_areas, "host_id").orderBy(
        F.col("estimated_revenue").desc_nulls_first(), "host_id")
    pairs = placed.select("*", F.expr("explode(sequence(0, 31)) AS _bit")).filter("bit_get(_bits, _bit) = 1").withColumn(
        "_area", F.expr("int(_word * 32 + _bit)"))
    # the area list has to come to the rows, since moving them would undo their order
    return _covered(pairs.join(F.broadcast(numbered), "_area"))


def _host_mortgages(listings: DataFrame, lga: DataFrame, census: DataFrame) -> DataFrame:
    """The mortgages in each host's different areas."""
    host_areas = listings.select("host_id", "neighbourhood_cleansed").distinct()
    return host_areas.join(mortgage_by_area(lga, census), "neighbourhood_cleansed")


def _host_revenues(listings: DataFrame) -> DataFrame:
    """Each host's different listing revenues."""
    return (
        listings.select("host_id", number_of_stays(), "price")
        .select("host_id", listing_revenue().alias("estimated_revenue"))
        .distinct()
    )


def mortgage_cover_one_listing(listings: DataFrame, lga: DataFrame, census: DataFrame) -> DataFrame:
    """:func:`mortgage_cover` for hosts with one listing id.

    Nearly all of them have one row, hence one area and one revenue, which a single
    aggregate carries along. Hosts with more rows, of which one alone has an ``id``, take
    the full join.
    """
    plain, others = _one_row_or_more(listings)
    joined = _covered(plain.join(mortgage_by_area(lga, census), "neighbourhood_cleansed"))
    full = mortgage_cover(listings.join(others, "host_id", "left_semi"), lga, census)
    return joined.unionByName(full).drop("code_2016")


def _one_row_or_more(listings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hosts with one listing id: those of one row with its area and revenue, and the other ones."""
    singles = (
        listings.select("host_id", "id", "neighbourhood_cleansed", number_of_stays(), "price")
        .groupBy("host_id")
        .agg(
            F.count("id").alias("_n"),
            F.count(F.lit(1)).alias("_rows"),
            F.min("neighbourhood_cleansed").alias("neighbourhood_cleansed"),
            F.min(listing_revenue()).alias("estimated_revenue"),
        )
        .filter((F.col("_n") == 1) & F.col("host_id").isNotNull())
    )
    return singles.filter(F.col("_rows") == 1), singles.filter(F.col("_rows") > 1).select("host_id")


def cover_count(one_listing: DataFrame) -> DataFrame:
    """Rows per covered flag."""
    return one_listing.groupBy("covered").agg(F.count("covered").alias("count"))


def mortgage_cover_count(listings: DataFrame, lga: DataFrame, census: DataFrame) -> DataFrame:
    """:func:`cover_count` of :func:`mortgage_cover`, without forming its pairs.

    A host's revenues and mortgages are put in one order; a mortgage is not covered by the
    revenues that stand before it, and covered by the others. So a host costs a sort of what
    it has, not its areas times its revenues.
    """
    mortgages = _host_mortgages(listings, lga, census).select(
        "host_id", F.col("annualised_median_mortgage_repay").alias("_value"), F.lit(0).alias("_revenues"), F.lit(1).alias("_mortgages"))
    revenues = _host_revenues(listings).select(
        "host_id", F.col("estimated_revenue").alias("_value"), F.lit(1).alias("_revenues"), F.lit(0).alias("_mortgages"))
    # a host's points are only sorted, which needs far less memory than a hash table of all hosts' values
    points = revenues.unionByName(mortgages).filter("host_id IS NOT NULL").withColumn(
        "_value", F.col("_value").cast("decimal(38,4)"))
    # a mortgage stands before a revenue equal to it, which covers it; a missing revenue, which covers nothing,
    # before every mortgage, and a missing mortgage, which is not covered, after every revenue
    missing = F.when(F.col("_value").isNotNull(), 0).otherwise(F.col("_mortgages") - F.col("_revenues"))
    before = Window.partitionBy("host_id").orderBy(missing, "_value", "_revenues").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    placed = points.select(
        (F.col("_revenues") * F.sum("_mortgages").over(before)).alias("_yes"),
        (F.col("_mortgages") * F.sum("_revenues").over(before)).alias("_no"),
    )
    sums = placed.agg(F.sum("_yes").alias("yes"), F.sum("_no").alias("no"))
    flags = F.array(
        F.struct(F.lit(1).alias("covered"), F.col("yes").alias("count")), F.struct(F.lit(0).alias("covered"), F.col("no").alias("count")))
    return sums.select(F.inline(flags)).filter("count > 0")


def mortgage_cover_count_one_listing(listings: DataFrame, lga: DataFrame, census: DataFrame) -> DataFrame:
    """:func:`cover_count` of :func:`mortgage_cover_one_listing`, without forming the pairs of
    hosts with several rows."""
    plain, others = _one_row_or_more(listings)
    joined = _covered(plain.join(mortgage_by_area(lga, census), "neighbourhood_cleansed"))
    full = mortgage_cover_count(listings.join(others, "host_id", "left_semi"), lga, census)
    return cover_count(joined).unionByName(full).groupBy("covered").agg(F.sum("count").alias("count"))
