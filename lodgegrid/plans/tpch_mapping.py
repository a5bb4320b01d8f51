"""Listing-shaped data from the TPC-H-like tables.

A line item plays one listing in one monthly snapshot, the customer its host, the
customer's nation the neighbourhood, the region the local government area. The host
analyses use :func:`host_listings`, where the order plays the host and the supplier's
nation the neighbourhood: there, hosts with a single listing and hosts with several
areas both occur.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import CENSUS_CODE, CENSUS_FACT_TOPICS, CENSUS_MEDIANS
from ..sources import tables

# The input tables' columns, so that no read has to infer a schema.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return tables.read_table(spark, folder, name, TABLE_SCHEMAS[name])


# listing column -> SQL text, by the table it comes from
_FROM_LINEITEM = {
    "id": "l_orderkey * 8 + l_linenumber",
    "room_type": "l_returnflag",
    "has_availability": "CASE WHEN l_linestatus = 'O' THEN 't' ELSE 'f' END",
    "year_month": "year(l_shipdate) * 100 + month(l_shipdate)",
    "availability_30": "int(l_quantity) % 31",
    "price": "CAST(floor(l_extendedprice / 10000) * 50 + 50 AS decimal(19,2))",
    "review_scores_rating": "CASE WHEN l_discount = 0 THEN double('NaN') "
    "ELSE double(int(round(l_discount * 100)) * 10) END",
}
_FROM_PART = {"property_type": "p_type", "accommodates": "p_size % 8 + 1"}
_FROM_ORDERS = {"host_id": "string(o_custkey)"}
_FROM_CUSTOMER = {
    "host_name": "c_name",
    "host_is_superhost": "CASE WHEN c_acctbal > 5000 THEN 't' ELSE 'f' END",
}
_FROM_NATION = {"neighbourhood_cleansed": "n_name"}
_SOURCES = _FROM_LINEITEM | _FROM_PART | _FROM_ORDERS | _FROM_CUSTOMER | _FROM_NATION


def _named(expressions: dict[str, str]) -> list[str]:
    return [f"{sql} AS {name}" for name, sql in expressions.items()]


def listings(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """The named listing columns; only tables that supply one of them are joined.

    Every line item has one order, customer, nation and part, so leaving a join out
    changes no row. Customers meet orders before line items do: a customer with very
    many orders is then split on the smaller table, and the large join is on the order.
    Both sides of that one grow with the data, so it is always a sort-merge join. The
    other joins have base tables on their right, whose sizes Spark knows.
    """
    wanted = set(columns)
    rows = read_table(spark, folder, "lineitem")
    if wanted & _FROM_PART.keys():
        rows = rows.join(read_table(spark, folder, "part"), F.expr("l_partkey = p_partkey"))
    people_wanted = wanted & (_FROM_CUSTOMER | _FROM_NATION).keys()
    if people_wanted or wanted & _FROM_ORDERS.keys():
        hosts = read_table(spark, folder, "orders")
        if people_wanted:
            hosts = hosts.join(read_table(spark, folder, "customer"), F.expr("o_custkey = c_custkey"))
        if wanted & _FROM_NATION.keys():
            hosts = hosts.join(read_table(spark, folder, "nation"), F.expr("c_nationkey = n_nationkey"))
        rows = rows.join(hosts.hint("merge"), F.expr("l_orderkey = o_orderkey"))
    return rows.selectExpr(*_named({c: _SOURCES[c] for c in columns}))


def host_listings(spark: SparkSession, folder: str) -> DataFrame:
    """Listings by order (host) and supplier nation (neighbourhood)."""
    rows = (
        read_table(spark, folder, "lineitem")
        .join(read_table(spark, folder, "supplier"), F.expr("l_suppkey = s_suppkey"))
        .join(read_table(spark, folder, "nation"), F.expr("s_nationkey = n_nationkey"))
    )
    own = {c: _FROM_LINEITEM[c] for c in ("id", "availability_30", "price")}
    return rows.selectExpr(
        "string(l_orderkey) AS host_id", "n_name AS neighbourhood_cleansed", *_named(own)
    )


def lga(spark: SparkSession, folder: str) -> DataFrame:
    """Area list: nations under their region; some nations are an area of their own."""
    nations = read_table(spark, folder, "nation")
    regions = read_table(spark, folder, "region")
    return nations.join(regions, F.expr("n_regionkey = r_regionkey")).selectExpr(
        "n_name AS neighbourhood_cleansed",
        "CASE WHEN n_nationkey % 5 = 2 THEN n_name ELSE r_name END AS lga_name",
        "string(n_nationkey + 20000) AS code_2016",
    )


def census_counts_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Census counts as text: customers of a nation, dealt over the census topics.

    The customer key picks the topic, the balance the sex.
    """
    people = read_table(spark, folder, "customer").selectExpr(
        f"string(c_nationkey + 20000) AS {CENSUS_CODE}",
        f"c_custkey % {len(CENSUS_FACT_TOPICS)} AS topic",
        "c_acctbal < 5000 AS male",
    )
    tests = {"M": " AND male", "F": " AND NOT male", "P": ""}
    counts = [
        F.expr(f"string(count_if(topic = {position}{test})) AS {topic}_{sex}")
        for position, topic in enumerate(CENSUS_FACT_TOPICS)
        for sex, test in tests.items()
    ]
    return people.groupBy(CENSUS_CODE).agg(*counts)


def census_medians_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Census medians as text, in tenths, from the customers per nation."""
    people = read_table(spark, folder, "customer").selectExpr(
        f"string(c_nationkey + 20000) AS {CENSUS_CODE}"
    )
    counted = people.groupBy(CENSUS_CODE).agg(F.count(F.lit(1)).alias("n"))
    return counted.selectExpr(
        CENSUS_CODE,
        *[
            f"concat(string(100 + n * {position + 7} % 400), '.5') AS {name}"
            for position, name in enumerate(CENSUS_MEDIANS)
        ],
    )


def suburb_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Market segments as suburbs: one absent, one in two areas, and a missing suburb."""
    segments = read_table(spark, folder, "customer").select("c_mktsegment").distinct()
    areas = (
        "CASE c_mktsegment WHEN 'MACHINERY' THEN array('LGA_NORTH', 'LGA_SOUTH') "
        "WHEN 'FURNITURE' THEN array() ELSE array(concat('LGA_', c_mktsegment)) END"
    )
    known = segments.selectExpr("c_mktsegment AS host_neighbourhood", f"explode({areas}) AS LGA")
    missing = spark.range(1).selectExpr("'N/A' AS host_neighbourhood", "'LGA_UNKNOWN' AS LGA")
    return known.unionByName(missing)


def delivered_listings(spark: SparkSession, folder: str) -> DataFrame:
    """Listing rows as text, the way a snapshot delivers them, with their month.

    Missing values are written as tokens, whole numbers partly as floats, prices as
    currency text.
    """
    hosts = (
        read_table(spark, folder, "orders")
        .join(read_table(spark, folder, "customer"), F.expr("o_custkey = c_custkey"))
        .join(read_table(spark, folder, "nation"), F.expr("c_nationkey = n_nationkey"))
    )
    rows = (
        read_table(spark, folder, "lineitem")
        .join(read_table(spark, folder, "part"), F.expr("l_partkey = p_partkey"))
        .join(hosts.hint("merge"), F.expr("l_orderkey = o_orderkey"))
    )
    own = _SOURCES
    return rows.selectExpr(
        *_named(
            {
                "snapshot": own["year_month"],
                "id": f"string({own['id']})",
                "host_id": own["host_id"],
                "host_name": "CASE WHEN c_custkey % 50 = 7 THEN 'null' ELSE c_name END",
                "host_is_superhost": own["host_is_superhost"],
                "host_neighbourhood": "CASE WHEN c_custkey % 10 = 3 THEN '' ELSE c_mktsegment END",
                "neighbourhood_cleansed": own["neighbourhood_cleansed"],
                "property_type": own["property_type"],
                "room_type": own["room_type"],
                "has_availability": own["has_availability"],
                "accommodates": f"string({own['accommodates']})",
                "availability_30": f"string({own['availability_30']})",
                "number_of_reviews": "concat(l_linenumber, '.0')",
                "review_scores_rating": "CASE WHEN l_discount = 0 THEN 'NaN' "
                "ELSE string(int(round(l_discount * 100)) * 10) END",
                "price": "concat('$', format_number(CAST(l_extendedprice AS decimal(12,2)), 2))",
                "bedrooms": "string(p_size)",
                "amenities": "p_name",
            }
        )
    )
