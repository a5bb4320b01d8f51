"""Registered queries: every view, and the load, warehouse, audit and store jobs.

Each takes a session and the folder of the input tables and reads the whole tables.
Decimals leave as doubles so that results compare across engines.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.parsing import money
from ..operators import audit, hosts, metrics as m
from ..operators.census import SHARES
from ..operators.upsert import upsert
from ..schemas import HOST_KEY, LISTING_COLUMNS, LISTING_SCHEMA, PROPERTY_KEY, RAW_LISTING_SCHEMA, TIME_KEY
from ..session import cut_lineage, scratch_path, shuffles_released
from ..sinks import store
from ..sources.census_csv import read_columns
from ..sources.listings_csv import (
    CSV_OPTIONS,
    DELIVERED_COLUMNS,
    add_host_area,
    conform,
    load_snapshots,
    month_of_file,
    read_lookup,
    read_raw,
    with_year_month,
)
from ..sources.split_csv import read_split_records
from ..sources.tables import preview, row_counts
from ..streaming.ledger import sync_folder
from ..streaming.monthly import load_new_months
from . import datamart, month_parts, tpch_mapping as tm, warehouse as w
from .tpch_mapping import read_table

Query = Callable[[SparkSession, str], DataFrame]

AREA_FACTS = ("neighbourhood_cleansed", "year_month")
KIND_FACTS = ("property_type", "room_type", "accommodates", "year_month")
STAYS = ("availability_30",)
MONEY = ("availability_30", "price")

# metric number -> (label, columns it reads besides its grain)
_FAMILY = {
    1: ("active_rate", ("has_availability",)),
    2: ("price_stats", ("price",)),
    3: ("distinct_hosts", ("host_id",)),
    4: ("superhost_rate", ("host_id", "host_is_superhost")),
    5: ("avg_rating_active", ("has_availability", "review_scores_rating")),
    6: ("pct_change_active", ("has_availability",)),
    7: ("pct_change_inactive", ("has_availability",)),
    8: ("stays", STAYS),
    9: ("revenue", MONEY),
}


def _comparable(df: DataFrame, digits: dict[str, int] | None = None) -> DataFrame:
    """Decimals as doubles; columns named in ``digits`` are rounded first."""
    digits = digits or {}

    def value(field: T.StructField):
        column = F.col(field.name)
        if field.name in digits:
            column = F.round(column, digits[field.name])
        decimal = isinstance(field.dataType, T.DecimalType)
        return (column.cast("double") if decimal else column).alias(field.name)

    return df.select(*[value(f) for f in df.schema])


def _census(spark: SparkSession, folder: str) -> DataFrame:
    return w.census_fact(
        tm.census_counts_raw(spark, folder),
        tm.census_medians_raw(spark, folder),
        w.dim_lga(tm.lga(spark, folder)),
    )


def _view(name: str, columns: tuple[str, ...], lga=False, census=False, digits=None) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        inputs = datamart.Inputs(
            tm.listings(spark, folder, *columns),
            tm.lga(spark, folder) if lga else None,
            _census(spark, folder) if census else None,
        )
        return _comparable(datamart.view(name, inputs), digits)

    return run


def _host_view(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        inputs = datamart.Inputs(
            tm.host_listings(spark, folder), tm.lga(spark, folder), _census(spark, folder)
        )
        return _comparable(datamart.view(name, inputs))

    return run


def _views() -> dict[str, Query]:
    found = {}
    names = list(datamart.VIEWS)
    for number, grain in ((1, AREA_FACTS), (2, KIND_FACTS)):
        for metric, (label, extra) in _FAMILY.items():
            name = next(n for n in names if n.startswith(f"question_{number}_{metric}_"))
            found[f"q{number}_{metric}_{label}"] = _view(name, grain + extra)
    shares = {**dict.fromkeys(SHARES, 12), "agg_revenue": 6, "avg_revenue": 6}
    area_money = ("neighbourhood_cleansed", *MONEY)
    kind_money = ("neighbourhood_cleansed", "property_type", "room_type", "accommodates", *MONEY)
    return found | {
        "q3_1_distinct_hosts_lga": _view(
            "question_3_1_distinct_hosts", (*AREA_FACTS, "host_id"), lga=True
        ),
        "q3_2_revenue_lga": _view(
            "question_3_2_estimated_revenue_active_listings", AREA_FACTS + MONEY, lga=True
        ),
        "q3_3_revenue_host_lga": _view(
            "question_3_3_estimated_revenue_per_host", (*AREA_FACTS, "host_id", *MONEY), lga=True
        ),
        "q4_a_1_revenue_age_shares": _view("q4_a_1_revenue_lga_g1", area_money, True, True, shares),
        "q4_a_2_revenue_age_shares_view": _view(
            "q4_a_2_revenue_lga_g1", area_money, True, True, shares
        ),
        "q4_a_3_overall_age_shares": _view(
            "q4_a_3_population_bracket_proportion", area_money, True, True, shares
        ),
        "q4_a_4_average_age_share": _view(
            "q4_a_4_population_bracket_proportion_average", area_money, True, True
        ),
        "q4_b_1_revenue_per_kind": _view(
            "q4_b_1_listing_neighbourhood_revenue_prop_room_accomodates", kind_money
        ),
        "q4_b_2_best_listing_type": _view("q4_b_2_best_listing_type", kind_money),
        "q4_c_host_area_match": _host_view("q4_c_property_lga_host_lga_listings"),
        "q4_d_1_one_listing_hosts": _host_view("q4_d_1_hosts_with_one_listing"),
        "q4_d_2_mortgage_cover": _host_view("q4_d_2_revenue_cover_mortgage"),
        "q4_d_3_mortgage_cover_one_listing": _host_view(
            "q4_d_3_revenue_cover_mortgage_hosts_with_one_listing"
        ),
        "q4_d_4_cover_count": _host_view("q4_d_4_cover_count"),
    }


def _change_by_group(grain: list[str], flag: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        facts = tm.listings(spark, folder, *grain, "has_availability")
        return m.percentage_change(facts, grain, flag, scope="group", drop_zero=flag == "f")

    return run


# --- load -----------------------------------------------------------------------

# Months are put together in slices of about this many stored bytes; in a shuffle they take about five times as many.
_SLICE_BYTES = 1 << 30


def _month_slices(delivered: DataFrame) -> Iterator[DataFrame]:
    """The delivered rows in slices of whole months, each to be written before the next is taken.

    The rows are stored once, narrow, so that the joins' shuffles are gone before the months are put
    together, and only a slice's rows are in a shuffle at a time. They are removed at the end.
    """
    spark = delivered.sparkSession
    kept = scratch_path(spark, "delivered")
    with shuffles_released(spark):
        delivered.write.parquet(kept)
    rows = spark.read.schema(delivered.schema).parquet(kept)
    slices = math.ceil(max(1, store.stored_bytes(spark, kept)) / _SLICE_BYTES)
    for number in range(slices):
        yield rows.filter(F.pmod(F.xxhash64("snapshot"), F.lit(slices)) == number)
    store.delete_folder(spark, kept)


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    """All-text listings with their host area, as the raw table holds them."""
    return _raw_of(spark, folder, tm.delivered_listings(spark, folder))


def _raw_of(spark: SparkSession, folder: str, delivered: DataFrame) -> DataFrame:
    return add_host_area(
        conform(delivered, "snapshot"), tm.suburb_lookup(spark, folder)
    ).select(*LISTING_COLUMNS)


def _star(spark: SparkSession, folder: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The stored raw table and the stored star schema built from it."""
    # of the raw row only what the star and its keys read is written
    raw = cut_lineage(_raw(spark, folder).select(*[f.name for f in LISTING_SCHEMA]), "raw")
    path = scratch_path(spark, "star")
    w.build_star(raw, path, by_month=False)
    return raw, w.read_star(spark, path)


def lookup_left_join(spark: SparkSession, folder: str) -> DataFrame:
    return _raw(spark, folder).select(
        "id", "year_month", "host_id", "host_neighbourhood", "host_neighbourhood_cleansed"
    )


def month_conform(spark: SparkSession, folder: str) -> DataFrame:
    """Month stamps, absent columns and a month whose columns load as blanks."""
    blanks = {199605: ["bathrooms_text", "bedrooms", "amenities"], 199606: ["bathrooms_text"]}
    conformed = conform(tm.delivered_listings(spark, folder), "snapshot", blanks)
    return conformed.select(
        "id", "host_name", "bathrooms_text", "bedrooms", "amenities", "month", "year_month", "year"
    )


def year_month_from_names(spark: SparkSession, folder: str) -> DataFrame:
    """The month number of a raw table that holds only month names and years."""
    raw = conform(tm.delivered_listings(spark, folder), "snapshot").drop("year_month")
    return with_year_month(raw).select("id", "month", "year", "year_month")


def money_parse(spark: SparkSession, folder: str) -> DataFrame:
    """Currency text with signs and brackets, and text that is none, back to amounts."""
    amount = "format_number(CAST(l_extendedprice AS decimal(12,2)), 2)"
    text = (
        f"CASE l_linenumber WHEN 1 THEN concat('($', {amount}, ')') "
        f"WHEN 2 THEN concat({amount}, '-') WHEN 3 THEN if(l_suppkey % 2 = 0, 'on request', concat('($', {amount})) "
        f"WHEN 4 THEN concat('+$98,765,432,', {amount}) "
        f"ELSE concat('$', {amount}) END AS price"
    )
    rows = read_table(spark, folder, "lineitem").selectExpr("l_orderkey", "l_linenumber", text)
    return rows.selectExpr("l_orderkey", "l_linenumber", f"double({money('price')}) AS amount")


def _quoted_csv(spark: SparkSession, folder: str) -> str:
    """The delivered listings as CSV, with quotes, commas and line breaks in a field."""
    path = scratch_path(spark, "csv")
    awkward = F.concat(F.col("amenities"), F.lit(', "wifi"\nheating'))
    delivered = tm.delivered_listings(spark, folder).select(
        "id", "host_name", awkward.alias("amenities"), "price"
    )
    delivered.write.options(header=True, quote='"', escape='"').csv(path)
    return path


def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    """A quoted CSV read by column name, missing tokens as NULL."""
    path = _quoted_csv(spark, folder)
    return read_columns(spark, path, ["id", "host_name", "amenities", "price"])


def csv_split_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The same CSV read in many small splits, so that records cross their borders."""
    path = _quoted_csv(spark, folder)
    columns = spark.read.options(**CSV_OPTIONS).csv(path).columns
    setting = "spark.sql.files.maxPartitionBytes"
    usual = spark.conf.get(setting)
    spark.conf.set(setting, "256k")
    try:
        found = cut_lineage(read_split_records(spark, [path], columns), "split-records")
    finally:
        spark.conf.set(setting, usual)
    return found.select("id", "host_name", "amenities", "price")


def _month_files(
    spark: SparkSession, folder: str, later: bool | None = None, rows: str = "true", columns: list[str] = DELIVERED_COLUMNS
) -> str:
    """The delivered listings as files named ``n_MM_YYYY.csv``; of one half of the months, or of some rows, if asked.

    ``columns`` is the files' layout; what no table supplies is missing.
    """
    delivered = tm.delivered_listings(spark, folder).filter(rows)
    layout = [F.col(c) if c in delivered.columns else F.lit(None).cast("string").alias(c) for c in columns]
    name = F.format_string("%02d_%d", F.col("snapshot") % 100, F.floor(F.col("snapshot") / 100))
    month = delivered if later is None else delivered.filter((F.col("snapshot") >= 199507) == later)
    incoming = scratch_path(spark, "incoming")
    for own in _month_slices(month):
        parts = scratch_path(spark, "csv")
        # rows move and are sorted without the layout's empty columns, in the order the writer needs
        together = own.withColumn("month_name", name).repartition("month_name").sortWithinPartitions("month_name")
        with shuffles_released(spark):
            together.select(*layout, "month_name").write.partitionBy("month_name").options(
                header=True, quote='"', escape='"').csv(parts)
        store.collect_files(spark, parts, "month_name", incoming)
    return incoming


def _lookup_file(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "lookup")
    tm.suburb_lookup(spark, folder).write.options(header=True, quote='"', escape='"').csv(path)
    return read_lookup(spark, path)


_LOADED = ["id", "year_month", "host_id", "host_neighbourhood", "host_neighbourhood_cleansed"]


def lookup_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The suburb lookup read from CSV, then joined."""
    delivered = conform(tm.delivered_listings(spark, folder), "snapshot")
    return add_host_area(delivered, _lookup_file(spark, folder)).select(*_LOADED)


def snapshot_load(spark: SparkSession, folder: str) -> DataFrame:
    """Month files loaded into the raw table at once."""
    raw = scratch_path(spark, "raw")
    load_snapshots(spark, _month_files(spark, folder), _lookup_file(spark, folder), raw)
    return read_raw(spark, raw).select(*_LOADED)


def month_load_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """The earlier files loaded as they arrive, then the later ones, then nothing new."""
    raw, progress, lookup = scratch_path(spark, "raw"), scratch_path(spark, "progress"), _lookup_file(spark, folder)
    incoming = _month_files(spark, folder, later=False)
    load_new_months(spark, incoming, lookup, raw, progress, files_per_batch=60)
    store.move_files(spark, _month_files(spark, folder, later=True), incoming)
    for _ in range(2):
        load_new_months(spark, incoming, lookup, raw, progress, files_per_batch=60)
    return read_raw(spark, raw).select(*_LOADED)


_EARLY_BLANKS = ["bathrooms_text", "bedrooms", "number_of_reviews_l30d"]
# the earlier months' layout: other order, columns that are not kept, and some of ours absent
_EARLY_LAYOUT = ["zipcode", "square_feet", *[c for c in DELIVERED_COLUMNS[::-1] if c not in _EARLY_BLANKS], "medium_url"]


def snapshot_load_layouts(spark: SparkSession, folder: str) -> DataFrame:
    """Month files of two layouts in one load; the earlier months' absent columns load as blanks."""
    incoming = _month_files(spark, folder, later=False, columns=_EARLY_LAYOUT)
    early = [month_of_file(name) for name in store.child_names(spark, incoming)]
    store.move_files(spark, _month_files(spark, folder, later=True), incoming)
    blanks = dict.fromkeys(early, _EARLY_BLANKS)  # a few dozen months
    raw = scratch_path(spark, "raw")
    load_snapshots(spark, incoming, _lookup_file(spark, folder), raw, blanks=blanks)
    return read_raw(spark, raw).select(*_LOADED, "bedrooms", "amenities")


def month_load_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """A folder kept in step: loaded, then one file delivered again, one emptied and one gone, then nothing new."""
    raw, ledger, lookup = scratch_path(spark, "raw"), scratch_path(spark, "ledger"), _lookup_file(spark, folder)
    incoming = _month_files(spark, folder)
    sync_folder(spark, incoming, lookup, raw, ledger)
    again = _month_files(spark, folder, rows="snapshot = 199503 AND CAST(id AS BIGINT) % 2 = 0")
    store.move_files(spark, again, incoming)
    header = scratch_path(spark, "csv")
    tm.delivered_listings(spark, folder).limit(0).select(
        *[F.lit(None).cast("string").alias(c) for c in DELIVERED_COLUMNS]).coalesce(1).write.options(header=True).csv(
        f"{header}/month_name=04_1995")
    emptied = scratch_path(spark, "incoming")
    store.collect_files(spark, header, "month_name", emptied)
    names = [n for n in store.child_names(spark, incoming) if n.endswith("_04_1995.csv") or n.endswith("_05_1995.csv")]
    for name in names:
        store.delete_folder(spark, f"{incoming}/{name}")
    store.move_files(spark, emptied, incoming)
    for _ in range(2):
        sync_folder(spark, incoming, lookup, raw, ledger)
    return read_raw(spark, raw).select(*_LOADED)


# --- warehouse ------------------------------------------------------------------


def dim_host(spark: SparkSession, folder: str) -> DataFrame:
    return w.dim_host(_raw(spark, folder)).select(*HOST_KEY)


def dim_property(spark: SparkSession, folder: str) -> DataFrame:
    return w.dim_property(_raw(spark, folder)).select(*PROPERTY_KEY)


def dim_time(spark: SparkSession, folder: str) -> DataFrame:
    return w.dim_time(_raw(spark, folder)).select(*TIME_KEY)


def dim_lga(spark: SparkSession, folder: str) -> DataFrame:
    return w.dim_lga(tm.lga(spark, folder))


def stored_dim_lga(spark: SparkSession, folder: str) -> DataFrame:
    """The area dimension stored once, kept by a second store, and a wrong schema refused."""
    path, raw = scratch_path(spark, "dim-lga"), tm.lga(spark, folder)
    w.store_dim_lga(raw, path)
    w.store_dim_lga(raw.withColumn("CODE_2016", F.lit("other")), path)
    try:
        w.store_dim_lga(raw.withColumn("CODE_2016", F.lit(1)), scratch_path(spark, "dim-lga"))
        refused = False
    except ValueError:
        refused = True
    return spark.read.parquet(path).withColumn("wrong_schema_refused", F.lit(refused))


_STAR_COLUMNS = [
    "id", *HOST_KEY, *PROPERTY_KEY, *TIME_KEY, "accommodates", "availability_30",
    "number_of_reviews", "review_scores_rating", "price",
]


def listing_fact(spark: SparkSession, folder: str) -> DataFrame:
    """Facts with computed keys, read back through their three dimensions."""
    _, star = _star(spark, folder)
    listings = w.listings_from_star(
        star["listing_fact"], star["dim_host"], star["dim_property"], star["dim_time"]
    )
    return _comparable(listings.select(*_STAR_COLUMNS))


def listing_fact_by_join(spark: SparkSession, folder: str) -> DataFrame:
    """Facts by natural-key joins on the five-column host key, read back through the hosts."""
    raw, star = _star(spark, folder)
    dim = star["dim_host"]
    fact = w.listing_fact_by_join(raw, dim, star["dim_property"], star["dim_time"])
    return _comparable(
        w.listings_from_star(fact, dim).select(
            "id", "year_month", "host_id", "host_neighbourhood_cleansed", "price"
        )
    )


def star_add_months(spark: SparkSession, folder: str) -> DataFrame:
    """A star built from the earlier years, then brought up to date with the later ones.

    The months added overlap the months built by one year.
    """
    stored = scratch_path(spark, "raw")
    for own in _month_slices(tm.delivered_listings(spark, folder)):
        # rows of a month together, so that few tasks write each month; a large one is split
        by_month = _raw_of(spark, folder, own.hint("rebalance", F.col("snapshot")))
        with shuffles_released(spark):
            by_month.write.mode("append").parquet(stored)
    raw = spark.read.schema(RAW_LISTING_SCHEMA).parquet(stored)
    path = scratch_path(spark, "star")
    w.build_star(raw.filter("year <= '1998'"), path)
    w.add_months(raw.filter("year >= '1998'"), path)
    star = w.read_star(spark, path)
    listings = w.listings_from_star(star["listing_fact"], star["dim_host"], None, star["dim_time"])
    return listings.groupBy(*m.AREA, "month", "host_neighbourhood_cleansed").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("price").cast("double").alias("prices")
    )


def star_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Months with a fraction and an unparsable price are refused, then taken with those as missing.

    ``kept`` rows were there after the refusal, ``rows`` after the values were allowed.
    """
    by_month = _raw(spark, folder).select(*[f.name for f in LISTING_SCHEMA]).hint("rebalance", F.col("year_month"))
    raw = cut_lineage(by_month, "raw")
    path = scratch_path(spark, "star")
    w.build_star(raw.filter("year < '1998'"), path)
    spoiled = raw.filter("year >= '1997'").withColumns(
        {
            "accommodates": F.when(F.col("room_type") == "R", "2.5").otherwise(F.col("accommodates")),
            "price": F.when(F.col("number_of_reviews") == "1.0", "on request").otherwise(F.col("price")),
        }
    )
    try:
        w.add_months(spoiled, path)
        refused = False
    except ValueError:
        refused = True
    fact = w.read_star(spark, path)["listing_fact"]
    kept = cut_lineage(fact.groupBy("year_month").agg(F.count(F.lit(1)).alias("kept")), "kept")
    w.add_months(spoiled, path, allow_rejects=True)
    after = w.read_star(spark, path)["listing_fact"].groupBy("year_month").agg(
        F.count(F.lit(1)).alias("rows"), F.count("accommodates").alias("with_guests"), F.count("price").alias("with_price"))
    return after.join(kept, "year_month", "left").withColumn("refused", F.lit(refused))


def star_host_parts(spark: SparkSession, folder: str) -> DataFrame:
    """The host dimension after a month with one host renamed, and whether that rewrote no part but the host's."""
    raw = cut_lineage(_raw(spark, folder).select(*[f.name for f in LISTING_SCHEMA]), "raw")
    path = scratch_path(spark, "star")
    w.build_star(raw, path)
    month = raw.filter("year_month = '199806'")
    first = month.agg(F.min(F.col("host_id").cast("int"))).first()[0]
    renamed = F.when(F.col("host_id") == str(first), "Renamed").otherwise(F.col("host_name"))
    rewritten = w.add_months(month.withColumn("host_name", renamed), path)["dim_host"]
    dim = w.read_star(spark, path)["dim_host"]
    # a suburb in two areas makes a host two rows
    return dim.select(*HOST_KEY, F.lit(1 <= len(rewritten) <= 2).alias("own_parts_only"))


def star_active_rate(spark: SparkSession, folder: str) -> DataFrame:
    """The active rate per area from the star schema."""
    _, star = _star(spark, folder)
    listings = w.listings_from_star(star["listing_fact"], star["dim_host"], star["dim_property"])
    return _comparable(m.active_rate(listings, m.AREA))


def star_bucketed_rate(spark: SparkSession, folder: str) -> DataFrame:
    """The active rate per area from facts and hosts bucketed by host key, joined where they are."""
    raw = cut_lineage(_raw(spark, folder).select(*[f.name for f in LISTING_SCHEMA]), "raw")
    path = scratch_path(spark, "bucketed")
    names = w.store_bucketed_star(raw, path, path.rsplit("/", 1)[-1].replace("-", "_"), 16)
    properties = w.dim_property(raw)
    listings = w.listings_from_star(spark.table(names["listing_fact"]), spark.table(names["dim_host"]), properties)
    return _comparable(m.active_rate(listings, m.AREA))


def _month_parts(spark: SparkSession, folder: str) -> str:
    """Month parts of all listings; the last year is stored twice, as a reload would."""
    # each store reads its listings several times: joined once, written narrow
    facts = cut_lineage(tm.listings(
        spark, folder, "neighbourhood_cleansed", "year_month", "price", "host_id", "host_is_superhost"), "facts")
    path = scratch_path(spark, "month-parts")
    keys = ["neighbourhood_cleansed"]
    month_parts.store_month_parts(facts.filter("year_month < 199801"), path, keys)
    month_parts.store_month_parts(facts.filter("year_month BETWEEN 199701 AND 199712"), path, keys)
    month_parts.store_month_parts(facts.filter("year_month >= 199801"), path, keys)
    return path


def span_price_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Price statistics per area over three years, merged from the months' histograms."""
    return _comparable(month_parts.prices_between(
        spark, _month_parts(spark, folder), ["neighbourhood_cleansed"], 199601, 199812))


def span_distinct_hosts(spark: SparkSession, folder: str) -> DataFrame:
    """Different hosts and share of superhosts per area over three years, merged from the months' bitmaps."""
    return _comparable(month_parts.hosts_between(
        spark, _month_parts(spark, folder), ["neighbourhood_cleansed"], 199601, 199812))


def census_fact(spark: SparkSession, folder: str) -> DataFrame:
    return _comparable(_census(spark, folder).drop("abs_id"))


# --- audits ---------------------------------------------------------------------


def audit_unique(spark: SparkSession, folder: str) -> DataFrame:
    key = ["id", "year_month"]
    return audit.duplicate_keys(tm.listings(spark, folder, *key), key)


def audit_fk(spark: SparkSession, folder: str) -> DataFrame:
    """Facts whose host is missing from a dimension that holds superhosts only."""
    raw = _raw(spark, folder)
    superhosts = w.dim_host(raw.filter(F.col("host_is_superhost") == "t"))
    found = audit.orphans(w.listing_fact(raw), superhosts, ["h_id"])
    return _comparable(found.select("id", "year_month", "price"))


def audit_not_null(spark: SparkSession, folder: str) -> DataFrame:
    required = ["id", "host_id", "host_name", "host_neighbourhood", "review_scores_rating", "price"]
    return audit.null_counts(w.typed_listings(_raw(spark, folder)), required)


def audit_casts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows whose texts do not parse, where some prices and counts are spoiled."""
    spoiled = _raw(spark, folder).withColumns(
        {
            "price": F.when(F.col("number_of_reviews") == "1.0", "on request").otherwise(F.col("price")),
            "accommodates": F.when(F.col("room_type") == "R", "2.5").otherwise(F.col("accommodates")),
        }
    )
    found = audit.cast_rejects(spoiled, w.parse, w.PARSED_COLUMNS)
    return found.select(
        "id", "year_month", "host_neighbourhood_cleansed",
        F.array_join("rejected_columns", ",").alias("rejected_columns"),
    )


def audit_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Violations per rule over the built warehouse."""
    _, star = _star(spark, folder)
    fact, people, properties = star["listing_fact"], star["dim_host"], star["dim_property"]
    times, census = star["dim_time"], _census(spark, folder)
    return audit.violation_summary(
        {
            "host_key_unique": audit.duplicate_keys(people, ["h_id"]),
            "property_key_unique": audit.duplicate_keys(properties, ["p_id"]),
            "fact_host_exists": audit.orphans(fact, people, ["h_id"]),
            "fact_property_exists": audit.orphans(fact, properties, ["p_id"]),
            "census_code_unique": audit.duplicate_keys(census, ["LGA_CODE_2016"]),
            "time_key_unique": audit.duplicate_keys(times, ["t_id"]),
            "fact_key_unique": audit.duplicate_keys(fact, ["f_id"]),
            "fact_time_exists": audit.orphans(fact, times, ["t_id"]),
            "fact_keys_not_null": audit.null_rows(fact, ["h_id", "p_id", "t_id"]),
            "census_code_not_null": audit.null_rows(census, ["LGA_CODE_2016"]),
            # the same rules where there is something to find
            "spoiled_time_key_unique": audit.duplicate_keys(times.unionByName(times), ["t_id"]),
            "spoiled_fact_key_unique": audit.duplicate_keys(
                fact.unionByName(fact.filter("accommodates = 1")), ["f_id"]),
            "spoiled_fact_time_exists": audit.orphans(fact, times.filter("year <> 1996"), ["t_id"]),
            "spoiled_fact_keys_not_null": audit.null_rows(
                fact.withColumn("h_id", F.when(F.col("accommodates") > 2, F.col("h_id"))), ["h_id", "p_id"]),
        }
    )


# --- stored tables --------------------------------------------------------------


def upsert_dim(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as hosts, then a second version with renamed and additional hosts."""
    people = read_table(spark, folder, "customer")
    suppliers = read_table(spark, folder, "supplier")
    key = F.col("c_custkey").cast("string").alias("host_id")
    old = people.select(key, F.col("c_name").alias("host_name"), F.lit("f").alias("host_is_superhost"))
    renamed = people.filter(F.col("c_acctbal") > 5000).select(
        key,
        F.concat(F.lit("New "), F.col("c_name")).alias("host_name"),
        F.lit("t").alias("host_is_superhost"),
    )
    added = suppliers.select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("host_id"),
        F.col("s_name").alias("host_name"),
        F.lit("f").alias("host_is_superhost"),
    )
    table = scratch_path(spark, "dim-host")
    store.write_version(old, table)
    current = store.read_version(spark, table)
    store.write_version(upsert(current, renamed.unionByName(added), ["host_id"]), table)
    return store.read_version(spark, table)


def stored_view(spark: SparkSession, folder: str) -> DataFrame:
    """A result stored from the active listings only, kept by create, replaced by refresh."""
    name = "question_1_8_no_of_stays"
    everything = tm.listings(spark, folder, *AREA_FACTS, *STAYS, "has_availability", "review_scores_rating")
    active = everything.filter(F.col("has_availability") == "t")
    path = scratch_path(spark, "datamart")
    datamart.create_stored(datamart.Inputs(active), path, [name])
    datamart.create_stored(datamart.Inputs(everything), path, [name])
    kept = datamart.read_stored(spark, path, name).select(
        *AREA_FACTS, F.col("number_of_stays").alias("kept_stays")
    )
    kept.write.parquet(f"{path}/kept")
    datamart.refresh_stored(datamart.Inputs(everything), path, [name])
    refreshed = datamart.read_stored(spark, path, name)
    return refreshed.select(*AREA_FACTS, "number_of_stays").join(spark.read.parquet(f"{path}/kept"), list(AREA_FACTS), "left")


def _after_month_refresh(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A result stored from active listings, then two months brought up to date from all."""
    everything = tm.listings(spark, folder, *AREA_FACTS, *STAYS, "has_availability", "review_scores_rating")
    active = everything.filter(F.col("has_availability") == "t")
    path = scratch_path(spark, "datamart")
    datamart.create_stored(datamart.Inputs(active), path, [name])
    datamart.refresh_stored_months(datamart.Inputs(everything), path, [199701, 199902], [name])
    return datamart.read_stored(spark, path, name)


def month_refresh(spark: SparkSession, folder: str) -> DataFrame:
    return _after_month_refresh(spark, folder, "question_1_8_no_of_stays").select(*AREA_FACTS, "number_of_stays")


def month_refresh_rate(spark: SparkSession, folder: str) -> DataFrame:
    found = _after_month_refresh(spark, folder, "question_1_1_active_listings_rate")
    return found.select(*AREA_FACTS, "active_listings", "total_listings")


def raw_append(spark: SparkSession, folder: str) -> DataFrame:
    """Appending the same rows twice keeps both; replacing by month keeps one."""
    rows = tm.listings(spark, folder, "id", "year_month", "price")
    path = scratch_path(spark, "raw")
    store.append_rows(rows, f"{path}/appended", ["year_month"])
    store.append_rows(rows, f"{path}/appended", ["year_month"])
    store.replace_partitions(rows, f"{path}/replaced", ["year_month"])
    store.replace_partitions(rows, f"{path}/replaced", ["year_month"])

    def per_month(table: str) -> DataFrame:
        stored = spark.read.parquet(f"{path}/{table}")
        return stored.groupBy("year_month").agg(F.count(F.lit(1)).alias(f"{table}_rows"))

    return per_month("appended").join(per_month("replaced"), "year_month")


def view_in_sql(spark: SparkSession, folder: str) -> DataFrame:
    """A result used by name in SQL."""
    name = "question_1_1_active_listings_rate"
    facts = tm.listings(spark, folder, *AREA_FACTS, "has_availability")
    datamart.register_views(datamart.Inputs(facts), [name])
    return spark.sql(
        f"SELECT year_month, sum(active_listings) AS active, sum(total_listings) AS total "
        f"FROM {name} GROUP BY year_month"
    )


# --- inspection -----------------------------------------------------------------


def cover_count_all_hosts(spark: SparkSession, folder: str) -> DataFrame:
    """How many of all hosts' revenues cover how many of their areas' mortgages, counted without pairs."""
    return hosts.mortgage_cover_count(tm.host_listings(spark, folder), tm.lga(spark, folder), _census(spark, folder))


def table_counts(spark: SparkSession, folder: str) -> DataFrame:
    names = ["lineitem", "orders", "customer", "supplier", "part", "nation", "region"]
    return row_counts({n: read_table(spark, folder, n) for n in names})


def table_preview(spark: SparkSession, folder: str) -> DataFrame:
    facts = tm.listings(spark, folder, "host_id", "neighbourhood_cleansed", "year_month", "id", "price")
    return _comparable(preview(facts, 20, ["id", "year_month", "price", "host_id"]))


def ordered_stays(spark: SparkSession, folder: str) -> DataFrame:
    """A result in its presentation order: several keys, ascending."""
    facts = tm.listings(spark, folder, *AREA_FACTS, *STAYS)
    return datamart.view("question_1_8_no_of_stays", datamart.Inputs(facts), ordered=True)


def ordered_cover(spark: SparkSession, folder: str) -> DataFrame:
    """A result in its presentation order: descending."""
    inputs = datamart.Inputs(
        tm.host_listings(spark, folder), tm.lga(spark, folder), _census(spark, folder)
    )
    return _comparable(datamart.view("q4_d_2_revenue_cover_mortgage", inputs, ordered=True))


def all_queries() -> dict[str, Query]:
    jobs = [
        lookup_csv, snapshot_load, snapshot_load_layouts, month_load_incremental, month_load_ledger,
        lookup_left_join, month_conform, year_month_from_names, money_parse, csv_scan, csv_split_scan,
        dim_host, dim_property, dim_time, dim_lga, stored_dim_lga, listing_fact, listing_fact_by_join,
        star_add_months, star_rejects, star_host_parts, star_active_rate, star_bucketed_rate,
        span_price_stats, span_distinct_hosts, census_fact,
        audit_unique, audit_fk, audit_not_null, audit_casts, audit_summary,
        cover_count_all_hosts, upsert_dim, stored_view, month_refresh, month_refresh_rate, raw_append, view_in_sql,
        table_counts, table_preview, ordered_stays, ordered_cover,
    ]
    return (
        _views()
        | {
            f"pct_change_by_group_{grain_name}_{name}": _change_by_group(grain, flag)
            for grain_name, grain in (("area", m.AREA), ("property", m.PROPERTY))
            for name, flag in (("active", "t"), ("inactive", "f"))
        }
        | {job.__name__: job for job in jobs}
    )
