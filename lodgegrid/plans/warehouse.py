"""From all-text raw tables to typed listings, the star schema and the census fact."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.joins import null_safe_join
from ..functions.keys import surrogate_key
from ..functions.parsing import money, number, rating, whole_number
from ..schemas import (
    CENSUS_CODE,
    CENSUS_FACT_COUNTS,
    CENSUS_FACT_SCHEMA,
    CENSUS_MEDIANS,
    DIM_LGA_SCHEMA,
    HOST_KEY,
    LISTING_SCHEMA,
    PROPERTY_KEY,
    TIME_KEY,
)
from ..session import small_methods
from ..sinks.bucketed import store_bucketed
from ..sinks.keyed import merge_keyed, read_keyed, write_keyed
from ..sinks.store import check_schema, materialize, replace_partitions, replace_table
from ..sources.listings_csv import read_raw_sources

# The load matches a raw row to its host without the last host column.
HOST_MATCH_KEY = HOST_KEY[:-1]

_PARSERS = {
    "id": lambda c: whole_number(c, "bigint"),
    "year_month": whole_number,
    "year": whole_number,
    "accommodates": whole_number,
    "availability_30": whole_number,
    "number_of_reviews": whole_number,
    "review_scores_rating": rating,
    "price": money,
}
MEASURES = ["accommodates", "availability_30", "number_of_reviews", "review_scores_rating", "price"]
PARSED_COLUMNS = list(_PARSERS)


def parse(column: str) -> str:
    """SQL text of a raw column's typed value."""
    return _PARSERS[column](column) if column in _PARSERS else f"`{column}`"


def parse_or_fail(column: str) -> str:
    """SQL text of a raw column's typed value; a present value that does not parse ends the job."""
    if column not in _PARSERS:
        return parse(column)
    refusal = f"raise_error(concat('{_REFUSED} {column}: ', `{column}`))"
    return f"coalesce({parse(column)}, CASE WHEN `{column}` <> 'NaN' THEN {refusal} END)"


_REFUSED = "a value that does not parse in"


@contextmanager
def _refusals() -> Iterator[None]:
    """What ``parse_or_fail`` refuses, as a ValueError."""
    try:
        yield
    except PySparkException as failure:
        found = re.search(f"{_REFUSED} [^\n]*", str(failure))
        if not found:
            raise
        raise ValueError(found[0]) from failure


def typed_listings(raw: DataFrame, parser: Callable[[str], str] = parse) -> DataFrame:
    """The listing frame the metrics read: 18 typed columns of the raw table.

    Joining the fact back to its dimensions gives the same rows, since the dimensions
    are distinct parts of the raw rows; this form needs no join, and the scan reads
    only the columns a metric uses.
    """
    return small_methods(raw).selectExpr(*[f"{parser(f.name)} AS {f.name}" for f in LISTING_SCHEMA])


def store_listings(
    raw: DataFrame, path: str, allow_rejects: bool = False, months: Iterable[int] = ()
) -> None:
    """Parse the raw rows once and store the typed frame by month.

    Replaces the months ``raw`` holds, which must be there in full, with all their
    sources; :func:`store_months` sees to that. Of ``months``, those without rows are
    removed. Values that do not parse are refused unless allowed, and then stored as
    missing; a refused load leaves the table as it was.
    """
    typed = typed_listings(raw, parse if allow_rejects else parse_or_fail)
    with _refusals():
        replace_partitions(
            check_schema(typed, LISTING_SCHEMA), path, ["year_month"], [(month,) for month in months])


def store_months(spark: SparkSession, raw_path: str, path: str, months: list[int], allow_rejects: bool = False) -> None:
    """:func:`store_listings` for whole months of the raw table."""
    store_listings(_raw_months(spark, raw_path, months), path, allow_rejects, months)


def _raw_months(spark: SparkSession, raw_path: str, months: list[int]) -> DataFrame:
    return read_raw_sources(spark, raw_path).filter(F.col("year_month").isin([str(month) for month in months]))


def read_listings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LISTING_SCHEMA).parquet(path)


def dim_host(raw: DataFrame) -> DataFrame:
    return raw.select(*HOST_KEY).distinct().select(surrogate_key(*HOST_KEY).alias("h_id"), "*")


def dim_property(raw: DataFrame) -> DataFrame:
    return (
        raw.select(*PROPERTY_KEY)
        .distinct()
        .select(surrogate_key(*PROPERTY_KEY).alias("p_id"), "*")
    )


def dim_time(raw: DataFrame) -> DataFrame:
    """Keyed by the typed values, so ``'2020'`` and ``'2020.0'`` are one month."""
    return (
        raw.selectExpr(*[f"{parse(c)} AS {c}" for c in TIME_KEY])
        .distinct()
        .select(surrogate_key(*TIME_KEY).alias("t_id"), "*")
    )


def listing_fact(raw: DataFrame, parser: Callable[[str], str] = parse) -> DataFrame:
    """One fact row per raw row, with keys computed from the row itself: no shuffle.

    ``f_id`` is a key of all columns of the raw row, the source file included where ``raw``
    has it (:func:`lodgegrid.sources.listings_csv.read_raw_sources`); exact repeats of a row
    share it and appear in the uniqueness audit.
    """
    typed = small_methods(raw).select(
        surrogate_key(*raw.columns).alias("f_id"),
        *[F.expr(f"{parser(f.name)} AS {f.name}") for f in LISTING_SCHEMA],
    )
    return typed.select(
        "f_id",
        "id",
        surrogate_key(*HOST_KEY).alias("h_id"),
        surrogate_key(*PROPERTY_KEY).alias("p_id"),
        surrogate_key(*TIME_KEY).alias("t_id"),
        *MEASURES,
        "year_month",
    )


def listing_fact_by_join(
    raw: DataFrame,
    hosts: DataFrame,
    properties: DataFrame,
    times: DataFrame,
    host_key: list[str] = HOST_MATCH_KEY,
    time_key: list[str] = TIME_KEY,
) -> DataFrame:
    """The fact by joining raw rows to the dimensions on their natural keys.

    With the default five-column host key, a raw row whose suburb maps to several areas
    meets each of those host rows again, as in the original load. With ``HOST_KEY`` it
    meets exactly one and the result has the rows of :func:`listing_fact`. ``time_key``
    may leave out ``year_month``: month name and year already tell months apart.
    """
    typed = typed_listings(raw)
    matched = null_safe_join(typed, hosts.select("h_id", *host_key), host_key)
    matched = null_safe_join(matched, properties, PROPERTY_KEY)
    matched = null_safe_join(matched, times.select("t_id", *time_key), time_key)
    return matched.select("id", "h_id", "p_id", "t_id", *MEASURES, "year_month")


def listings_from_star(
    fact: DataFrame,
    hosts: DataFrame | None = None,
    properties: DataFrame | None = None,
    times: DataFrame | None = None,
) -> DataFrame:
    """Fact joined to the given dimensions by surrogate key.

    Pass only the dimensions a metric reads: each fact row has exactly one row in every
    dimension, so a join whose columns go unused changes nothing and costs a shuffle.
    """
    joined = fact
    if properties is not None:
        joined = joined.join(properties, "p_id")
    if times is not None:
        joined = joined.drop("year_month").join(times, "t_id")
    if hosts is not None:
        joined = joined.join(hosts, "h_id")
    return joined


# what builds a dimension, its key, and the parts it is stored in
DIMENSIONS = {
    "dim_host": (dim_host, "h_id", 64),
    "dim_property": (dim_property, "p_id", 4),
    "dim_time": (dim_time, "t_id", 1),
}
FACT = "listing_fact"


def build_star(
    raw: DataFrame, folder: str, by_month: bool = True, allow_rejects: bool = False, parts: dict[str, int] | None = None
) -> None:
    """Write the dimensions and the fact from all raw rows.

    ``by_month`` puts the fact in one folder per month. Tasks write a file per month
    they hold rows of, so it suits a raw table that is stored by month itself. ``parts``
    overrides how many parts a dimension is stored in. Values that do not parse are refused
    unless allowed, and then stored as missing; a refused build leaves the fact as it was.
    """
    by = ["year_month"] if by_month else []
    for name, (build, key, usual) in DIMENSIONS.items():
        write_keyed(build(raw), f"{folder}/{name}", [key], (parts or {}).get(name, usual))
    with _refusals():
        replace_table(listing_fact(raw, parse if allow_rejects else parse_or_fail), f"{folder}/{FACT}", by)


def add_months(
    raw_months: DataFrame, folder: str, allow_rejects: bool = False, months: Iterable[int] = ()
) -> dict[str, list[int]]:
    """Bring new or reloaded months, each in full, into a star built ``by_month``.

    Dimension rows are merged by key, which rewrites the parts of a dimension that new
    keys fall in, and the months' fact rows replace what the fact held for them. Of
    ``months``, those without rows are removed from the fact. Running it again changes
    nothing. Values that do not parse are refused before the fact changes, unless allowed.
    Gives the parts rewritten by dimension.
    """
    rewritten = {
        name: merge_keyed(build(raw_months), f"{folder}/{name}") for name, (build, _, _) in DIMENSIONS.items()}
    fact = listing_fact(raw_months, parse if allow_rejects else parse_or_fail)
    with _refusals():
        replace_partitions(fact, f"{folder}/{FACT}", ["year_month"], [(month,) for month in months])
    return rewritten


def add_raw_months(spark: SparkSession, raw_path: str, folder: str, months: list[int]) -> None:
    """:func:`add_months` for whole months of the raw table."""
    add_months(_raw_months(spark, raw_path, months), folder, months=months)


def read_star(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The stored tables; their measured sizes let Spark broadcast what is small."""
    star = {name: read_keyed(spark, f"{folder}/{name}") for name in DIMENSIONS}
    return star | {FACT: spark.read.parquet(f"{folder}/{FACT}")}


def store_bucketed_star(raw: DataFrame, folder: str, prefix: str, buckets: int) -> dict[str, str]:
    """The fact and its host dimension as catalog tables bucketed by host key, so that their join
    moves neither; names of the two tables. All rows of a host are one task's work in it."""
    tables = {"dim_host": dim_host(raw), FACT: listing_fact(raw)}
    for name, table in tables.items():
        store_bucketed(table, f"{prefix}_{name}", f"{folder}/{name}", "h_id", buckets)
    return {name: f"{prefix}_{name}" for name in tables}


def dim_lga(lga_raw: DataFrame) -> DataFrame:
    return lga_raw.select(*[F.col(c).alias(c.lower()) for c in lga_raw.columns])


def store_dim_lga(lga_raw: DataFrame, path: str) -> None:
    """Store the area dimension unless it is stored already."""
    materialize(check_schema(dim_lga(lga_raw), DIM_LGA_SCHEMA), path)


def census_fact(counts_raw: DataFrame, medians_raw: DataFrame, lga: DataFrame) -> DataFrame:
    """Counts, medians and area name per census code, typed."""
    counts = counts_raw.selectExpr(
        CENSUS_CODE, *[f"{whole_number(c, 'bigint')} AS {c}" for c in CENSUS_FACT_COUNTS]
    )
    medians = medians_raw.selectExpr(
        CENSUS_CODE, *[f"{number(c, 'decimal(12,4)')} AS {c}" for c in CENSUS_MEDIANS]
    )
    names = lga.select(F.col("code_2016").alias(CENSUS_CODE), "lga_name")
    joined = counts.join(medians, CENSUS_CODE).join(names, CENSUS_CODE)
    keyed = joined.withColumn("abs_id", surrogate_key(CENSUS_CODE, "lga_name"))
    return keyed.select(*[f.name for f in CENSUS_FACT_SCHEMA])
