"""Monthly listing snapshots: CSV files named ``MM_YYYY.csv`` into one all-text table."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.joins import null_safe_join
from ..functions.parsing import missing_to_null
from ..schemas import BLANK_COLUMNS_BY_MONTH, LISTING_COLUMNS, MONTH_NAMES, text_schema
from ..session import small_methods
from ..sinks.store import check_schema, delete_folder, partition_folder, replace_partitions
from .split_csv import read_split_records

CSV_OPTIONS = {"header": True, "sep": ",", "quote": '"', "escape": '"', "multiLine": True}

LOADER_COLUMNS = ["month", "year_month", "year", "host_neighbourhood_cleansed"]
DELIVERED_COLUMNS = [c for c in LISTING_COLUMNS if c not in LOADER_COLUMNS]
SOURCE = "source_file"
RAW_PARTITIONS = ["year_month", SOURCE]
RAW_TABLE_SCHEMA = text_schema(LISTING_COLUMNS + [SOURCE])

_FILE_NAME = r"(\d{2})_(\d{4})\.csv"  # a prefix may name the source

# Files above this size are read in splits: all of them, so that the size changes no result.
SPLIT_ABOVE_BYTES = 0


def month_of_file(path: str) -> int:
    """``202005`` for ``.../05_2020.csv``."""
    found = re.search(_FILE_NAME + "$", path)
    if not found:
        raise ValueError(f"listing file is not named MM_YYYY.csv: {path}")
    return int(found[2]) * 100 + int(found[1])


def month_columns(year_month: str) -> dict[str, str]:
    """SQL text of the three text columns that stamp a row with its month."""
    names = ", ".join(f"'{m}'" for m in MONTH_NAMES)
    return {
        "month": f"element_at(array({names}), int({year_month} % 100))",
        "year_month": f"string({year_month})",
        "year": f"string({year_month} div 100)",
    }


def year_month_of_name(column: str) -> str:
    """SQL text of the month in a file name column."""
    return f"int(concat({', '.join(f"regexp_extract({column}, r'{_FILE_NAME}', {g})" for g in (2, 1))}))"


def with_year_month(raw: DataFrame) -> DataFrame:
    """A raw table without ``year_month`` gets it from its month name and year."""
    names = ", ".join(f"'{m}'" for m in MONTH_NAMES)
    month = f"array_position(array({names}), month)"
    return raw.withColumn("year_month", F.expr(f"string(int(year) * 100 + {month})"))


def conform(
    delivered: DataFrame,
    year_month: str,
    blanks: dict[int, list[str]] = BLANK_COLUMNS_BY_MONTH,
) -> DataFrame:
    """Missing tokens to NULL, months' unusable columns to ``""``, fixed column list.

    ``year_month`` is SQL text of the snapshot's month as a number.
    """
    present = {c.lower() for c in delivered.columns}

    def value(column: str) -> str:
        text = missing_to_null(column) if column.lower() in present else "string(NULL)"
        months = ", ".join(str(m) for m, columns in blanks.items() if column in columns)
        return f"CASE WHEN {year_month} IN ({months}) THEN '' ELSE {text} END" if months else text

    kept = {c: value(c) for c in DELIVERED_COLUMNS} | month_columns(year_month)
    extra = [c for c in (SOURCE,) if c in delivered.columns]
    return small_methods(delivered).selectExpr(*[f"{v} AS `{c}`" for c, v in kept.items()], *extra)


def add_host_area(listings: DataFrame, lookup: DataFrame) -> DataFrame:
    """Left join of the suburb lookup; a suburb with two areas gives two rows.

    A missing suburb matches a missing suburb in the lookup, as it does in the frames
    this load is defined on.
    """
    areas = lookup.selectExpr(
        f"{missing_to_null('host_neighbourhood')} AS host_neighbourhood",
        f"{missing_to_null('LGA')} AS host_neighbourhood_cleansed",
    )
    return null_safe_join(listings, areas, ["host_neighbourhood"], "left")


def ambiguous_suburbs(lookup: DataFrame) -> DataFrame:
    """Suburbs the lookup maps to several areas, which multiply their listings."""
    return (
        lookup.groupBy("host_neighbourhood")
        .agg(F.count(F.lit(1)).alias("areas"))
        .filter(F.col("areas") > 1)
    )


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.options(**CSV_OPTIONS).csv(path).select("host_neighbourhood", "LGA")


def _files(spark: SparkSession, paths: list[str]) -> dict[str, int]:
    """Size of each file by path; only the listing is read. A name may occur once."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(paths)
    sizes = {r.path: r.length for r in listed.select("path", "length").collect()}
    if not sizes:
        raise FileNotFoundError(f"no listing files under {paths}")
    names = [file_name(path) for path in sizes]
    twice = sorted({n for n in names if names.count(n) > 1}) if len(set(names)) < len(names) else []
    if twice:
        raise ValueError(f"a file is known by its name, which must be unique: {twice}")
    return sizes


def _by_header(spark: SparkSession, files: Iterable[str]) -> dict[tuple[str, ...], list[str]]:
    """Files grouped by header line, so that each layout is one scan by position.

    The files of a month share a layout, so one header per month is looked at; the scan
    checks every file's header against it.
    """
    months, layouts = defaultdict(list), defaultdict(list)
    for path in files:
        months[month_of_file(path)].append(path)
    for of_month in months.values():
        probe = spark.read.options(**(CSV_OPTIONS | {"multiLine": False})).csv(of_month[0])
        layouts[tuple(c.lstrip("\ufeff") for c in probe.columns)] += of_month
    return layouts


def read_snapshots(
    spark: SparkSession,
    paths: str | list[str],
    lookup: DataFrame,
    missing_text: str | None = None,
    blanks: dict[int, list[str]] = BLANK_COLUMNS_BY_MONTH,
    split_above: int = SPLIT_ABOVE_BYTES,
) -> DataFrame:
    """All given month files as one frame of the fixed columns plus the file name.

    ``missing_text="NaN"`` stores missing values as that text instead of NULL. ``blanks``
    names columns, by month, that a month may lack and that load as blanks. Files of up to
    ``split_above`` bytes go through Spark's own reader, a task each, which takes a quote
    that is never closed as part of the text; the others are read in splits and such a
    quote fails.
    """
    sizes = _files(spark, [paths] if isinstance(paths, str) else paths)
    scans = []
    for header, layout in _by_header(spark, sizes).items():
        for path in layout:
            blank = blanks.get(month_of_file(path), [])
            absent = [c for c in DELIVERED_COLUMNS if c not in header and c not in blank]
            if absent:
                raise ValueError(f"{path} lacks columns {absent}")
        small = [p for p in layout if sizes[p] <= split_above]
        large = [p for p in layout if sizes[p] > split_above]
        if small:
            checked = CSV_OPTIONS | {"enforceSchema": False}
            reader = spark.read.options(**checked).schema(text_schema(list(header)))
            scans.append(reader.csv(small).select("*", F.col("_metadata.file_name").alias(SOURCE)))
        if large:
            records = read_split_records(spark, large, list(header))
            name = F.element_at(F.split("file_path", "/"), -1).alias(SOURCE)
            scans.append(records.select(*header, name))
    months = [conform(scan, year_month_of_name(SOURCE), blanks) for scan in scans]
    together = months[0]
    for more in months[1:]:
        together = together.unionByName(more)
    placed = add_host_area(together, lookup).select(*LISTING_COLUMNS, SOURCE)
    return placed.fillna(missing_text) if missing_text is not None else placed


def load_snapshots(
    spark: SparkSession,
    paths: str | list[str],
    lookup: DataFrame,
    raw_path: str,
    missing_text: str | None = None,
    blanks: dict[int, list[str]] = BLANK_COLUMNS_BY_MONTH,
) -> None:
    """Load month files into the raw table; loading a file again replaces its rows.

    A file without rows leaves none of the rows that were loaded from it before.
    """
    files = _files(spark, [paths] if isinstance(paths, str) else paths)
    snapshots = read_snapshots(spark, paths, lookup, missing_text, blanks)
    replace_partitions(
        check_schema(snapshots, RAW_TABLE_SCHEMA), raw_path, RAW_PARTITIONS, [partition_of(path) for path in files])


def partition_of(path: str) -> tuple[str, str]:
    """The partition of the raw table that holds a file's rows."""
    return str(month_of_file(path)), file_name(path)


def file_name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def retract_files(spark: SparkSession, raw_path: str, names: Iterable[str]) -> None:
    """Removes the rows loaded from the files of these names."""
    for name in names:
        delete_folder(spark, f"{raw_path}/{partition_folder(spark, RAW_PARTITIONS, partition_of(name))}")


def read_raw_sources(spark: SparkSession, raw_path: str) -> DataFrame:
    """The raw table with the file each row came from."""
    return spark.read.schema(RAW_TABLE_SCHEMA).parquet(raw_path)


def read_raw(spark: SparkSession, raw_path: str) -> DataFrame:
    """The raw table; a filter on ``year_month`` reads only those folders."""
    return read_raw_sources(spark, raw_path).select(*LISTING_COLUMNS)
