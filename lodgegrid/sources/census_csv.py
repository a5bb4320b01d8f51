"""Census and area-list CSVs: quoted, comma separated, all text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.parsing import missing_to_null
from ..schemas import CENSUS_COUNT_COLUMNS, CENSUS_MEDIAN_COLUMNS, LGA_COLUMNS
from .listings_csv import CSV_OPTIONS


def read_columns(
    spark: SparkSession, path: str, columns: list[str], missing_text: str | None = None
) -> DataFrame:
    """The named columns of a CSV, wherever its header puts them."""
    delivered = spark.read.options(**CSV_OPTIONS).csv(path)
    named = delivered.selectExpr(*[f"{missing_to_null(c)} AS `{c}`" for c in columns])
    return named if missing_text is None else named.fillna(missing_text)


def read_census_counts(spark: SparkSession, path: str, missing_text: str | None = None) -> DataFrame:
    return read_columns(spark, path, CENSUS_COUNT_COLUMNS, missing_text)


def read_census_medians(spark: SparkSession, path: str, missing_text: str | None = None) -> DataFrame:
    return read_columns(spark, path, CENSUS_MEDIAN_COLUMNS, missing_text)


def read_lga_list(spark: SparkSession, path: str, missing_text: str | None = None) -> DataFrame:
    return read_columns(spark, path, LGA_COLUMNS, missing_text)
