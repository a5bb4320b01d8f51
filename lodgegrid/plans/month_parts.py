"""Stored month parts of prices and hosts, and results over spans of months from them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import metrics as m, spans
from ..sinks.store import replace_partitions

_BY = [m.TIME]


def store_month_parts(listings: DataFrame, folder: str, keys: list[str], months: Iterable[int] = ()) -> None:
    """Store the price histogram and the host bitmaps of the months in ``listings``, by ``keys`` and month.

    Replaces the months ``listings`` holds, which must be there in full; of ``months``, those without
    rows are removed. Hosts get numbers that they keep.
    """
    spark = listings.sparkSession
    # rows grouped in the order of the months are written to them as they come
    grain = [m.TIME, *keys]
    covers = [(month,) for month in months]
    numbers = spans.number_hosts(spark, f"{folder}/host_numbers", listings)
    replace_partitions(spans.price_histogram(listings, grain), f"{folder}/month_prices", _BY, covers)
    replace_partitions(spans.host_bitmaps(listings, numbers, grain), f"{folder}/month_hosts", _BY, covers)


def _months(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    return spark.read.parquet(path).filter(F.col(m.TIME).between(first, last))


def prices_between(spark: SparkSession, folder: str, keys: list[str], first: int, last: int) -> DataFrame:
    """Price statistics of each group over the months from ``first`` to ``last``."""
    return spans.prices_over(_months(spark, f"{folder}/month_prices", first, last), keys)


def hosts_between(spark: SparkSession, folder: str, keys: list[str], first: int, last: int) -> DataFrame:
    """Different hosts and share of superhosts of each group over the months from ``first`` to ``last``."""
    return spans.hosts_over(_months(spark, f"{folder}/month_hosts", first, last), keys)
