"""Integrity rules as jobs: each returns the violations as a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, functions as F

from ..functions.joins import null_safe_join


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Primary-key rule: key values held by more than one row, with their row count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def orphans(fact: DataFrame, dimension: DataFrame, key: list[str]) -> DataFrame:
    """Foreign-key rule: fact rows without a dimension row (NULL matches NULL)."""
    return null_safe_join(fact, dimension.select(*key), key, "left_anti")


def null_counts(df: DataFrame, required: list[str]) -> DataFrame:
    """Not-null rule: one row per required column with its NULL count, in one scan."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return counted.unpivot([], required, "column_name", "null_rows")


def null_rows(df: DataFrame, required: list[str]) -> DataFrame:
    """Not-null rule: the rows in which a required column is NULL."""
    return df.filter(reduce(or_, (F.col(c).isNull() for c in required)))


def cast_rejects(raw: DataFrame, parse: Callable[[str], str], columns: list[str]) -> DataFrame:
    """Raw rows with a value that is present but does not parse, with the column names.

    ``parse`` gives the SQL text of a column's typed value.
    """
    bad = [
        F.expr(f"CASE WHEN `{c}` <> 'NaN' AND ({parse(c)}) IS NULL THEN '{c}' END")
        for c in columns
    ]
    listed = raw.withColumn("rejected_columns", F.array_compact(F.array(*bad)))
    return listed.filter(F.size("rejected_columns") > 0)


def violation_summary(rules: dict[str, DataFrame]) -> DataFrame:
    """Violating rows per rule name."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("rule"), "violations")
        for name, df in rules.items()
    ]
    return reduce(DataFrame.unionByName, counted)
