"""Previous value in a total order, without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut_lineage

_SLICE = "_slice"
_CARRY = "_carry"
_FIRST = "_is_first"
_LAST = "_is_last"
_OWN = "_is_own"


def global_lag(
    df: DataFrame, value: str, order: list[str], out: str, slices: int | None = None
) -> DataFrame:
    """``LAG(value) OVER (ORDER BY order...)`` with no PARTITION BY.

    A window without keys puts all rows in one task. Here the lag runs within the rows that
    share all but the last column of ``order``, and the first of them gets the last value of
    the group before. That one is the lag of the groups' last values in the order of the
    groups, found the same way with one column less. Only the last step, over the values of
    the first column, takes a single task. Nothing runs before the result is read.

    ``order`` must identify a row. Where its first column alone has many values, ``slices``
    cuts the order into that many ranges instead (see :func:`ranged_lag`).
    """
    if slices:
        return ranged_lag(df, value, order, out, slices)
    held = df.withColumn(_CARRY, F.struct(F.col(value).alias("value")))
    return _lag(held, order).withColumn(out, F.col(f"{_LAST}.value")).drop(_CARRY, _LAST)


def _lag(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with the previous row's ``_CARRY`` as ``_LAST``."""
    groups, last = order[:-1], order[-1]
    if not groups:
        return rows.withColumn(_LAST, F.lag(_CARRY).over(Window.orderBy(F.col(last).asc_nulls_last())))
    ends = rows.groupBy(*groups).agg(
        F.max_by(_CARRY, F.struct(F.col(last).isNull(), F.col(last))).alias(_CARRY))
    # the value before a group stands before the group's rows as a row of its own
    before = _lag(ends, groups).select(*groups, F.col(_LAST).alias(_CARRY), F.lit(False).alias(_OWN))
    together = before.unionByName(rows.withColumn(_OWN, F.lit(True)), allowMissingColumns=True)
    within = Window.partitionBy(*groups).orderBy(_OWN, F.col(last).asc_nulls_last())
    lagged = together.withColumn(_LAST, F.lag(_CARRY).over(within))
    return lagged.filter(_OWN).select(*rows.columns, _LAST)


def ranged_lag(df: DataFrame, value: str, order: list[str], out: str, slices: int | None = None) -> DataFrame:
    """The same over contiguous ranges of the order, one edge row of each in a single task.

    ``order`` must identify a row, which lets ranges cut through any hot key. The ranges
    come from sampling, so they are written out once: both passes below must see the same
    cut.
    """
    ordering = [F.col(c).asc_nulls_last() for c in order]
    ranged = (
        df.repartitionByRange(slices, *ordering) if slices else df.repartitionByRange(*ordering)
    )
    cut = cut_lineage(ranged.withColumn(_SLICE, F.spark_partition_id()), "ordered-ranges")

    within = Window.partitionBy(_SLICE).orderBy(*ordering)
    local = cut.withColumns(
        {
            out: F.lag(value).over(within),
            _FIRST: F.row_number().over(within) == 1,
            _LAST: F.lead(F.lit(True)).over(within).isNull(),
        }
    )
    edges = local.filter(_LAST).select(_SLICE, F.col(value).alias(_CARRY))
    carried = edges.select(
        F.col(_SLICE), F.lag(_CARRY).over(Window.orderBy(_SLICE)).alias(_CARRY)
    )
    return (
        local.join(carried, _SLICE, "left")
        .withColumn(out, F.when(F.col(_FIRST), F.col(_CARRY)).otherwise(F.col(out)))
        .drop(_SLICE, _CARRY, _FIRST, _LAST)
    )
