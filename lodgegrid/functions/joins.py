"""Join helpers.

No join here carries a broadcast hint: Spark compares the size of each side with
``spark.sql.autoBroadcastJoinThreshold`` at planning time and again, with measured
sizes, during execution. Beyond it the join is a sort-merge join, whose hot keys
adaptive execution splits.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on same-named columns where NULL matches NULL; keeps the left keys."""
    renamed = {c: f"_right_{c}" for c in on}
    other = right.withColumnsRenamed(renamed)
    condition = reduce(and_, (F.col(c).eqNullSafe(F.col(r)) for c, r in renamed.items()))
    joined = left.join(other, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*renamed.values())
