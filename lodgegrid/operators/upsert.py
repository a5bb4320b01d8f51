"""Merge new rows into a table by key."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.joins import null_safe_join


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``old`` whose key is not in ``new``, and all rows of ``new``.

    With keys computed from natural keys, a host or property seen before keeps its
    surrogate key. ``new`` must hold a key at most once, as the uniqueness audit checks.
    """
    kept = null_safe_join(old, new.select(*key), key, "left_anti")
    return kept.unionByName(new.select(*old.columns))
