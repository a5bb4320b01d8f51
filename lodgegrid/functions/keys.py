"""Deterministic surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def surrogate_key(*columns: str) -> Column:
    """128-bit key computed from a natural key.

    Any task can compute it from a row alone, so building a fact needs no join to its
    dimensions, and a re-run gives the same key. 64 bits would start to collide at
    about a billion natural keys; 128 do not. Each part carries its length, and NULL
    differs from every text, so no two natural keys share an input.
    """
    parts = []
    for text in (f"CAST(`{c}` AS STRING)" for c in columns):
        # a NULL text adds nothing to concat_ws
        parts += ["'|'", f"coalesce(concat(length({text}), ':'), '-')", text]
    digest = f"unhex(substring(sha2(concat_ws('', {', '.join(parts[1:])}), 256), 1, 32))"
    # never NULL, and declared so: joins on the key then need no not-null filter, which
    # would compute the digest once more
    return F.expr(f"coalesce({digest}, X'')")
