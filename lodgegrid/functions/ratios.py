"""Ratios that round exactly and never divide by zero."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F


def rounded_ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """``round(numerator / denominator, digits)``, half away from zero, exact.

    Works on integers and decimals. The quotient is taken as an integer division of
    the scaled values, so no intermediate rounding can push a value over a half.
    """
    scale = 10**digits
    size = F.abs(numerator)
    # call_function: integral division has no Column method
    quotient = F.call_function(
        "div", F.lit(2 * scale) * size + denominator, F.lit(2) * F.nullif(denominator, F.lit(0))
    )
    unit = F.lit(Decimal(1).scaleb(-digits))
    rounded = quotient.cast("decimal(20,0)") * unit
    signed = F.when(numerator < 0, -rounded).otherwise(rounded)
    return signed.cast(f"decimal(20,{digits})")


def relative_change(current: Column, previous: Column) -> Column:
    """``current / previous - 1`` as a fraction; NULL without a non-zero previous value."""
    base = F.nullif(previous, F.lit(0)).cast("double")
    return current.cast("double") / base - F.lit(1.0)


def share(part: Column, total: Column) -> Column:
    """Exact-decimal share of a total; NULL where the total is zero."""
    whole = F.nullif(total, F.lit(0)).cast("decimal(18,0)")
    return part.cast("decimal(18,0)") / whole
