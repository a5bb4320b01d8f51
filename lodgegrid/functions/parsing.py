"""Text to typed values: missing tokens, whole numbers, currency.

The helpers take a column name and return SQL text where a whole table's columns are
built with them: one ``selectExpr`` then carries them all.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schemas import MISSING_TOKENS

_TOKENS = ", ".join(f"'{token}'" for token in MISSING_TOKENS)

# What a currency text may look like: digits with thousands commas and an optional
# fraction, a dollar sign before them, and one sign (before or after) or a pair of brackets.
_AMOUNT = r"[0-9][0-9,]*([.][0-9]*)?"
_MONEY_SHAPE = (
    rf"^\s*([-+]\s*[$]?\s*{_AMOUNT}|[$]\s*[-+]\s*{_AMOUNT}|[$]?\s*{_AMOUNT}\s*[-+]?"
    rf"|\(\s*[$]?\s*{_AMOUNT}\s*\))\s*$"
)
MONEY_TYPE = "decimal(19,2)"


def missing_to_null(column: str) -> str:
    """NULL where the delivered text is a missing token."""
    return f"CASE WHEN `{column}` NOT IN ({_TOKENS}) THEN `{column}` END"


def number(column: str, to: str = "decimal(30,8)") -> str:
    """Numeric text to an exact decimal; NULL where it is no number."""
    return f"try_cast(`{column}` AS {to})"


def whole_number(column: str, to: str = "int") -> str:
    """Numeric text such as ``'95'`` or ``'95.0'`` to an integer type.

    A value with a fraction, or out of range, is NULL and shows up in
    :func:`lodgegrid.operators.audit.cast_rejects`.
    """
    # a fraction of zeros is cut off; any other fraction makes the cast fail
    whole = f"CASE WHEN contains(`{column}`, '.') THEN regexp_replace(`{column}`, '[.]0*$', '') ELSE `{column}` END"
    return f"try_cast({whole} AS {to})"


def money(column: str) -> str:
    """Currency text such as ``'$1,234.50'``, ``'-$5'``, ``'5-'`` or ``'($5.00)'`` to a decimal."""
    sign = f"CASE WHEN `{column}` RLIKE r'[-(]' THEN '-' ELSE '' END"
    digits = f"regexp_replace(`{column}`, '[^0-9.]', '')"
    amount = f"try_cast(concat({sign}, {digits}) AS {MONEY_TYPE})"
    return f"CASE WHEN `{column}` RLIKE r'{_MONEY_SHAPE}' THEN {amount} END"


def rating(column: str) -> str:
    """Rating text to double; the text ``'NaN'`` becomes a NaN value."""
    return number(column, "double")


def has_rating(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value)
