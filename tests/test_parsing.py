from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lodgegrid.functions.parsing import missing_to_null, money, rating, whole_number
from lodgegrid.functions.ratios import relative_change, rounded_ratio, share
from lodgegrid.functions.keys import surrogate_key


def one(spark, expression, text):
    frame = spark.createDataFrame([(text,)], "v string")
    return frame.selectExpr(f"{expression} AS r").first().r


@pytest.mark.parametrize(
    "text, amount",
    [
        ("$1,234.50", "1234.50"), ("95", "95.00"), ("$0.005", "0.01"), ("-$5.00", "-5.00"),
        ("$-5", "-5.00"), ("($5.25)", "-5.25"), ("$1,000,000.00", "1000000.00"), (" $7 ", "7.00"),
        ("", None), ("$", None), ("on request", None), ("NaN", None), ("12abc", None), (None, None),
        ("1-2", None), ("99999999999.00", "99999999999.00"), ("$12,345,678,901.00", "12345678901.00"), ("5-", "-5"), ("+5", "5"), ("$5)", None), ("($5", None), ("-5-", None), ("$12345678901234567.89", "12345678901234567.89"),
    ],
)
def test_money(spark, text, amount):
    assert one(spark, money("v"), text) == (Decimal(amount) if amount else None)


@pytest.mark.parametrize(
    "text, value",
    [("95", 95), ("95.0", 95), ("95.000", 95), ("2.5", None), ("-3", -3), ("x", None), (None, None),
     ("99999999999", None)],
)
def test_whole_number(spark, text, value):
    assert one(spark, whole_number("v"), text) == value


def test_large_ids_are_kept(spark):
    assert one(spark, whole_number("v", "bigint"), "54321987654") == 54321987654


@pytest.mark.parametrize("text", ["", "NA", "N/A", "null", "NaN", "None", "#N/A", None])
def test_missing_tokens(spark, text):
    assert one(spark, missing_to_null("v"), text) is None


@pytest.mark.parametrize("text", ["Nan", "none", "0", " ", "na"])
def test_other_text_is_kept(spark, text):
    assert one(spark, missing_to_null("v"), text) == text


def test_rating_text(spark):
    assert one(spark, rating("v"), "95.5") == 95.5
    assert one(spark, f"isnan({rating('v')})", "NaN") is True


@pytest.mark.parametrize(
    "a, b, expected",
    [(57, 200, "0.29"), (1, 3, "0.33"), (2, 3, "0.67"), (1, 200, "0.01"), (0, 5, "0.00"),
     (-57, 200, "-0.29"), (10**15, 3, "333333333333333.33"), (1, 0, None), (None, 4, None)],
)
def test_rounded_ratio_is_exact(spark, a, b, expected):
    frame = spark.createDataFrame([(a, b)], "a long, b long")
    found = frame.select(rounded_ratio(F.col("a"), F.col("b")).alias("r")).first().r
    assert found == (Decimal(expected) if expected else None)


def test_ratio_near_a_half_is_not_rounded_twice(spark):
    # 0.0049999999999... must stay 0.00
    frame = spark.createDataFrame([(49_999_999_999_999, 10**16)], "a long, b long")
    assert frame.select(rounded_ratio(F.col("a"), F.col("b"))).first()[0] == Decimal("0.00")


def test_change_and_share_without_a_base(spark):
    frame = spark.createDataFrame([(5, 0), (5, None), (5, 4)], "a long, b long")
    changes = [r.c for r in frame.select(relative_change(F.col("a"), F.col("b")).alias("c")).collect()]
    assert changes == [None, None, 0.25]
    shares = [r.c for r in frame.select(share(F.col("a"), F.col("b")).alias("c")).collect()]
    assert shares[:2] == [None, None] and shares[2] == Decimal("1.25")


def test_surrogate_keys_tell_natural_keys_apart(spark):
    natural = [("a", "b"), ("ab", ""), ("", "ab"), (None, "ab"), ("ab", None), (None, None), ("a|1:b", ""), ("", "")]
    frame = spark.createDataFrame(natural, "x string, y string")
    keys = {bytes(r.k) for r in frame.select(surrogate_key("x", "y").alias("k")).collect()}
    assert len(keys) == len(natural)
    assert {len(k) for k in keys} == {16}
