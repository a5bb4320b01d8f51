"""Keys and stages with many computed columns: the same values, in methods the JVM compiles."""

import hashlib

from lodgegrid.functions.keys import surrogate_key
from lodgegrid.plans import warehouse as w
from lodgegrid.schemas import LISTING_SCHEMA, text_schema
from lodgegrid.session import HUGE_METHOD_BYTES
from lodgegrid.sources.listings_csv import DELIVERED_COLUMNS, conform

SETTING = "spark.sql.codegen.hugeMethodLimit"


def _limit_after(spark, build) -> int:
    usual = spark.conf.get(SETTING)
    spark.conf.set(SETTING, "65535")
    try:
        build()
        return int(spark.conf.get(SETTING))
    finally:
        spark.conf.set(SETTING, usual)


def test_facts_and_loads_bound_their_methods(spark):
    raw = spark.createDataFrame([], text_schema([f.name for f in LISTING_SCHEMA]))
    delivered = spark.createDataFrame([], text_schema(DELIVERED_COLUMNS))
    for build in (
        lambda: w.typed_listings(raw), lambda: w.listing_fact(raw), lambda: conform(delivered, "199601")):
        assert _limit_after(spark, build) == HUGE_METHOD_BYTES


def test_a_lower_limit_stays(spark):
    usual = spark.conf.get(SETTING)
    spark.conf.set(SETTING, "4000")
    try:
        w.typed_listings(spark.createDataFrame([], text_schema([f.name for f in LISTING_SCHEMA])))
        assert spark.conf.get(SETTING) == "4000"
    finally:
        spark.conf.set(SETTING, usual)


def test_keys_keep_their_digest(spark):
    rows = [("a", None, 7), ("", "é|x", None), (None, None, 0), ("a|1:b", "", 12)]
    found = spark.createDataFrame(rows, "a string, b string, n int").select(
        "*", surrogate_key("a", "b", "n").alias("key")).collect()
    for r in found:
        texts = [None if v is None else str(v) for v in (r.a, r.b, r.n)]
        whole = "|".join("-" if t is None else f"{len(t)}:{t}" for t in texts)
        assert bytes(r.key) == hashlib.sha256(whole.encode()).digest()[:16]


def test_whole_numbers_keep_their_values(spark):
    texts = ["95", "95.0", "95.", "95.5", ".0", "", "1.0\n", " 7 ", "x", None, "1.0.0"]
    found = spark.createDataFrame([(t,) for t in texts], "c string").selectExpr(
        w.whole_number("c"), "try_cast(regexp_replace(c, '[.]0*$', '') AS int)").collect()
    assert [r[0] for r in found] == [r[1] for r in found]
