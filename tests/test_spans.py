"""Month parts merge to exact results over spans; bucketed tables join without a shuffle."""

import random
from decimal import Decimal
from statistics import median_low

import pytest

from lodgegrid.operators import spans
from lodgegrid.plans import month_parts, queries, warehouse as w
from lodgegrid.schemas import LISTING_COLUMNS, RAW_LISTING_SCHEMA
from lodgegrid.sinks.bucketed import register_bucketed

from .conftest import rows

KEYS = ["neighbourhood_cleansed"]


@pytest.fixture(scope="module")
def facts(spark, listings):
    rng = random.Random(4)
    drawn = [
        {
            "neighbourhood_cleansed": rng.choice(["A", "B", None]), "host_id": rng.choice([None, *map(str, range(40))]),
            "host_is_superhost": rng.choice(["t", "f", None]), "price": rng.choice([None, *range(30, 90, 7)]),
            "year_month": rng.choice([202001, 202002, 202003, 202004]),
        }
        for _ in range(400)
    ]
    return drawn, listings(*drawn)


def span(drawn, area, first, last):
    return [r for r in drawn if r["neighbourhood_cleansed"] == area and first <= r["year_month"] <= last]


def rate(supers, hosts):
    return (Decimal(supers) / Decimal(hosts)).quantize(Decimal("0.01"), "ROUND_HALF_UP")


def check(spark, folder, drawn, first, last):
    prices = {r.neighbourhood_cleansed: r for r in month_parts.prices_between(spark, folder, KEYS, first, last).collect()}
    hosts = {r.neighbourhood_cleansed: r for r in month_parts.hosts_between(spark, folder, KEYS, first, last).collect()}
    assert prices.keys() == hosts.keys() == {r["neighbourhood_cleansed"] for r in drawn if first <= r["year_month"] <= last}
    for area in prices:
        own = span(drawn, area, first, last)
        known = [r["price"] for r in own if r["price"] is not None]
        assert (prices[area].min_price, prices[area].max_price) == (min(known), max(known))
        assert prices[area].median_price == median_low(known)
        assert prices[area].average_price == rate(sum(known), len(known))
        ids = {r["host_id"] for r in own} - {None}
        supers = {r["host_id"] for r in own if r["host_is_superhost"] == "t"} - {None}
        assert hosts[area].distinct_host_count == len(ids)
        assert hosts[area].superhost_rate == rate(len(supers), len(ids))


def test_spans_against_brute_force(spark, facts, tmp_path):
    drawn, frame = facts
    folder = str(tmp_path)
    month_parts.store_month_parts(frame, folder, KEYS)
    for first, last in ((202001, 202004), (202002, 202003), (202004, 202004)):
        check(spark, folder, drawn, first, last)


def test_a_reloaded_month_replaces_its_part(spark, listings, facts, tmp_path):
    drawn, frame = facts
    folder = str(tmp_path)
    month_parts.store_month_parts(frame, folder, KEYS)
    numbers = {r.host_id: r.number for r in spans.read_keyed(spark, f"{folder}/host_numbers").collect()}
    assert sorted(numbers.values()) == list(range(len(numbers))) and None not in numbers
    new = [{"neighbourhood_cleansed": "A", "host_id": h, "price": 5, "year_month": 202003} for h in ("1", "new", "newer")]
    month_parts.store_month_parts(listings(*new), folder, KEYS, months=[202002, 202003])
    after = {r.host_id: r.number for r in spans.read_keyed(spark, f"{folder}/host_numbers").collect()}
    assert {h: after[h] for h in numbers} == numbers and sorted(after.values()) == list(range(len(numbers) + 2))
    kept = [r for r in drawn if r["year_month"] not in (202002, 202003)]
    check(spark, folder, kept + [{"host_is_superhost": "f"} | r for r in new], 202001, 202004)


def test_groups_without_hosts_or_prices(spark, listings, tmp_path):
    month_parts.store_month_parts(listings({"host_id": None, "price": None}), str(tmp_path), KEYS)
    assert rows(month_parts.hosts_between(spark, str(tmp_path), KEYS, 0, 999999)) == [("A", 0, None)]
    assert rows(month_parts.prices_between(spark, str(tmp_path), KEYS, 0, 999999)) == [("A", None, None, None, None)]


def test_numbers_over_many_buckets(spark, listings):
    many = spark.range(100_000).selectExpr("CAST(id AS STRING) AS host_id", "id AS number")
    facts = many.selectExpr("host_id", "'t' AS host_is_superhost", "number % 3 AS area").filter("number % 10 < 7")
    found = spans.hosts_over(spans.host_bitmaps(facts, many, ["area"]), ["area"])
    assert sum(r.distinct_host_count for r in found.collect()) == 70_000
    about = spans.hosts_about(spans.host_sketches(facts, ["area"]), ["area"]).collect()
    assert all(abs(r.distinct_host_count - 70_000 / 3) < 0.05 * 70_000 / 3 for r in about) and len(about) == 3


def test_bitmaps_arise_where_they_are_complete(spark, listings):
    """Tasks exchange host numbers; bitmaps of every group from every task grew with the hosts times the tasks."""
    numbers = spark.createDataFrame([("h", 0)], "host_id string, number long")
    found = spans.host_bitmaps(listings({}, {"host_id": "other"}), numbers, ["year_month", *KEYS])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_bitmap_construct_agg") < plan.index("Exchange")


def test_span_queries_join_the_listings_once(spark, tmp_path, monkeypatch):
    facts = spark.createDataFrame(
        [("A", 199601, Decimal(5), "h", "t"), ("A", 199701, Decimal(7), "g", "f"), ("B", 199812, None, "h", "f")],
        "neighbourhood_cleansed string, year_month int, price decimal(19,2), host_id string, host_is_superhost string")
    monkeypatch.setattr(queries.tm, "listings", lambda *_: facts.join(facts.select("host_id").distinct(), "host_id").select(*facts.columns))
    plans, store = [], month_parts.store_month_parts

    def seen(part, *rest):
        plans.append(part._jdf.queryExecution().optimizedPlan().toString())
        store(part, *rest)

    monkeypatch.setattr(month_parts, "store_month_parts", seen)
    assert rows(queries.span_distinct_hosts(spark, str(tmp_path))) == [("A", 2, 0.5), ("B", 1, 0.0)]
    assert rows(queries.span_price_stats(spark, str(tmp_path))) == [("A", 5.0, 7.0, 5.0, 6.0), ("B", None, None, None, None)]
    assert len(plans) == 6 and not [p for p in plans if "Join" in p]


def test_bucketed_join_moves_nothing(spark, tmp_path):
    plain = {c: "x" for c in LISTING_COLUMNS} | {
        "month": "May", "year_month": "202005", "year": "2020", "accommodates": "2", "availability_30": "20",
        "number_of_reviews": "3", "review_scores_rating": "95", "price": "$10.00", "has_availability": "t"}
    # a third of the rows are one host's
    data = [plain | {"id": str(n), "host_id": f"h{n if n % 3 else 0}"} for n in range(300)]
    raw = spark.createDataFrame([tuple(r[c] for c in LISTING_COLUMNS) for r in data], RAW_LISTING_SCHEMA)
    names = w.store_bucketed_star(raw, str(tmp_path), "bucketed_test", 8)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = w.listings_from_star(spark.table(names["listing_fact"]), spark.table(names["dim_host"]))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == 300 and joined.select("host_id").distinct().count() == 201
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # another session names the folder again
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spark.table(names["dim_host"]).schema)
    register_bucketed(spark, "bucketed_again", f"{tmp_path}/dim_host", columns, "h_id", 8)
    assert spark.table("bucketed_again").count() == 201
    for name in (*names.values(), "bucketed_again"):
        spark.sql(f"DROP TABLE {name}")
