"""Results stay whole and right when one area, host or price holds a third of all rows."""

import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest

from lodgegrid.operators import best_listing, hosts, metrics as m

from .conftest import rows


@pytest.fixture(scope="module")
def records():
    draw = random.Random(11)
    found = []
    for n in range(6000):
        hot = n % 3 == 0
        found.append(
            {
                "id": n, "host_id": "hot" if hot else f"h{draw.randint(0, 900)}",
                "neighbourhood_cleansed": "hot" if hot else f"a{draw.randint(0, 40)}",
                "property_type": "hot" if hot else draw.choice("xyz"),
                "year_month": 202005 if hot else draw.choice([202005, 202006, 202007]),
                "availability_30": draw.randint(0, 30), "price": 100 if hot else draw.randint(10, 4000),
                "host_is_superhost": draw.choice("tf"), "has_availability": draw.choice("tf"),
            }
        )
    return found


@pytest.fixture(scope="module")
def facts(listings, records):
    return listings(*records).repartition(6).cache()


@pytest.fixture(scope="module")
def groups(records):
    by_area = defaultdict(list)
    for r in records:
        by_area[r["neighbourhood_cleansed"], r["year_month"]].append(r)
    return by_area


def half_up(a, b):
    return (Decimal(a) / Decimal(b)).quantize(Decimal("0.01"), ROUND_HALF_UP)


def by_area(df):
    return {(r.neighbourhood_cleansed, r.year_month): tuple(r)[2:] for r in df.collect()}


def test_rates_and_hosts(facts, groups):
    assert by_area(m.active_rate(facts, m.AREA)) == {
        k: (a := sum(r["has_availability"] == "t" for r in g), len(g), half_up(a, len(g)))
        for k, g in groups.items()
    }
    assert by_area(m.distinct_hosts(facts, m.AREA)) == {
        k: (len({r["host_id"] for r in g}),) for k, g in groups.items()
    }
    assert by_area(m.superhost_rate(facts, m.AREA)) == {
        k: (half_up(len({r["host_id"] for r in g if r["host_is_superhost"] == "t"}),
                    len({r["host_id"] for r in g})),)
        for k, g in groups.items()
    }


def test_prices(facts, groups):
    expected = {}
    for key, group in groups.items():
        prices = sorted(r["price"] for r in group)
        middle = prices[(len(prices) - 1) // 2]
        expected[key] = (prices[0], prices[-1], middle, half_up(sum(prices), len(prices)))
    assert by_area(m.price_stats(facts, m.AREA)) == expected


def test_revenue(facts, groups):
    def total(pairs):
        return Decimal(sum((30 - a) * p for a, p in pairs))

    pairs = {k: [(r["availability_30"], r["price"]) for r in g] for k, g in groups.items()}
    assert by_area(m.revenue(facts, m.AREA)) == {k: (total(p),) for k, p in pairs.items()}
    assert by_area(m.revenue(facts, m.AREA, dedup=True)) == {k: (total(set(p)),) for k, p in pairs.items()}


def test_best_kind(facts, records):
    kinds = defaultdict(set)
    for r in records:
        kinds[r["neighbourhood_cleansed"], r["property_type"]].add((r["availability_30"], r["price"]))
    totals = {k: sum((30 - a) * p for a, p in v) for k, v in kinds.items()}
    best = {}
    for (area, kind), total in sorted(totals.items()):
        if area not in best or total > best[area][1]:
            best[area] = (kind, total)
    found = best_listing.best_kind_per_area(facts, top=100).collect()
    assert {r.neighbourhood_cleansed: (r.property_type, r.revenue_agg) for r in found} == best


def test_hosts(spark, facts, records):
    lga = spark.createDataFrame(
        [(a, "L", a) for a in {r["neighbourhood_cleansed"] for r in records}],
        "neighbourhood_cleansed string, lga_name string, code_2016 string",
    )
    census = lga.selectExpr("code_2016 AS LGA_CODE_2016", "CAST(900 AS decimal(12,4)) AS Median_mortgage_repay_monthly")
    areas, revenues, listed = defaultdict(set), defaultdict(set), defaultdict(int)
    for r in records:
        areas[r["host_id"]].add(r["neighbourhood_cleansed"])
        revenues[r["host_id"]].add((30 - r["availability_30"]) * r["price"])
        listed[r["host_id"]] += 1
    expected = sorted(
        ((h, a, Decimal(v), int(v >= 10800)) for h in areas for a in areas[h] for v in revenues[h]), key=repr
    )
    columns = ["host_id", "neighbourhood_cleansed", "estimated_revenue", "covered"]
    for split_above in (3, 10_000):
        found = hosts.mortgage_cover(facts, lga, census, split_above).select(*columns)
        assert sorted(((h, a, v.quantize(Decimal(1)), c) for h, a, v, c in found.collect()), key=repr) == expected
    single = hosts.mortgage_cover_one_listing(facts, lga, census)
    assert {r.host_id for r in single.collect()} == {h for h, n in listed.items() if n == 1}
    assert {(r.host_id, r.total_listings) for r in hosts.host_area_match(facts, lga).collect()} == set(listed.items())
