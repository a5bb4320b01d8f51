"""Covered counts without pairs equal the counts of the pairs."""

import random
import re

import pytest

from lodgegrid.operators import hosts
from lodgegrid.plans import datamart

from .conftest import rows


@pytest.fixture(scope="module")
def lga(spark):
    return spark.createDataFrame(
        [("A", "x", "1"), ("B", "x", "2"), ("B", "y", "3"), ("C", "x", "4")],
        "neighbourhood_cleansed string, lga_name string, code_2016 string")


@pytest.fixture(scope="module")
def census(spark):
    from decimal import Decimal

    values = [("1", Decimal("10.0")), ("2", Decimal("25.5")), ("3", None), ("4", Decimal("100"))]
    return spark.createDataFrame(values, "LGA_CODE_2016 string, Median_mortgage_repay_monthly decimal(12,4)")


def drawn(seed, n):
    rng = random.Random(seed)
    return [
        {
            "id": rng.choice([None, i]), "host_id": rng.choice([None, *map(str, range(12))]),
            "neighbourhood_cleansed": rng.choice(["A", "B", "C", "Z"]), "availability_30": rng.choice([0, 10, 28, 30]),
            "price": rng.choice([None, 12, 30, 40, 120]),
        }
        for i in range(n)
    ]


@pytest.mark.parametrize("seed, n", [(1, 1), (2, 15), (3, 40), (4, 400)])
def test_counts_equal_those_of_the_pairs(listings, lga, census, seed, n):
    facts = listings(*drawn(seed, n))
    assert rows(hosts.mortgage_cover_count(facts, lga, census)) == rows(
        hosts.cover_count(hosts.mortgage_cover(facts, lga, census)))
    assert rows(hosts.mortgage_cover_count_one_listing(facts, lga, census)) == rows(
        hosts.cover_count(hosts.mortgage_cover_one_listing(facts, lga, census)))


def test_revenue_equal_to_the_mortgage_covers(listings, lga, census):
    facts = listings({"neighbourhood_cleansed": "A", "availability_30": 18, "price": 10})  # 12 nights of 10
    assert rows(hosts.mortgage_cover_count(facts, lga, census), "covered", "count") == [(1, 1)]


def test_no_listings(listings, lga, census):
    none = listings({}).limit(0)
    assert hosts.mortgage_cover_count(none, lga, census).count() == 0
    assert hosts.mortgage_cover_count_one_listing(none, lga, census).count() == 0


def test_a_hot_host_forms_no_pairs(listings, lga, census):
    facts = listings(*[{"host_id": "hot", "neighbourhood_cleansed": a, "price": p} for a in "ABC" for p in range(300)])
    plan = hosts.mortgage_cover_count(facts, lga, census)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 2  # areas to census codes, both by area, and none on the host


def test_points_of_a_host_are_sorted_not_hashed(listings, lga, census):
    """Only the different areas and revenues are hashed: a table of all hosts' values grew with the rows of a task."""
    plan = hosts.mortgage_cover_count(listings({}), lga, census)._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and not re.search(r"keys=\[host_id#\d+, _value#", plan)


def in_order(found):
    return [r.estimated_revenue for r in found.collect()]


@pytest.mark.parametrize("seed, n", [(5, 1), (6, 40), (7, 400)])
def test_cover_by_revenue_holds_the_pairs_in_order(listings, lga, census, seed, n):
    facts = listings(*drawn(seed, n)).repartition(3)
    found = hosts.mortgage_cover_by_revenue(facts, lga, census)
    plain = hosts.mortgage_cover(facts, lga, census)
    assert found.schema == plain.schema and rows(found) == rows(plain)
    revenues = in_order(found)
    assert revenues == sorted(revenues, key=lambda v: (v is not None, -(v or 0)))


def test_cover_by_revenue_over_many_areas(spark, listings, census):
    names = [f"a{i:03d}" for i in range(150)]
    lga = spark.createDataFrame([(a, "x", str(1 + i % 4)) for i, a in enumerate(names)], "neighbourhood_cleansed string, lga_name string, code_2016 string")
    facts = listings(*[{"host_id": f"h{i % 7}", "neighbourhood_cleansed": a, "price": 10 + i % 5} for i, a in enumerate(names + [None])])
    found = hosts.mortgage_cover_by_revenue(facts, lga, census)
    assert rows(found) == rows(hosts.mortgage_cover(facts, lga, census)) and found.count() == 750


def test_ordered_cover_sorts_revenues_before_they_are_paired(listings, lga, census):
    facts = listings(*[{"host_id": h, "neighbourhood_cleansed": a, "price": p} for h in "xy" for a in "AB" for p in (3, 1, 2)])
    found = datamart.view("q4_d_2_revenue_cover_mortgage", datamart.Inputs(facts, lga, census), ordered=True)
    revenues = in_order(found)
    assert revenues == sorted(revenues, reverse=True) and len(revenues) == 2 * 3 * 3
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Sort")  # the pairs arise above the sort
