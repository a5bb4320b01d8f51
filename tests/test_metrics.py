import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lodgegrid.operators import best_listing, metrics as m
from lodgegrid.operators.median import summarize_values
from lodgegrid.operators.ordered_lag import global_lag

from .conftest import rows


def test_active_rate(listings):
    facts = listings({"has_availability": "t"}, {"has_availability": "f"}, {"has_availability": None})
    assert rows(m.active_rate(facts, m.AREA)) == [("A", 202005, 1, 3, Decimal("0.33"))]


def test_price_stats_take_the_lower_middle(listings):
    facts = listings(*[{"price": p} for p in (10, 20, 30, 41)], {"price": None})
    assert rows(m.price_stats(facts, m.AREA)) == [
        ("A", 202005, Decimal("10.00"), Decimal("41.00"), Decimal("20.00"), Decimal("25.25"))
    ]


def test_price_stats_of_an_area_without_prices(listings):
    facts = listings({"price": None}, {"price": 5, "neighbourhood_cleansed": None})
    found = m.price_stats(facts, m.AREA).collect()
    by_area = {r.neighbourhood_cleansed: r for r in found}
    assert by_area["A"].median_price is None and by_area["A"].average_price is None
    assert by_area[None].median_price == Decimal("5.00")


def test_median_against_brute_force(spark):
    draw = random.Random(7)
    data = {}
    for group in range(6):
        spread = [100, 10**4, 10**6, 10**11, 3 * 10**6, 10**12 - 1][group]
        data[group] = [draw.randint(-spread if group == 4 else 0, spread) for _ in range(201 + group)]
    values = [(g, Decimal(c).scaleb(-2)) for g, cents in data.items() for c in cents]
    frame = spark.createDataFrame(values, "g int, price decimal(12,2)")
    histogram = frame.groupBy("g", "price").agg(F.count("price").alias("n"))
    found = {r.g: r[1:] for r in summarize_values(histogram, ["g"], "price", "n").collect()}
    assert found == {
        g: tuple(Decimal(v).scaleb(-2) for v in (min(c), max(c), sum(c)))
        + (len(c), Decimal(statistics.median_low(c)).scaleb(-2))
        for g, c in data.items()
    }


def test_hosts_count_once_and_superhost_of_any_row(listings):
    facts = listings(
        {"host_id": "1", "host_is_superhost": "t"}, {"host_id": "1", "host_is_superhost": "f"},
        {"host_id": "2"}, {"host_id": "3", "host_is_superhost": None}, {"host_id": None},
    )
    assert rows(m.distinct_hosts(facts, m.AREA)) == [("A", 202005, 3)]
    assert rows(m.superhost_rate(facts, m.AREA)) == [("A", 202005, Decimal("0.33"))]


def test_rating_ignores_inactive_and_missing(listings):
    facts = listings(
        {"review_scores_rating": 90.0}, {"review_scores_rating": 95.0},
        {"review_scores_rating": float("nan")}, {"review_scores_rating": None},
        {"review_scores_rating": 10.0, "has_availability": "f"},
    )
    assert rows(m.average_rating_active(facts, m.AREA)) == [("A", 202005, Decimal("92.50"))]


def test_stays_and_revenue(listings):
    # 3 nights x 40, 4 nights x 30, and 3 x 40 again
    facts = listings(
        {"availability_30": 27, "price": 40}, {"availability_30": 26, "price": 30},
        {"availability_30": 27, "price": 40},
    )
    assert rows(m.stays(facts, m.AREA)) == [("A", 202005, 10)]
    assert rows(m.revenue(facts, m.AREA)) == [("A", 202005, Decimal("360.00"))]
    assert rows(m.revenue(facts, m.AREA, dedup=True)) == [("A", 202005, Decimal("240.00"))]


def _months(area, counts, flag="t"):
    other = "f" if flag == "t" else "t"
    found = []
    for month, count in enumerate(counts, 1):
        found += [{"neighbourhood_cleansed": area, "year_month": 202000 + month, "has_availability": flag}] * count
        found += [{"neighbourhood_cleansed": area, "year_month": 202000 + month, "has_availability": other}]
    return found


def test_change_runs_across_groups_unless_scoped(listings):
    facts = listings(*_months("A", [2, 0, 3]), *_months("B", [6]))
    everything = rows(m.percentage_change(facts, m.AREA, "t"))
    assert everything == [
        ("A", 202001, 2, None), ("A", 202002, 0, -1.0), ("A", 202003, 3, None), ("B", 202001, 6, 1.0),
    ]
    dropped = rows(m.percentage_change(facts, m.AREA, "t", drop_zero=True))
    assert dropped == [("A", 202001, 2, None), ("A", 202003, 3, 0.5), ("B", 202001, 6, 1.0)]
    scoped = rows(m.percentage_change(facts, m.AREA, "t", scope="group", drop_zero=True))
    assert scoped == [("A", 202001, 2, None), ("A", 202003, 3, 0.5), ("B", 202001, 6, None)]
    with pytest.raises(ValueError):
        m.percentage_change(facts, m.AREA, "t", scope="other")


@pytest.mark.parametrize("slices", [1, 3, 16])
def test_global_lag_against_brute_force(spark, slices):
    draw = random.Random(slices)
    keys = {(draw.choice("abcz"), draw.randint(0, 400)) for _ in range(300)} | {(None, 3), (None, 9)}
    data = [(k, t, draw.choice([None, *range(5)])) for k, t in keys]
    frame = spark.createDataFrame(data, "k string, t int, v int")
    found = {(r.k, r.t): r.before for r in global_lag(frame, "v", ["k", "t"], "before", slices).collect()}
    ordered = sorted(data, key=lambda r: (r[0] is None, r[0] or "", r[1]))
    expected = {(r[0], r[1]): (ordered[i - 1][2] if i else None) for i, r in enumerate(ordered)}
    assert found == expected


def test_area_metrics_by_lga(spark, listings):
    lga = spark.createDataFrame(
        [("A", "North"), ("B", "North"), ("B", "South")], "neighbourhood_cleansed string, lga_name string"
    )
    facts = listings(
        {"host_id": "1"}, {"host_id": "1", "neighbourhood_cleansed": "B"},
        {"host_id": "2", "neighbourhood_cleansed": "B"}, {"host_id": "3", "neighbourhood_cleansed": "C"},
    )
    assert rows(m.distinct_hosts_by_lga(facts, lga), "host_lga_cleansed", "distinct_host_count") == [
        ("North", 2), ("South", 2),
    ]
    per_host = m.revenue_by_lga(facts, lga, ("host_id",)).select("host_id", "host_lga_cleansed", m.REVENUE)
    assert rows(per_host) == [
        ("1", "North", Decimal("2000.00")), ("1", "South", Decimal("1000.00")),
        ("2", "North", Decimal("1000.00")), ("2", "South", Decimal("1000.00")),
    ]
    assert rows(m.revenue_by_lga(facts, lga), "host_lga_cleansed", m.REVENUE) == [
        ("North", Decimal("3000.00")), ("South", Decimal("2000.00")),
    ]


def test_best_kind_breaks_ties_by_column_order(listings):
    facts = listings(
        {"property_type": "Villa", "price": 50}, {"property_type": "Flat", "price": 50},
        {"property_type": "Flat", "price": 50}, {"neighbourhood_cleansed": "B", "price": 10},
    )
    found = rows(best_listing.best_kind_per_area(facts), "neighbourhood_cleansed", "property_type", "revenue_agg", "rank")
    assert found == [("A", "Flat", Decimal("500.00"), 1), ("B", "Flat", Decimal("100.00"), 1)]
    assert best_listing.best_kind_per_area(facts, top=1).count() == 1
