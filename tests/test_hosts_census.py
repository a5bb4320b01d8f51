from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lodgegrid.operators import census as age, hosts
from lodgegrid.plans import warehouse as w
from lodgegrid.schemas import (
    CENSUS_CODE, CENSUS_COUNT_SCHEMA, CENSUS_FACT_SCHEMA, CENSUS_MEDIAN_SCHEMA,
)

from .conftest import rows


@pytest.fixture(scope="module")
def lga(spark):
    return w.dim_lga(
        spark.createDataFrame(
            [("A", "A", "1"), ("B", "North", "2"), ("C", "North", "3"), ("D", "Empty", "4")],
            "neighbourhood_cleansed string, LGA_name string, CODE_2016 string",
        )
    )


@pytest.fixture(scope="module")
def census(spark, lga):
    def counts(code, young, old):
        values = {c: "0" for c in CENSUS_COUNT_SCHEMA.names} | {
            CENSUS_CODE: code, "Age_0_4_yr_P": str(young), "Age_85ov_P": str(old),
        }
        return tuple(values[c] for c in CENSUS_COUNT_SCHEMA.names)

    def medians(code, mortgage):
        values = {c: "1.5" for c in CENSUS_MEDIAN_SCHEMA.names} | {
            CENSUS_CODE: code, "Median_mortgage_repay_monthly": str(mortgage),
        }
        return tuple(values[c] for c in CENSUS_MEDIAN_SCHEMA.names)

    return w.census_fact(
        spark.createDataFrame(
            [counts("1", 1, 3), counts("2", 0, 0), counts("3", 1, 1), counts("9", 5, 5)],
            CENSUS_COUNT_SCHEMA,
        ),
        spark.createDataFrame(
            [medians("1", 100), medians("2", 10), medians("3", 1000)], CENSUS_MEDIAN_SCHEMA
        ),
        lga,
    )


def test_census_fact(census):
    assert census.schema.names == CENSUS_FACT_SCHEMA.names
    assert [f.dataType for f in census.schema] == [f.dataType for f in CENSUS_FACT_SCHEMA]
    assert rows(census, CENSUS_CODE, "Age_85ov_P", "Average_household_size", "lga_name") == [
        ("1", 3, Decimal("1.5000"), "A"), ("2", 0, Decimal("1.5000"), "North"),
        ("3", 1, Decimal("1.5000"), "North"),
    ]


def test_age_shares(listings, lga, census):
    facts = listings(
        {"price": 10}, {"neighbourhood_cleansed": "B", "price": 20},
        {"neighbourhood_cleansed": "C", "price": 40}, {"neighbourhood_cleansed": "Z"},
    )
    by_lga = age.age_shares_by_lga(facts, lga, census)
    assert by_lga.columns == ["lga_name", "agg_revenue", *age.SHARES]
    found = {r.lga_name: r for r in by_lga.collect()}
    assert set(found) == {"A", "North"}
    assert found["A"].p0_4 == Decimal("0.25") and found["A"].p85_plus == Decimal("0.75")
    # code 2 has no people: its shares are missing, its revenue counts
    assert found["North"].p0_4 == Decimal("0.5")
    assert found["North"].agg_revenue == Decimal("300")
    assert sum(found["A"][s] for s in age.SHARES) == 1
    overall = age.overall_age_shares(by_lga).first()
    assert overall.avg_revenue == Decimal("200") and overall.p0_4 == Decimal("0.375")
    assert age.average_share_of_top_lga(by_lga).first().average == Decimal("0.09")


def test_area_match(listings, lga):
    facts = listings(
        {"host_id": "1"}, {"host_id": "1"}, {"host_id": "1", "neighbourhood_cleansed": "B"},
        {"host_id": "2", "neighbourhood_cleansed": "Z"},
    )
    assert rows(hosts.host_area_match(facts, lga)) == [("1", 3, "A", "A", 1), ("1", 3, "B", "North", None)]


@pytest.fixture(scope="module")
def host_facts(listings):
    return listings(
        {"id": 1, "host_id": "one", "price": 200},
        {"id": 2, "host_id": "twice"}, {"id": 2, "host_id": "twice", "year_month": 202006},
        {"id": 3, "host_id": "many", "price": 10},
        {"id": 4, "host_id": "many", "price": 20, "neighbourhood_cleansed": "B"},
        {"id": 5, "host_id": "many", "price": 20, "neighbourhood_cleansed": "C"},
        {"id": 6, "host_id": "low", "price": 10},
        {"id": 7, "host_id": "away", "neighbourhood_cleansed": "Z"},
    )


def test_one_listing(host_facts):
    assert rows(hosts.hosts_with_one_listing(host_facts)) == [("away",), ("low",), ("one",)]


def test_cover_equals_the_plain_self_join(host_facts, lga, census):
    found = hosts.mortgage_cover(host_facts, lga, census)
    f, e = host_facts.alias("f"), host_facts.alias("e")
    plain = (
        f.join(e, F.col("f.host_id") == F.col("e.host_id"))
        .join(lga, F.col("f.neighbourhood_cleansed") == lga.neighbourhood_cleansed)
        .join(census, F.col("code_2016") == F.col(CENSUS_CODE))
        .selectExpr(
            "f.host_id", "f.neighbourhood_cleansed", "code_2016",
            "(30 - e.availability_30) * e.price AS estimated_revenue",
            "Median_mortgage_repay_monthly * 12 AS annualised_median_mortgage_repay",
        )
        .distinct()
    )
    assert rows(found.drop("covered")) == rows(plain)
    assert rows(hosts.mortgage_cover(host_facts, lga, census, split_above=1)) == rows(found)
    singles = hosts.mortgage_cover_one_listing(host_facts, lga, census)
    semi = found.join(hosts.hosts_with_one_listing(host_facts), "host_id", "left_semi").drop("code_2016")
    assert rows(singles) == rows(semi)
    assert rows(hosts.cover_count(singles)) == [(0, 1), (1, 1)]
