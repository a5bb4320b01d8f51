"""Month files to stored results, one month arriving later."""

import csv
import random

from lodgegrid.plans import datamart, warehouse as w
from lodgegrid.schemas import CENSUS_COUNT_COLUMNS, CENSUS_MEDIAN_COLUMNS, LGA_COLUMNS
from lodgegrid.sources import census_csv, listings_csv as load
from lodgegrid.streaming.monthly import load_new_months

from .conftest import rows

AREAS = ["Albury", "Ballina", "Bega"]


def write(path, header, records):
    with open(path, "w", newline="") as out:
        writer = csv.DictWriter(out, header, restval="")
        writer.writeheader()
        writer.writerows(records)


def month_file(folder, month, year, seed):
    draw = random.Random(seed)
    write(
        folder / f"{month:02}_{year}.csv", load.DELIVERED_COLUMNS,
        [
            {
                "id": n, "host_id": draw.randint(1, 25), "host_name": draw.choice(["Ann", ""]),
                "host_is_superhost": draw.choice("tf"), "host_neighbourhood": draw.choice(["Town", ""]),
                "neighbourhood_cleansed": draw.choice(AREAS), "property_type": draw.choice(["Flat", "House"]),
                "room_type": "Entire", "has_availability": draw.choice("tf"), "accommodates": draw.randint(1, 3),
                "availability_30": draw.randint(0, 30), "number_of_reviews": "3.0",
                "review_scores_rating": draw.choice(["95.0", ""]), "price": f"${draw.randint(20, 2000):,}.00",
                "description": 'line\n"quoted"',
            }
            for n in range(40)
        ],
    )


def test_from_files_to_results(spark, tmp_path):
    incoming = tmp_path / "incoming"
    incoming.mkdir()
    (tmp_path / "suburbs.csv").write_text("host_neighbourhood,LGA\nTown,Albury\n")
    write(tmp_path / "lga.csv", LGA_COLUMNS,
          [{"neighbourhood_cleansed": a, "LGA_name": a, "CODE_2016": i} for i, a in enumerate(AREAS)])
    write(tmp_path / "g01.csv", CENSUS_COUNT_COLUMNS,
          [dict.fromkeys(CENSUS_COUNT_COLUMNS, i + 1) | {"LGA_CODE_2016": i} for i in range(3)])
    write(tmp_path / "g02.csv", CENSUS_MEDIAN_COLUMNS,
          [dict.fromkeys(CENSUS_MEDIAN_COLUMNS, "150.5") | {"LGA_CODE_2016": i} for i in range(3)])

    lookup = load.read_lookup(spark, str(tmp_path / "suburbs.csv"))
    lga = w.dim_lga(census_csv.read_lga_list(spark, str(tmp_path / "lga.csv")))
    census = w.census_fact(
        census_csv.read_census_counts(spark, str(tmp_path / "g01.csv")),
        census_csv.read_census_medians(spark, str(tmp_path / "g02.csv")),
        lga,
    )
    raw, typed, star, mart = (str(tmp_path / n) for n in ("raw", "typed", "star", "mart"))

    def inputs():
        return datamart.Inputs(w.read_listings(spark, typed), lga, census)

    month_file(incoming, 11, 2020, 1)
    month_file(incoming, 12, 2020, 2)
    load.load_snapshots(spark, str(incoming), lookup, raw)
    w.store_listings(load.read_raw(spark, raw), typed)
    w.build_star(load.read_raw(spark, raw), star)
    some = ["question_1_1_active_listings_rate", "question_3_2_estimated_revenue_active_listings",
            "question_1_6_percentage_change_for_active_listings"]
    datamart.create_stored(inputs(), mart, some)
    before = rows(datamart.read_stored(spark, mart, some[0]))

    month_file(incoming, 1, 2021, 3)

    def bring_up_to_date(months):
        w.store_months(spark, raw, typed, months)
        w.add_raw_months(spark, raw, star, months)
        datamart.refresh_stored(inputs(), mart, some)

    for _ in range(2):
        load_new_months(spark, str(incoming), lookup, raw, str(tmp_path / "progress"), bring_up_to_date)
    after = rows(datamart.read_stored(spark, mart, some[0]))
    assert set(before) < set(after)
    assert {r[1] for r in after} == {202011, 202012, 202101}
    assert sum(r[3] for r in after) == 120 == w.read_star(spark, star)["listing_fact"].count()

    tables = w.read_star(spark, star)
    joined = w.listings_from_star(
        tables["listing_fact"], tables["dim_host"], tables["dim_property"], tables["dim_time"]
    )
    for name in datamart.VIEWS:
        result = datamart.view(name, inputs())
        assert result.columns and result.count() > 0 or name.startswith("q4_d"), name
    for name in some:
        from_star = datamart.view(name, datamart.Inputs(joined, lga, census))
        assert rows(from_star) == rows(datamart.read_stored(spark, mart, name)), name
