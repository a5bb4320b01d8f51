"""The raw table follows its folder: changed files reload, emptied and vanished ones retract."""

import csv
import os

import pytest

from lodgegrid.schemas import text_schema
from lodgegrid.sources import listings_csv as load
from lodgegrid.sources.listings_csv import CSV_OPTIONS
from lodgegrid.sources.split_csv import read_split_records
from lodgegrid.streaming.ledger import digests, read_ledger, sync_folder

from .conftest import rows

HEADER = load.DELIVERED_COLUMNS


def write(path, *ids):
    with open(path, "w", newline="") as out:
        writer = csv.DictWriter(out, HEADER, restval="x")
        writer.writeheader()
        writer.writerows({"id": i, "host_neighbourhood": "Bondi"} for i in ids)


@pytest.fixture
def lookup(spark):
    return spark.createDataFrame([("Bondi", "Waverley")], "host_neighbourhood string, LGA string")


def test_folder_and_table_stay_equal(spark, tmp_path, lookup):
    incoming, raw, ledger = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "ledger")
    incoming.mkdir()

    def sync():
        return sync_folder(spark, str(incoming), lookup, raw, ledger)

    def stored():
        return rows(load.read_raw(spark, raw), "id", "year_month")

    for name, ids in (("08_2020.csv", "ab"), ("09_2020.csv", "cd"), ("north_09_2020.csv", "e"), ("10_2020.csv", "f")):
        write(incoming / name, *ids)
    first = sync()
    assert len(first.loaded) == 4 and first.months == [202008, 202009, 202010]
    everything = [(i, m) for i, m in zip("abcdef", ["202008", "202008", "202009", "202009", "202009", "202010"])]
    assert stored() == everything

    assert sync().loaded == sync().retracted == []
    assert read_ledger(spark, ledger).count() == 4

    # same content at another time: noted, not loaded
    os.utime(incoming / "08_2020.csv", (1, 1))
    assert sync().loaded == [] and stored() == everything

    write(incoming / "08_2020.csv", "a", "z")  # delivered again, of the same length
    write(incoming / "09_2020.csv")  # a header without rows
    (incoming / "10_2020.csv").write_text("")  # not even a header
    (incoming / "north_09_2020.csv").unlink()
    write(incoming / "11_2020.csv", "n")
    changes = sync()
    assert changes.loaded == ["08_2020.csv", "09_2020.csv", "11_2020.csv"]
    assert sorted(changes.retracted) == ["10_2020.csv", "north_09_2020.csv"]
    assert changes.months == [202008, 202009, 202010, 202011]
    assert stored() == [("a", "202008"), ("n", "202011"), ("z", "202008")]
    assert sync() == type(changes)([], [])

    write(incoming / "10_2020.csv", "f")  # and back again
    assert sync().loaded == ["10_2020.csv"]
    assert ("f", "202010") in stored()


def test_a_failed_run_is_made_good(spark, tmp_path, lookup):
    incoming, raw, ledger = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "ledger")
    incoming.mkdir()
    write(incoming / "08_2020.csv", "a")
    with open(incoming / "09_2020.csv", "w") as out:
        out.write("id,other\n1,2\n")
    with pytest.raises(ValueError, match="lacks columns"):
        sync_folder(spark, str(incoming), lookup, raw, ledger)
    assert read_ledger(spark, ledger).count() == 0
    write(incoming / "09_2020.csv", "b")
    assert len(sync_folder(spark, str(incoming), lookup, raw, ledger).loaded) == 2
    assert rows(load.read_raw(spark, raw), "id") == [("a",), ("b",)]


def test_loading_an_emptied_file_directly(spark, tmp_path, lookup):
    path, raw = tmp_path / "08_2020.csv", str(tmp_path / "raw")
    for ids, expected in (("ab", [("a",), ("b",)]), ("", []), ("", []), ("c", [("c",)])):
        write(path, *ids)
        load.load_snapshots(spark, str(path), lookup, raw)
        assert rows(spark.read.schema(load.RAW_TABLE_SCHEMA).parquet(raw), "id") == expected


def test_digests_follow_the_content(spark, tmp_path):
    a, b = tmp_path / "a.csv", tmp_path / "b.csv"
    a.write_text("1\n2\n")
    b.write_text("1\n3\n")
    found = {r.name: r.digest for r in digests(spark, [str(a), str(b)]).collect()}
    assert found["a.csv"] != found["b.csv"] and found["a.csv"].startswith("2:")


def built_in(spark, path, columns):
    reader = spark.read.options(**CSV_OPTIONS).schema(text_schema(columns))
    return reader.csv(path)


def test_an_open_quote_is_refused(spark, tmp_path):
    path = tmp_path / "05_2020.csv"
    start = "id,name\n" + "".join(f'{i},"line\n{i}"\n' for i in range(300))
    path.write_text(start + '300,"never closed\n301,x\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("700", "1000000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            with pytest.raises(ValueError, match="never closed in file:.*05_2020.csv, in the record near byte") as failure:
                read_split_records(spark, [str(path)], ["id", "name"])
            assert abs(int(str(failure.value).rsplit(" ", 1)[1]) - len(start)) < 100
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_record_over_the_limit_is_refused(spark, tmp_path):
    path = tmp_path / "05_2020.csv"
    path.write_text("id,name\n1,a\n" + '2,"' + "long\n" * 400 + '"\n3,c\n4,d\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("300", "1000000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert read_split_records(spark, [str(path)], ["id", "name"], 3000).count() == 4
            with pytest.raises(Exception, match="a record of more than 1000 bytes in file:"):
                read_split_records(spark, [str(path)], ["id", "name"], 1000).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_the_text_is_not_shuffled(spark, tmp_path):
    path = tmp_path / "05_2020.csv"
    path.write_text("id,name\n1,a\n")
    plan = read_split_records(spark, [str(path)], ["id", "name"])._jdf.queryExecution().executedPlan().toString()
    scans = [part for part in plan.split("Union")[-1].split("\n") if "FileScan text" in part]
    before_exchange = plan[: plan.index("FileScan text")]
    assert scans and "Exchange" not in before_exchange


def test_two_layouts_in_one_load(spark, tmp_path, lookup):
    early = ["zipcode", *[c for c in HEADER[::-1] if c not in ("bathrooms_text", "bedrooms")]]
    for name, header in (("05_2020.csv", early), ("08_2020.csv", HEADER)):
        with open(tmp_path / name, "w", newline="") as out:
            writer = csv.DictWriter(out, header, restval="v", extrasaction="ignore")
            writer.writeheader()
            writer.writerow({"id": name[:2], "host_neighbourhood": "Bondi", "bedrooms": "2"})
    blanks = {202005: ["bathrooms_text", "bedrooms"]}
    raw = str(tmp_path / "raw")
    load.load_snapshots(spark, [str(tmp_path / n) for n in ("05_2020.csv", "08_2020.csv")], lookup, raw, blanks=blanks)
    assert rows(load.read_raw(spark, raw), "id", "bedrooms", "bathrooms_text", "host_neighbourhood_cleansed") == [
        ("05", "", "", "Waverley"), ("08", "2", "v", "Waverley")]
