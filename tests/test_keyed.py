"""Tables in hash parts: a merge rewrites the parts it changes and nothing else."""

import pytest

from lodgegrid.plans import warehouse as w
from lodgegrid.schemas import LISTING_COLUMNS, RAW_LISTING_SCHEMA
from lodgegrid.sinks import keyed, store

from .conftest import rows

SCHEMA = "id long, name string"


def frame(spark, pairs):
    return spark.createDataFrame(pairs, SCHEMA)


def part_folders(path):
    return {str(p.relative_to(path)) for p in path.glob("data/written=*/_part=*")}


def test_merge_against_a_dict(spark, tmp_path):
    path = str(tmp_path / "t")
    expected = {n: f"n{n}" for n in range(200)} | {None: "none"}
    keyed.write_keyed(frame(spark, list(expected.items())), path, ["id"], parts=16)
    for new in ({3: "three", 500: "new"}, {None: "other"}, {n: "all" for n in range(100, 260)}):
        keyed.merge_keyed(frame(spark, list(new.items())), path)
        expected |= new
        assert rows(keyed.read_keyed(spark, path)) == sorted(expected.items(), key=repr)


def test_only_touched_parts_are_written(spark, tmp_path):
    path = tmp_path / "t"
    base = frame(spark, [(n, "x") for n in range(2000)])
    keyed.write_keyed(base, str(path), ["id"], parts=64)
    before = part_folders(path)
    assert len(before) == 64
    # what is there already rewrites nothing, and makes no version
    assert keyed.merge_keyed(base.filter("id < 900"), str(path)) == []
    assert store.versions(spark, str(path)) == [1] and part_folders(path) == before
    touched = keyed.merge_keyed(frame(spark, [(7, "seven")]), str(path))
    assert len(touched) == 1
    assert part_folders(path) - before == {f"data/written=2/_part={touched[0]}"}
    assert keyed.read_keyed(spark, str(path)).count() == 2000
    some = keyed.read_keyed(spark, str(path), frame(spark, [(7, None)]))
    assert 0 < some.count() < 100 and rows(some.filter("id = 7")) == [(7, "seven")]


def test_readers_keep_their_version_and_old_parts_go(spark, tmp_path):
    path = tmp_path / "t"
    keyed.write_keyed(frame(spark, [(n, "x") for n in range(100)]), str(path), ["id"], 4, keep=2)
    old = keyed.read_keyed(spark, str(path))
    keyed.merge_keyed(frame(spark, [(1, "one")]), str(path), keep=2)
    assert rows(old.filter("id = 1")) == [(1, "x")]
    for name in ("two", "three", "four"):
        keyed.merge_keyed(frame(spark, [(1, name)]), str(path), keep=2)
    assert store.versions(spark, str(path)) == [4, 5]
    # three parts of the first write, and the last two of the changed part
    assert len(part_folders(path)) == 5
    assert rows(keyed.read_keyed(spark, str(path)).filter("id = 1")) == [(1, "four")]


def test_a_write_that_fails_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed.write_keyed(frame(spark, [(1, "x")]), path, ["id"], 4)
    broken = spark.range(3).selectExpr("id", "IF(id = 2, CAST(raise_error('lost') AS STRING), 'y') AS name")
    with pytest.raises(Exception, match="lost"):
        keyed.merge_keyed(broken, path)
    assert rows(keyed.read_keyed(spark, path)) == [(1, "x")]


def test_empty_table_and_types(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed.write_keyed(frame(spark, []), path, ["id"], 4)
    assert keyed.read_keyed(spark, path).schema.simpleString() == "struct<id:bigint,name:string>"
    assert keyed.read_keyed(spark, path).count() == 0
    keyed.merge_keyed(frame(spark, [(5, "five")]), path)
    assert rows(keyed.read_keyed(spark, path)) == [(5, "five")]


@pytest.fixture
def raw(spark):
    plain = {c: "x" for c in LISTING_COLUMNS} | {
        "month": "May", "year_month": "202005", "year": "2020", "accommodates": "2", "availability_30": "20",
        "number_of_reviews": "3", "review_scores_rating": "95", "price": "$10.00"}
    data = [plain | {"id": str(n), "host_id": f"h{n}"} for n in range(60)]
    data += [plain | {"id": str(n), "host_id": f"h{n}", "month": "June", "year_month": "202006"} for n in range(40)]
    return spark.createDataFrame([tuple(r[c] for c in LISTING_COLUMNS) for r in data], RAW_LISTING_SCHEMA)


def test_a_month_rewrites_the_parts_of_its_new_hosts(spark, raw, tmp_path):
    folder = str(tmp_path)
    w.build_star(raw, folder)
    june = raw.filter("year_month = '202006'")
    assert w.add_months(june, folder) == {"dim_host": [], "dim_property": [], "dim_time": []}
    one_new = june.withColumn("host_id", w.F.when(w.F.col("id") == "7", "new").otherwise(w.F.col("host_id")))
    rewritten = w.add_months(one_new, folder, months=[202006])
    assert len(rewritten["dim_host"]) == 1 and rewritten["dim_property"] == rewritten["dim_time"] == []
    star = w.read_star(spark, folder)
    assert star["dim_host"].count() == 61 and star["listing_fact"].count() == 100
    # a month that has no rows any more
    w.add_months(june.limit(0), folder, months=[202006])
    assert w.read_star(spark, folder)["listing_fact"].count() == 60


@pytest.mark.parametrize("column, value", [("accommodates", "2.5"), ("price", "on request"), ("number_of_reviews", "x")])
def test_the_star_refuses_what_does_not_parse(spark, raw, tmp_path, column, value):
    folder = str(tmp_path)
    w.build_star(raw, folder)
    spoiled = raw.withColumn(column, w.F.when(w.F.col("id") == "7", value).otherwise(w.F.col(column)))
    before = rows(w.read_star(spark, folder)["listing_fact"], "id", "year_month", "accommodates", "price")
    for refused in (
        lambda: w.add_months(spoiled, folder), lambda: w.build_star(spoiled, folder),
        lambda: w.store_listings(spoiled, f"{folder}/typed"),
    ):
        with pytest.raises(ValueError, match=f"{column}: {value}"):
            refused()
    assert rows(w.read_star(spark, folder)["listing_fact"], "id", "year_month", "accommodates", "price") == before
    w.add_months(spoiled, folder, allow_rejects=True)
    fact = w.read_star(spark, folder)["listing_fact"]
    assert fact.filter(f"{column} IS NULL").count() == 2 and fact.count() == 100


def test_the_source_file_tells_equal_rows_apart(raw):
    sourced = raw.withColumn("source_file", w.F.lit("a.csv")).unionByName(raw.withColumn("source_file", w.F.lit("b.csv")))
    assert w.listing_fact(sourced).select("f_id").distinct().count() == 200
    assert w.listing_fact(raw.unionByName(raw)).select("f_id").distinct().count() == 100
