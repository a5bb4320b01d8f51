from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lodgegrid.operators import audit, metrics as m
from lodgegrid.operators.upsert import upsert
from lodgegrid.plans import datamart, warehouse as w
from lodgegrid.schemas import HOST_KEY, LISTING_COLUMNS, LISTING_SCHEMA, RAW_LISTING_SCHEMA
from lodgegrid.session import shared_dir
from lodgegrid.sinks import store
from lodgegrid.sources.tables import preview, row_counts

from .conftest import rows


@pytest.fixture(scope="module")
def raw(spark):
    plain = {c: "x" for c in LISTING_COLUMNS} | {
        "id": "1", "month": "May", "year_month": "202005", "year": "2020", "accommodates": "2",
        "availability_30": "20.0", "number_of_reviews": "3", "review_scores_rating": "95",
        "price": "$1,234.50", "has_availability": "t",
    }
    changes = [
        {}, {"id": "2", "host_name": None, "review_scores_rating": None},
        {"id": "3", "has_availability": "f", "year_month": "202006", "month": "June"},
        {"id": "4", "host_neighbourhood_cleansed": "y"},
    ]
    data = [tuple((plain | c)[n] for n in LISTING_COLUMNS) for c in changes]
    return spark.createDataFrame(data, RAW_LISTING_SCHEMA)


def test_typed_listings(raw):
    typed = w.typed_listings(raw)
    assert [(f.name, f.dataType) for f in typed.schema] == [(f.name, f.dataType) for f in LISTING_SCHEMA]
    assert rows(typed, "id", "availability_30", "review_scores_rating", "price")[1] == (
        2, 20, None, Decimal("1234.50"),
    )


def test_stored_listings_by_month(spark, raw, tmp_path):
    path = str(tmp_path / "listings")
    w.store_listings(raw, path)
    w.store_listings(raw.filter("year_month = '202006'"), path)
    stored = w.read_listings(spark, path)
    names = LISTING_SCHEMA.names
    assert rows(stored, *names) == rows(w.typed_listings(raw), *names)


def test_star_gives_back_the_listings(spark, raw, tmp_path):
    w.build_star(raw, str(tmp_path))
    star = w.read_star(spark, str(tmp_path))
    assert {n: t.count() for n, t in star.items()} == {
        "dim_host": 3, "dim_property": 2, "dim_time": 2, "listing_fact": 4,
    }
    joined = w.listings_from_star(
        star["listing_fact"], star["dim_host"], star["dim_property"], star["dim_time"]
    )
    names = LISTING_SCHEMA.names
    assert rows(joined, *names) == rows(w.typed_listings(raw), *names)
    assert star["listing_fact"].select("f_id").distinct().count() == 4


def test_fact_by_natural_keys(raw):
    dims = w.dim_host(raw), w.dim_property(raw), w.dim_time(raw)
    exact = w.listing_fact_by_join(raw, *dims, host_key=HOST_KEY)
    columns = ["id", "h_id", "p_id", "t_id", "price"]
    assert rows(exact, *columns) == rows(w.listing_fact(raw), *columns)
    by_names = w.listing_fact_by_join(raw, *dims, host_key=HOST_KEY, time_key=["month", "year"])
    assert rows(by_names, *columns) == rows(exact, *columns)
    # rows 1, 3 and 4 differ only in the column the short key leaves out
    assert rows(w.listing_fact_by_join(raw, *dims), "id") == [(1,), (1,), (2,), (3,), (3,), (4,), (4,)]


def test_adding_months_again_changes_nothing(spark, raw, tmp_path):
    folder = str(tmp_path)
    w.build_star(raw.filter("year_month = '202005'"), folder)
    june = raw.filter("year_month = '202006'")
    moved = june.withColumn("host_name", F.lit("new name"))
    for months in (june, june, moved, moved):
        w.add_months(months, folder)
    star = w.read_star(spark, folder)
    assert {n: t.count() for n, t in star.items()} == {
        "dim_host": 4, "dim_property": 2, "dim_time": 2, "listing_fact": 4,
    }
    joined = w.listings_from_star(star["listing_fact"], star["dim_host"])
    assert rows(joined, "id", "host_name") == [(1, "x"), (2, None), (3, "new name"), (4, "x")]


def test_declared_empty_table(spark, tmp_path):
    path = str(tmp_path / "raw")
    store.create_table(spark, RAW_LISTING_SCHEMA, path)
    store.create_table(spark, spark.range(1).schema, path)
    assert spark.read.parquet(path).schema.names == LISTING_COLUMNS
    copy = str(tmp_path / "copy")
    for size in (2, 5):
        store.materialize(spark.range(size), copy)
    assert spark.read.parquet(copy).count() == 2 and store.exists(spark, copy)


def test_time_key_uses_typed_values(spark, raw):
    float_text = raw.withColumn("year", F.lit("2020.0"))
    assert w.dim_time(raw.unionByName(float_text)).count() == 2


def test_audits(spark, raw):
    fact, hosts = w.listing_fact(raw), w.dim_host(raw)
    assert audit.orphans(fact, hosts, ["h_id"]).count() == 0
    some = hosts.filter("host_name IS NOT NULL")
    assert rows(audit.orphans(fact, some, ["h_id"]), "id") == [(2,)]
    assert audit.duplicate_keys(hosts, ["h_id"]).count() == 0
    twice = hosts.unionByName(hosts.filter("host_name IS NULL"))
    assert rows(audit.duplicate_keys(twice, ["host_name"]), "host_name", "rows") == [("x", 2), (None, 2)]
    assert rows(audit.null_counts(raw, ["id", "host_name"])) == [("host_name", 1), ("id", 0)]
    bad = raw.withColumn("price", F.when(F.col("id") == "3", "free").otherwise(F.col("price")))
    assert rows(audit.cast_rejects(bad, w.parse, w.PARSED_COLUMNS), "id", "rejected_columns") == [("3", ["price"])]
    summary = audit.violation_summary({"a": audit.orphans(fact, some, ["h_id"]), "b": hosts.limit(0)})
    assert rows(summary) == [("a", 1), ("b", 0)]


def test_upsert_keeps_and_replaces(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    new = spark.createDataFrame([("B", 2), ("C", 3), ("N", None)], "v string, k int")
    merged = upsert(old, new, ["k"])
    assert rows(merged) == [(1, "a"), (2, "B"), (3, "C"), (None, "N")]
    assert rows(upsert(merged, new, ["k"])) == rows(merged)


def test_versions_swap_whole_tables(spark, tmp_path):
    path = str(tmp_path / "dim")
    with pytest.raises(FileNotFoundError):
        store.read_version(spark, path)
    store.write_version(spark.range(3), path)
    store.write_version(store.read_version(spark, path).filter("id > 0"), path)
    assert store.versions(spark, path) == [1, 2]
    assert store.read_version(spark, path).count() == 2
    assert store.read_version(spark, path, 1).count() == 3
    (tmp_path / "dim" / "version=3").mkdir()  # a write that never finished
    assert store.read_version(spark, path).count() == 2
    assert store.write_version(spark.range(5), path) == 3
    assert store.read_version(spark, path).count() == 5


def test_declared_schema(spark):
    frame = spark.createDataFrame([(1, "a")], "N int, v string")
    declared = spark.createDataFrame([], "v string, n int").schema
    assert store.check_schema(frame, declared).columns == ["v", "n"]
    with pytest.raises(ValueError, match="n: declared bigint, found int"):
        store.check_schema(frame, spark.createDataFrame([], "n bigint").schema)
    with pytest.raises(ValueError, match="w: declared string, found none"):
        store.check_schema(frame, spark.createDataFrame([], "w string").schema)


def test_counts_and_preview(spark):
    assert rows(row_counts({"a": spark.range(3), "b": spark.range(0)})) == [("a", 3), ("b", 0)]
    assert rows(preview(spark.range(9), 2, ["id"])) == [(0,), (1,)]


def test_datamart_views_exist():
    assert len(datamart.VIEWS) == 32 and len(datamart.stored_views()) == 21
    assert len(datamart.monthly_views()) == 17


def test_stored_results_refresh(spark, listings, tmp_path):
    name, folder = "question_1_8_no_of_stays", str(tmp_path)
    one = datamart.Inputs(listings({}, {"year_month": 202006}))
    two = datamart.Inputs(listings({}, {}, {"year_month": 202006}, {"year_month": 202006}))
    datamart.create_stored(one, folder, [name])
    datamart.create_stored(two, folder, [name])
    read = lambda: rows(datamart.read_stored(spark, folder, name), "year_month", "number_of_stays")
    assert read() == [(202005, 10), (202006, 10)]
    datamart.refresh_stored(two, folder, [name])
    assert read() == [(202005, 20), (202006, 20)]


def test_month_refresh_keeps_the_other_months(spark, listings, tmp_path):
    folder = str(tmp_path)
    old = [{}, {"has_availability": "f"}, {"year_month": 202006}, {"neighbourhood_cleansed": "B", "accommodates": 3}]
    new = [*old, {"year_month": 202006, "has_availability": "f"}, {"year_month": 202007, "price": 7}]
    names = [n for n in datamart.stored_views() if not n.startswith("question_3")]
    datamart.create_stored(datamart.Inputs(listings(*old)), folder, names)
    inputs = datamart.Inputs(listings(*new))
    datamart.refresh_stored_months(inputs, folder, [202006, 202007], names)
    for name in names:
        stored = datamart.read_stored(spark, folder, name)
        fresh = datamart.view(name, inputs)
        assert rows(stored, *fresh.columns) == rows(fresh, *fresh.columns), name


def test_failed_refresh_leaves_the_old_result(spark, listings, tmp_path):
    name, folder = "question_1_3_distinct_hosts", str(tmp_path)
    datamart.create_stored(datamart.Inputs(listings({})), folder, [name])
    broken = listings({}).withColumn("host_id", F.expr("raise_error('lost')").cast("string"))
    for refresh in (datamart.refresh_stored, lambda i, f, n: datamart.refresh_stored_months(i, f, [202005], n)):
        with pytest.raises(Exception, match="lost"):
            refresh(datamart.Inputs(broken), folder, [name])
    assert datamart.read_stored(spark, folder, name).count() == 1
    for _ in range(5):
        datamart.refresh_stored(datamart.Inputs(listings({})), folder, [name])
    assert len(store.versions(spark, f"{folder}/{name}")) == datamart.KEPT_VERSIONS


def test_rejects_are_refused(spark, raw, tmp_path):
    bad = raw.withColumn("accommodates", F.lit("2.5"))
    with pytest.raises(ValueError, match="accommodates"):
        w.store_listings(bad, str(tmp_path / "typed"))
    w.store_listings(bad, str(tmp_path / "typed"), allow_rejects=True)
    assert w.read_listings(spark, str(tmp_path / "typed")).count() == raw.count()


def test_shared_summary_gives_the_same_results(spark, listings, tmp_path):
    facts = listings(
        {}, {"has_availability": "f"}, {"year_month": 202006, "review_scores_rating": None},
        {"year_month": 202006, "has_availability": "f", "accommodates": 3},
        {"neighbourhood_cleansed": "B", "review_scores_rating": 81.0, "availability_30": None},
    )
    inputs, folder = datamart.Inputs(facts), str(tmp_path)
    names = [n for n in datamart.stored_views() if datamart.VIEWS[n].grain]
    assert len(names) == 10
    datamart.create_stored(inputs, folder, names)
    for name in names:
        fresh = datamart.view(name, inputs)
        assert rows(datamart.read_stored(spark, folder, name), *fresh.columns) == rows(fresh), name


def test_views_by_name_and_order(spark, listings):
    facts = listings({"neighbourhood_cleansed": "B"}, {"neighbourhood_cleansed": None}, {})
    inputs = datamart.Inputs(facts)
    datamart.register_views(inputs, ["question_1_1_active_listings_rate"])
    assert spark.sql("SELECT count(*) FROM question_1_1_active_listings_rate").first()[0] == 3
    ordered = datamart.view("question_1_8_no_of_stays", inputs, ordered=True).collect()
    assert [r.neighbourhood_cleansed for r in ordered] == ["A", "B", None]


def test_shared_folder_is_the_sessions(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, raw, listings, tmp_path):
    raw.write.partitionBy("year_month").parquet(str(tmp_path / "raw"))
    stored = spark.read.schema(RAW_LISTING_SCHEMA).parquet(str(tmp_path / "raw"))
    plan = _plan(m.stays(w.typed_listings(stored).filter("year_month = 202005"), m.AREA))
    assert "ReadSchema: struct<neighbourhood_cleansed:string,availability_30:string>" in plan
    assert "PartitionFilters: [isnotnull(" in plan or "PartitionFilters: [(" in plan
    facts = listings({})
    from lodgegrid.operators.best_listing import best_kind_per_area

    assert "WindowGroupLimit" in _plan(best_kind_per_area(facts))
    for build in (
        lambda: m.percentage_change(facts, m.PROPERTY, "t", scope="group"),
        lambda: m.price_stats(facts, m.AREA),
        lambda: m.superhost_rate(facts, m.AREA),
        lambda: m.revenue(facts, m.AREA, dedup=True),
    ):
        assert "SinglePartition" not in _plan(build())
    assert "hashpartitioning(neighbourhood_cleansed" in _plan(m.distinct_hosts(facts, m.AREA))
