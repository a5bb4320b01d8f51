"""Reading in splits gives the rows of Spark's own reader, whatever the text."""

import random

import pytest

from lodgegrid.schemas import text_schema
from lodgegrid.sources.listings_csv import CSV_OPTIONS
from lodgegrid.sources.split_csv import read_split_records

COLUMNS = ["id", "name", "about"]
FIELDS = [
    "plain", "", '"quoted"', '"with, comma"', '"line\nbreak"', '"two\n\nbreaks"', '"a ""quote"" inside"',
    '27" screen flat', 'ends with"', 'mid"dle', '"""starts"', '"ends"""', '""', " blank ", '"x\r\ny"', '"a\n""b""\nc"',
    'é ü', '"27"" flat\nnext"',
]


def written(path, seed, end="\n", header="id,name,about"):
    rng = random.Random(seed)
    rows = [header] + [",".join([str(i), rng.choice(FIELDS), rng.choice(FIELDS)]) for i in range(120)]
    for _ in range(4):
        rows.insert(rng.randrange(1, len(rows)), "")
    path.write_bytes((end.join(rows) + end).encode())
    return str(path)


def built_in(spark, path):
    reader = spark.read.options(**CSV_OPTIONS).option("enforceSchema", False).schema(text_schema(COLUMNS))
    return sorted(map(tuple, reader.csv(path).collect()), key=repr)


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("split", [97, 400, 100_000])
def test_splits_give_the_same_rows(spark, tmp_path, seed, split):
    path = written(tmp_path / "05_2020.csv", seed)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        frame = read_split_records(spark, [path], COLUMNS).select(*COLUMNS)
        found = sorted(map(tuple, frame.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert found == built_in(spark, path)


def test_header_case_does_not_count(spark, tmp_path):
    path = written(tmp_path / "05_2020.csv", 1, header="ID,Name,about")
    assert read_split_records(spark, [path], COLUMNS).count() == len(built_in(spark, path))
