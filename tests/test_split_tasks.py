"""CSV splits: the states after a line, and how many tasks many small splits take."""

import itertools
import re

import pyarrow as pa

from lodgegrid.sources import split_csv

_QUOTED = '(?:[^"]++|"")*+'
_FIELDS = f'(?:(?:"{_QUOTED}"[^,]*+|[^",][^,]*+)?,)*+'
OPENS = re.compile(f'^{_FIELDS}"{_QUOTED}\\Z')
STAYS_OPEN = re.compile(f'^{_QUOTED}(?:\\Z|"[^,]*+,{_FIELDS}"{_QUOTED}\\Z)')


def test_states_of_all_short_lines():
    lines = ["".join(x) for n in range(9) for x in itertools.product('",a', repeat=n)]
    opens, stays = split_csv.line_flags(pa.array(lines))
    assert opens.tolist() == [bool(OPENS.search(line)) for line in lines]
    assert stays.tolist() == [bool(STAYS_OPEN.search(line)) for line in lines]


def test_states_of_lines_that_are_not_utf8():
    lines = pa.array([b'\xff,"\xfe', b'a\xff"', b'"\xe9"\r'])
    opens, stays = split_csv.line_flags(lines)
    assert opens.tolist() == [True, False, False]
    assert stays.tolist() == [False, False, False]


def test_small_splits_share_tasks(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text("id,note\n" + "".join(f'{n},"a ""{n}"",\nb"\n' for n in range(4000)))
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    try:
        tasks = split_csv._lines(spark, [str(path)]).rdd.getNumPartitions()
        assert tasks <= 4 * spark.sparkContext.defaultParallelism
        found = split_csv.read_split_records(spark, [str(path)], ["id", "note"]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)
    assert sorted((int(r.id), r.note) for r in found) == [(n, f'a "{n}",\nb') for n in range(4000)]
