"""Tables stored in hash parts of their key; a merge rewrites the parts it changes.

A row belongs to the part its key hashes to. Every write puts the parts it changes into a
folder of its own and then stores a version: a small table that names, for each part, the
write that holds it. Readers take the newest complete version, so a merge that fails or is
still running changes nothing for them, and parts that no key of it fell in are shared
between versions.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.joins import null_safe_join
from ..operators.upsert import upsert
from ..session import cut_lineage, shuffles_released
from .store import child_names, delete_folder, read_version, versions, write_version

_PART = "_part"
_LAYOUT = "part int, written int, parts int, key array<string>, schema string"
PARTS = 64


def part_of(key: list[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(parts)).cast("int")


def write_keyed(df: DataFrame, path: str, key: list[str], parts: int = PARTS, keep: int | None = None) -> None:
    """The next version holds the rows of ``df``, which has a key at most once.

    ``parts`` is how many parts the table has from now on; choose it so that a part of the
    grown table is still one task's work. ``keep`` versions stay.
    """
    _write(df, path, key, parts, {}, keep)


def merge_keyed(new: DataFrame, path: str, keep: int | None = None) -> list[int]:
    """Brings the rows of ``new``, each key at most once, into the table; gives the parts rewritten.

    Only parts that a key of ``new`` falls in are read. Rows the table holds as they are
    change nothing; without any other there is no new version.
    """
    spark = new.sparkSession
    layout = _layout(spark, path)
    schema, key, parts = _table(layout)
    rows = new.select(*schema.names).withColumn(_PART, part_of(key, parts))
    incoming = cut_lineage(rows, "merge-rows")
    asked = [r[0] for r in incoming.select(_PART).distinct().collect()]  # at most ``parts`` numbers
    old = _read(spark, path, layout, asked)
    changed = cut_lineage(null_safe_join(incoming, old, schema.names, "left_anti"), "merge-changes")
    touched = sorted(r[0] for r in changed.select(_PART).distinct().collect())
    if touched:
        merged = upsert(_read(spark, path, layout, touched), changed.drop(_PART), key)
        _write(merged, path, key, parts, {r.part: r.written for r in layout if r.part not in touched}, keep)
    return touched


def read_keyed(spark: SparkSession, path: str, key_values: DataFrame | None = None) -> DataFrame:
    """The table, or the parts of it that the keys in ``key_values`` fall in."""
    layout = _layout(spark, path)
    if key_values is None:
        return _read(spark, path, layout, None)
    _, key, parts = _table(layout)
    asked = key_values.select(part_of(key, parts).alias(_PART)).distinct().collect()
    return _read(spark, path, layout, [r[0] for r in asked])


def _layout(spark: SparkSession, path: str) -> list:
    """A row per part that holds rows, and one with part -1: bounded by the number of parts."""
    return read_version(spark, path).collect()


def _table(layout: list) -> tuple[T.StructType, list[str], int]:
    own = layout[0]
    return T.StructType.fromJson(json.loads(own.schema)), list(own.key), own.parts


def _folder(path: str, written: int, part: int) -> str:
    return f"{path}/data/written={written}/{_PART}={part}"


def _read(spark: SparkSession, path: str, layout: list, parts: list[int] | None) -> DataFrame:
    schema, _, _ = _table(layout)
    wanted = [r for r in layout if r.part >= 0 and (parts is None or r.part in parts)]
    if not wanted:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[_folder(path, r.written, r.part) for r in wanted])


def _write(df: DataFrame, path: str, key: list[str], parts: int, others: dict[int, int], keep: int | None) -> None:
    spark = df.sparkSession
    done = versions(spark, path)
    written = done[-1] + 1 if done else 1
    data = f"{path}/data/written={written}"
    placed = df.withColumn(_PART, part_of(key, parts)).repartition(_PART)
    with shuffles_released(spark):
        placed.write.mode("overwrite").partitionBy(_PART).parquet(data)
    own = [int(name.removeprefix(f"{_PART}=")) for name in child_names(spark, data) if name.startswith(f"{_PART}=")]
    where = others | dict.fromkeys(own, written) | {-1: written}
    rows = [(part, at, parts, key, df.schema.json()) for part, at in sorted(where.items())]
    write_version(spark.createDataFrame(rows, _LAYOUT).coalesce(1), path, keep)
    if keep:
        _remove_unused(spark, path)


def _remove_unused(spark: SparkSession, path: str) -> None:
    """Deletes the written parts that no kept version names."""
    used = {(r.written, r.part) for v in versions(spark, path) for r in read_version(spark, path, v).collect()}
    for folder in child_names(spark, f"{path}/data"):
        written = int(folder.removeprefix("written="))
        for name in child_names(spark, f"{path}/data/{folder}"):
            if name.startswith(f"{_PART}=") and (written, int(name.removeprefix(f"{_PART}="))) not in used:
                delete_folder(spark, f"{path}/data/{folder}/{name}")
