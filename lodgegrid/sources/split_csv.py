"""CSV files with quoted line breaks, read in parallel splits without moving the text.

Spark reads such a file in one task, because a line break alone does not tell whether
a record ends there: the break may lie in a quoted field. A quote opens a field only at
the field's start, so a line by itself tells in which state (in a quoted field or not) it
ends for either state it may begin in. It keeps the state, swaps it, or sets it, and so
does a split as a whole.

The first pass gives for every split that map, where its records begin for either state,
and its two border pieces: what comes before the first record and its last record, which
may go on in the next split. The maps, a row per split, tell the state every split begins
in, and with it which border pieces hold. The second pass reads the splits again and cuts
out the records in between; only border pieces are shuffled and put together. The state a
split begins in reaches the second pass as the set of splits that begin inside a field,
grouped by file: some bytes per split of the input.

A quote that is never closed, and a record larger than ``max_record_bytes``, fail with
the file's name and the place in it.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec, functions as F

from ..session import shared_dir

_SPLIT = ["file_path", "split_start"]

# The inside of a quoted field, where two quotes stand for one, and the fields that end
# on a line. A closed quoted field may go on up to the next comma, and its closing quote is
# one that no quote follows.
_QUOTED = '(?:[^"]|"")*'
_CLOSED = '"(?:[^",][^,]*)?,'
_FIELDS = f'(?:"{_QUOTED}{_CLOSED}|(?:[^",][^,]*)?,)*'
_OPENS = f'^{_FIELDS}"{_QUOTED}$'
_STAYS_OPEN = f'^{_QUOTED}(?:$|{_CLOSED}{_FIELDS}"{_QUOTED}$)'

MAX_RECORD_BYTES = 64 << 20
TASK_BYTES = 32 << 20

_INSIDE = (False, True)  # the two states a split may begin in


def read_split_records(
    spark: SparkSession, paths: list[str], columns: list[str], max_record_bytes: int = MAX_RECORD_BYTES
) -> DataFrame:
    """``file_path`` and the text ``columns`` of every record after the header.

    Fails on a file whose header is not ``columns``; case does not count, as in Spark's
    own check. The first pass runs when this is called.
    """
    lines = _lines(spark, paths)
    shared_dir(spark)
    # read several times below; a checkpoint keeps its partitions, however small splits are set
    borders = _borders(lines, max_record_bytes).checkpoint()
    entered = _entered(borders)
    refuse_open_quotes(entered)
    inner = _inner_records(lines, _entered_inside(entered), max_record_bytes)
    records = inner.unionByName(_join_borders(_border_pieces(entered), max_record_bytes))

    text = F.regexp_replace("text", r"^\ufeff|\r$", "")
    schema = ", ".join(f"`{c}` STRING" for c in columns)
    # the parser takes a buffer of this size for every record, 2 MB unless told otherwise
    row = F.from_csv(text, schema, {"quote": '"', "escape": '"', "inputBufferSize": "8192"})
    parsed = records.select("file_path", "split_start", "record", text.alias("text"), row.alias("row"))
    # as one text, so that the record is parsed once for it and not once a column
    expected = F.to_json(F.struct(*[F.lit(c).alias(c) for c in columns]))
    header_fits = F.coalesce(F.lower(F.to_json("row")) == F.lower(expected), F.lit(False))
    refusal = F.raise_error(F.concat(F.lit("another header in "), F.col("file_path")))
    content = (
        F.when((F.col("split_start") != 0) | (F.col("record") != 1), F.col("text") != "")
        .when(header_fits, F.lit(False))
        .otherwise(refusal.cast("boolean"))
    )
    return parsed.filter(content).select("file_path", "row.*")


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The lines of all splits; a task has those of a split together and in order.

    However small splits are set, a task reads ``TASK_BYTES`` of them where there are many.
    """
    size = spark.read.format("binaryFile").load(paths).agg(F.sum("length")).first()[0] or 0
    tasks = max(4 * spark.sparkContext.defaultParallelism, math.ceil(size / TASK_BYTES))
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("split_start"),
        "value",
    ).coalesce(tasks)


def states_before(opens: np.ndarray, stays: np.ndarray, entering: bool) -> tuple[np.ndarray, bool]:
    """Whether each line begins inside a quoted field, and whether the last one ends there."""
    n = len(opens)
    swaps = np.concatenate([[0], np.cumsum(opens & ~stays)])
    last_set = np.maximum.accumulate(np.concatenate([[-1], np.where(opens == stays, np.arange(n), -1)]))
    base = np.where(last_set >= 0, opens[last_set], entering)
    since = swaps - np.where(last_set >= 0, swaps[last_set + 1], 0)
    state = base ^ (since % 2 == 1)
    return state[:-1], bool(state[-1])


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """The batch cut where the split changes."""
    if not len(batch):
        return
    starts, paths = batch["split_start"].to_numpy(), batch["file_path"].dictionary_encode()
    number = paths.indices.to_numpy()
    cuts = [0, *(np.flatnonzero((np.diff(starts) != 0) | (np.diff(number) != 0)) + 1).tolist(), len(batch)]
    for a, b in zip(cuts, cuts[1:]):
        yield (paths.dictionary[int(number[a])].as_py(), int(starts[a])), batch.slice(a, b - a)


def line_flags(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The states after each line, for a beginning outside and inside a quoted field."""
    # bytes, since a text need not be UTF-8
    own = values.cast(pa.binary())
    return tuple(
        pc.match_substring_regex(own, pattern).to_numpy(zero_copy_only=False).astype(bool)
        for pattern in (_OPENS, _STAYS_OPEN))


@dataclass
class _Piece:
    """Lines gathered as slices of batches; beyond the limit only their size is kept."""

    limit: int
    slices: list[pa.Array] = field(default_factory=list)
    size: int = 0

    def add(self, values: pa.Array) -> None:
        own = values.cast(pa.binary())
        self.size += sum(map(len, own.to_pylist())) + len(own) if len(own) < 64 else int(
            np.diff(np.frombuffer(own.buffers()[1], np.int32)[own.offset : own.offset + len(own) + 1]).sum()) + len(own)
        if self.size > self.limit:
            self.slices.clear()
        else:
            self.slices.append(own)

    def text(self) -> bytes | None:
        return b"\n".join(x for part in self.slices for x in part.to_pylist()) if self.size <= self.limit else None


@dataclass
class _Fold:
    """A split read on the assumption that it begins in one state."""

    state: bool
    limit: int
    starts: int = 0
    offset: int = -1

    def __post_init__(self) -> None:
        self.head = _Piece(self.limit)
        self.tail = _Piece(self.limit)

    def add(self, values: pa.Array, opens: np.ndarray, stays: np.ndarray, sizes: np.ndarray, before: int) -> None:
        inside, self.state = states_before(opens, stays, self.state)
        begins = np.flatnonzero(~inside)
        if not len(begins):
            (self.tail if self.starts else self.head).add(values)
            return
        if not self.starts:
            self.head.add(values.slice(0, int(begins[0])))
        self.starts += len(begins)
        last = int(begins[-1])
        self.offset = before + int(sizes[:last].sum())
        self.tail = _Piece(self.limit)
        self.tail.add(values.slice(last))


_SIDE = "struct<inside:boolean,starts:long,offset:long,head:string,head_size:long,tail:string,tail_size:long>"
_SIDE_TYPE = pa.struct([
    ("inside", pa.bool_()), ("starts", pa.int64()), ("offset", pa.int64()), ("head", pa.string()),
    ("head_size", pa.int64()), ("tail", pa.string()), ("tail_size", pa.int64())])


def _borders(lines: DataFrame, limit: int) -> DataFrame:
    """Per split, for either state it may begin in: the state it ends in, how many records begin in
    it, where the last of them does, and the pieces before the first and from the last on."""

    def side(fold: _Fold) -> dict:
        head, tail = fold.head.text(), fold.tail.text()
        return {
            "inside": fold.state, "starts": fold.starts, "offset": fold.offset,
            "head": None if head is None else head.decode("utf-8", "surrogateescape"), "head_size": fold.head.size,
            "tail": None if tail is None else tail.decode("utf-8", "surrogateescape"), "tail_size": fold.tail.size}

    def row(split: tuple[str, int], folds: tuple[_Fold, _Fold]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([split[0]]), pa.array([split[1]], pa.int64()), *(pa.array([side(f)], _SIDE_TYPE) for f in folds)],
            [*_SPLIT, "outside", "within"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, folds, read = None, (), 0
        for batch in batches:
            for own, part in _parts(batch):
                if own != split:
                    if split:
                        yield row(split, folds)
                    split, folds, read = own, tuple(_Fold(state, limit) for state in _INSIDE), own[1]
                flags = line_flags(part["value"])
                sizes = pc.binary_length(part["value"].cast(pa.binary())).to_numpy().astype(np.int64) + 1
                for fold in folds:
                    fold.add(part["value"], *flags, sizes, read)
                read += int(sizes.sum())
        if split:
            yield row(split, folds)

    return lines.mapInArrow(run, f"file_path string, split_start long, outside {_SIDE}, within {_SIDE}")


def _entered(borders: DataFrame) -> DataFrame:
    """``borders`` with the state each split begins in and the side that holds."""
    maps = borders.select(*_SPLIT, F.col("outside.inside").alias("opens"), F.col("within.inside").alias("stays"))
    stepped = _steps(maps, Window.partitionBy("file_path").orderBy("split_start"))
    known = stepped.select(*_SPLIT, F.col("before_from_outside").alias("entering"))
    return borders.join(known, _SPLIT).withColumn(
        "side", F.when(F.col("entering"), F.col("within")).otherwise(F.col("outside")))


def refuse_open_quotes(entered: DataFrame) -> None:
    """Fails if a file ends inside a quoted field."""
    last = entered.groupBy("file_path").agg(
        F.max_by("side.inside", "split_start").alias("open"),
        F.max(F.when(F.col("side.starts") > 0, F.col("side.offset"))).alias("offset"))
    found = last.filter("open").orderBy("file_path").first()
    if found:
        raise ValueError(f"a quote is never closed in {found.file_path}, in the record near byte {found.offset}")


def _entered_inside(entered: DataFrame) -> dict[str, set[int]]:
    """The splits that begin inside a quoted field, by file."""
    found: dict[str, set[int]] = defaultdict(set)
    for r in entered.filter("entering").select(*_SPLIT).collect():
        found[r.file_path].add(r.split_start)
    return dict(found)


def _inner_records(lines: DataFrame, inside: dict[str, set[int]], limit: int) -> DataFrame:
    """All records but the last of each split, numbered from 1 in their split."""
    known = lines.sparkSession.sparkContext.broadcast(inside)

    def check(split: tuple[str, int], size: int) -> None:
        if size > limit:
            raise ValueError(f"a record of more than {limit} bytes in {split[0]}, in the split at byte {split[1]}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, state, number, pending, held = None, False, 0, [], 0
        for batch in batches:
            for own, part in _parts(batch):
                if own != split:
                    # what is pending belongs to the border of the split before
                    split, state, number, pending, held = own, own[1] in known.value.get(own[0], ()), 0, [], 0
                before, state = states_before(*line_flags(part["value"]), state)
                begins = np.flatnonzero(~before).tolist()
                values = part["value"].cast(pa.binary()).to_pylist()
                texts = []
                ends = np.cumsum([0, *(len(v) + 1 for v in values)])
                # lines that go on with a record; before the first record they belong to the border
                more = (begins[0] if begins else len(values)) if number else 0
                pending += values[:more]
                held += int(ends[more])
                for a, b in zip(begins, [*begins[1:], len(values)]):
                    if number:
                        check(own, held)
                        texts.append(b"\n".join(pending))
                    number += 1
                    pending, held = values[a:b], int(ends[b] - ends[a])
                check(own, held)
                n = len(texts)
                if n:
                    first = number - n
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([own[0]] * n), pa.array([own[1]] * n, pa.int64()),
                         pa.array(range(first, number), pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())],
                        [*_SPLIT, "record", "text"])

    return lines.mapInArrow(run, "file_path string, split_start long, record long, text string")


def _border_pieces(entered: DataFrame) -> DataFrame:
    """The pieces at the splits' borders; number 0 is the end of a record begun before the split."""
    side = F.col("side")
    head = F.struct(F.lit(0).cast("long").alias("record"), side["head"].alias("text"), side["head_size"].alias("size"))
    tail = F.struct(side["starts"].alias("record"), side["tail"].alias("text"), side["tail_size"].alias("size"))
    pieces = F.array_compact(F.array(F.when(side["head_size"] > 0, head), F.when(side["starts"] > 0, tail)))
    return entered.select(*_SPLIT, F.explode(pieces).alias("piece")).select(*_SPLIT, "piece.*")


def _steps(steps: DataFrame, order: WindowSpec) -> DataFrame:
    """``steps`` with the states before each, for either state at the start of the order.

    A step has the states ``opens`` (after a beginning outside) and ``stays`` (inside).
    """
    set_here = F.col("opens") == F.col("stays")
    swaps = F.count_if(F.col("opens") & ~F.col("stays"))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = steps.withColumn("_swaps", swaps.over(upto)).withColumn(
        "_set", F.last(F.when(set_here, F.struct("opens", "_swaps")), True).over(upto)
    )

    def state(entering: bool) -> Column:
        since = F.col("_swaps") - F.coalesce(F.col("_set._swaps"), F.lit(0))
        return F.coalesce(F.col("_set.opens"), F.lit(entering)) != (since % 2 == 1)

    after = marked.withColumn("from_outside", state(False))
    return after.withColumn("before_from_outside", F.lag("from_outside", 1, False).over(order)).drop("_swaps", "_set")


def _join_borders(pieces: DataFrame, limit: int) -> DataFrame:
    """Records from the first and last pieces of the splits: two rows per split at most."""
    in_file = Window.partitionBy("file_path").orderBy("split_start", "record")
    begun = F.count_if(F.col("record") > 0).over(
        in_file.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    size = F.sum("size").over(Window.partitionBy("file_path", "begun"))
    refusal = F.raise_error(F.concat(
        F.lit(f"a record of more than {limit} bytes in "), F.col("file_path"),
        F.lit(", in or before the split at byte "), F.col("split_start")))
    bounded = F.when(F.col("total") <= limit, F.col("text")).otherwise(refusal.cast("string"))
    ordered = F.array_sort(F.collect_list(F.struct("split_start", "record", "text")))
    return (
        pieces.withColumn("begun", begun)
        .withColumn("total", size)
        .withColumn("text", bounded)
        .groupBy("file_path", "begun")
        .agg(ordered.alias("pieces"))
        .select(
            "file_path",
            F.col("pieces")[0]["split_start"].alias("split_start"),
            F.col("pieces")[0]["record"].alias("record"),
            F.array_join(F.col("pieces.text"), "\n").alias("text"),
        )
    )
