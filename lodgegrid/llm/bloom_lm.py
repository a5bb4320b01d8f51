"""Language-model scores from a log-frequency Bloom filter.

The filter holds the counts of all word unigrams and bigrams of the training documents. A count is
quantised to a level on a logarithmic scale, and an n-gram is entered once for every level up to its
own, so probing level after level until one is missing gives the level back; it is never too low, and
too high with a probability of about one in a hundred a level. All bits of an entry lie in one 64-bit
word, so a probe reads one word. A level stands for the mean count of the n-grams on it.

The filter is built in segments: an n-gram belongs to the segment its hash names, a segment is as large
as its own n-grams need, and the number of segments follows the input. Tasks send a segment their
n-grams as packed arrays already summed over ``GATHERED_TOKENS`` tokens, so that arrays stay long where there
are many segments. Up to ``BROADCAST_BYTES`` all segments are
broadcast and every portion is probed where it is read. A larger filter stays in place: portions, gathered
likewise, send every segment their distinct n-grams, once and packed as the filter was built, and get a byte
for each back; a segment is probed for all of them at once. Both ways read the same levels, and what follows is the same for both.

Per token the levels of its word and bigram are stored (two bytes); the history's level is the one of
the word before. A token's probability depends on these three levels alone. It mixes the bigram's share
of its history with the unigram probability,
``(1 - w) * (c(word) + 1) / (N + V + 1) + w * c(history word) / c(history)``. The weight ``w`` depends on
the history's level. It is fitted on all training documents, from how often each triple of levels occurs,
each n-gram's own occurrence taken out of its count, so it does not trust what only that document says.
Scores are then looked up in a table of all triples. ``base_score`` uses exact counts: the most frequent
tokens (at most ``FREQUENT``) are added up where a portion is read, the rest are joined.

Cases
-----
* NULL and empty texts are one end token. An empty table, or no training documents, gives N = V = 0.
* A NULL ``doc_id`` is held out, so it is scored but not learned from.
* Repeated rows are learned from and scored one by one.
* n-grams are told apart by 64-bit hashes. Columns beyond ``doc_id`` and ``text`` are not read.
* A very long text is a portion of its own; arrays of a task hold some 40 bytes a word of it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lodgegrid.session import cut_lineage

from .common import SPACE_CHARS, documents, remainder, small_batches

FOLDS, HELD_OUT = 7, 2
HASHES = 5
BITS_PER_ENTRY = 12
SEGMENT_TEXT_BYTES = 8 << 20
BROADCAST_BYTES = 256 << 20
FREQUENT = 1 << 18
PORTION_BYTES = 768 << 10
GATHERED_TOKENS = 1 << 19
WEIGHTS = (0.0, 0.01, 0.03, 0.06, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)

#: Levels as stored: six bits for a word's and six for a bigram's; 63 is the history of a text's first token.
TOP_LEVEL, FIRST, CODES = 62, 63, 1 << 18

_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_U32 = np.uint64(32)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


END, START = mixed(np.array([1, 2], dtype=np.uint64) * _C1)

# A byte's value in a word's hash: a random one, the same for A-Z as for a-z.
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * _C2)
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[ord(c) for c in SPACE_CHARS]] = True
_STEP = np.uint64(0x9E3779B97F4A7C13)


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n - 1, 0), _STEP)]), dtype=np.uint64)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in ``data``, and how many each text has.

    ``offsets`` are the texts' borders in the bytes ``data``. A word's hash is the sum of its bytes' random
    values times powers of an odd number, mixed with its length.
    """
    if not len(data):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(offsets) - 1, dtype=np.int64)
    solid = ~_SPACE[data]
    cut = np.zeros(len(data), dtype=bool)  # no word goes on over a text's first byte
    cut[offsets[:-1][offsets[:-1] < len(data)]] = True
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1] | cut[1:]
    ends[:-1] &= ~solid[1:] | cut[1:]
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    size = stop - start
    powers = _powers(int(size.max(initial=1)))
    out = np.empty(len(start), dtype=np.uint64)
    total = np.cumsum(size)
    low = 0
    while low < len(start):  # about a megabyte of words at a time
        before = int(total[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(total, before + (1 << 20), "right")))
        own = size[low:high]
        first = np.cumsum(own) - own
        inside = np.arange(int(own.sum())) - np.repeat(first, own)
        value = _BYTE[data[np.repeat(start[low:high], own) + inside]] * powers[inside]
        out[low:high] = np.add.reduceat(value, first)
        low = high
    return mixed(out + size.astype(np.uint64) * _C1), np.diff(np.searchsorted(start, offsets))


@dataclass
class Portion:
    """The tokens of some texts: ``sizes`` tokens each, the last of them the end."""

    tokens: np.ndarray
    sizes: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes

    def pairs(self) -> np.ndarray:
        history = np.empty_like(self.tokens)
        history[1:] = self.tokens[:-1]
        history[self.starts] = START
        return mixed(history * _C1 + self.tokens * _C2 + np.uint64(1))


def portion_of(data: np.ndarray, offsets: np.ndarray) -> Portion:
    words, counts = word_hashes(data, offsets)
    sizes = counts + 1
    tokens = np.empty(len(words) + len(counts), dtype=np.uint64)
    last = np.zeros(len(tokens), dtype=bool)
    last[np.cumsum(sizes) - 1] = True
    tokens[last], tokens[~last] = END, words
    return Portion(tokens, sizes)


def portions(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, Portion]]:
    """The batch in parts of about ``PORTION_BYTES`` of ``text``, which is never NULL."""
    if not len(batch):
        return
    text = batch["text"]
    borders = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
    part = (borders[1:] - borders[0]) // PORTION_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(text)]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a), portion_of(data[borders[a] : borders[b]], borders[a : b + 1] - borders[a])


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict[str, list], Portion]]:
    """The portions of a task put together up to ``GATHERED_TOKENS`` tokens, with their rows but for ``text``.

    What is sent to segments is an array for each pair of a portion and a segment, so portions as small as
    those that are probed where they are read would make ever more and ever shorter arrays.
    """
    rows: dict[str, list] = {}
    held: list[Portion] = []

    def put_together() -> Portion:
        return Portion(np.concatenate([p.tokens for p in held]), np.concatenate([p.sizes for p in held]))

    for batch in batches:
        for part, own in portions(batch):
            if held and sum(len(p.tokens) for p in held) + len(own.tokens) > GATHERED_TOKENS:
                yield rows, put_together()
                rows, held = {}, []
            held.append(own)
            for name in part.schema.names:
                if name != "text":
                    rows.setdefault(name, []).extend(part[name].to_pylist())
    if held:
        yield rows, put_together()


def levels_of(counts: np.ndarray) -> np.ndarray:
    """Level 1 holds count 1, level 2 the counts 2 and 3, level 3 those from 4 to 7, and so on."""
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)


def _places(ids: np.ndarray, level: int, words: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """The word of a segment of ``words`` 64-bit words that an entry lies in, and its bits there."""
    seed = mixed(ids + np.array([level], dtype=np.uint64) * _C2)
    bits = mixed(seed ^ _C1)
    mask = np.zeros(len(ids), dtype=np.uint64)
    for i in range(HASHES):
        mask |= np.uint64(1) << ((bits >> np.uint64(6 * i)) & np.uint64(63))
    return (((seed >> _U32) * np.asarray(words, dtype=np.uint64)) >> _U32).astype(np.int64), mask


def build_segment(ids: np.ndarray, counts: np.ndarray, bits_per_entry: int = BITS_PER_ENTRY) -> np.ndarray:
    """The words of a segment from its distinct n-grams."""
    level = levels_of(counts)
    out = np.zeros(max(1, math.ceil(int(level.sum()) * bits_per_entry / 64)), dtype=np.uint64)
    for own in range(1, int(level.max(initial=0)) + 1):
        at, mask = _places(ids[level >= own], own, len(out))
        np.bitwise_or.at(out, at, mask)
    return out


@dataclass
class Filter:
    """Segments laid end to end: segment ``s`` is the words from ``start[s]`` to ``start[s + 1]``."""

    data: np.ndarray
    start: np.ndarray

    def levels(self, ids: np.ndarray) -> np.ndarray:
        """Each n-gram's level, 0 if it was never entered."""
        segment = (ids % np.uint64(len(self.start) - 1)).astype(np.int64)
        low = self.start[segment]
        words = self.start[segment + 1] - low
        found, alive, level = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids)), 1
        while len(alive) and level <= TOP_LEVEL:
            at, mask = _places(ids[alive], level, words[alive])
            alive = alive[self.data[low[alive] + at] & mask == mask]
            found[alive] = level
            level += 1
        return found


def _distinct(ids: np.ndarray) -> np.ndarray:
    """The different ``ids`` in order; sorted, which takes a tenth of the time of a hash table of them."""
    ids = np.sort(ids)
    first = np.ones(len(ids), dtype=bool)
    first[1:] = ids[1:] != ids[:-1]
    return ids[first]


def _by_segment(ids: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order that puts ``ids`` by segment, where each segment begins in it, and the segments there are."""
    segment = (ids % np.uint64(segments)).astype(np.int64)
    order = np.argsort(segment, kind="stable")
    some, first = np.unique(segment[order], return_index=True)
    return order, first, some


def _packed(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """A binary array of the parts of ``values`` that begin at ``first``."""
    borders = np.append(first, len(values)).astype(np.int64) * values.itemsize
    return pa.Array.from_buffers(
        pa.binary(), len(first), [None, pa.py_buffer(borders.astype(np.int32).tobytes()), pa.py_buffer(values.tobytes())])


def gram_table(docs: DataFrame, segments: int, bits_per_entry: int = BITS_PER_ENTRY) -> DataFrame:
    """``segment, order, bits, n, total, ids, counts`` of all n-grams of ``docs``, a row per segment and order.

    ``n`` and ``total`` hold, by level, how many n-grams there are and the sum of their counts. Only
    unigrams keep their ``ids`` and exact ``counts``.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, own in gathered(batches):
            for order, grams in ((1, own.tokens), (2, own.pairs())):
                ids, counts = np.unique(grams, return_counts=True)
                by, first, some = _by_segment(ids, segments)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int64()), pa.array(np.full(len(some), order), pa.int32()),
                     _packed(ids[by], first), _packed(counts[by].astype("<u4"), first)],
                    ["segment", "order", "ids", "counts"])

    def gather(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        ids = np.concatenate([np.frombuffer(b, np.uint64) for b in frame["ids"]])
        counts = np.concatenate([np.frombuffer(b, "<u4") for b in frame["counts"]]).astype(np.int64)
        distinct, place = np.unique(ids, return_inverse=True)
        total = np.bincount(place, weights=counts, minlength=len(distinct)).astype(np.int64)
        level = levels_of(total)
        exact = key[1] == 1
        return pd.DataFrame({
            "segment": [key[0]], "order": [key[1]], "bits": [build_segment(distinct, total, bits_per_entry).tobytes()],
            "n": [np.bincount(level)], "total": [np.bincount(level, weights=total).astype(np.int64)],
            "ids": [distinct.tobytes() if exact else None],
            "counts": [total.astype("<i8").tobytes() if exact else None]})

    return (
        docs.select("text").mapInArrow(deal, "segment long, order int, ids binary, counts binary")
        .groupBy("segment", "order").applyInPandas(
            gather, "segment long, order int, bits binary, n array<long>, total array<long>, ids binary, counts binary")
    )


def unigram_table(grams: DataFrame) -> DataFrame:
    """``token, c``: exact counts of all tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, counts in zip(batch["ids"].to_pylist(), batch["counts"].to_pylist()):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(ids, np.int64)), pa.array(np.frombuffer(counts, "<i8"))], ["token", "c"])

    return grams.filter("order = 1").select("ids", "counts").mapInArrow(run, "token long, c long")


def level_table(grams: DataFrame) -> DataFrame:
    """``order, level, n, total``: how many n-grams are on each level and the sum of their counts."""
    each = grams.select("order", F.posexplode(F.arrays_zip("n", "total")).alias("level", "own"))
    return each.groupBy("order", "level").agg(
        F.sum("own.n").alias("n"), F.sum("own.total").alias("total"))


def codes_of(levels: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Each token's triple of levels (word, history, bigram) as one number, from what is stored."""
    word = levels.astype(np.int64) >> 6
    history = np.empty_like(word)
    history[1:] = word[:-1]
    history[starts] = FIRST
    return word << 12 | history << 6 | (levels & 63)


@dataclass
class Model:
    """What scoring needs beside the levels."""

    tokens: int
    vocabulary: int
    documents: int
    means: dict[int, np.ndarray]
    weights: np.ndarray

    def mean(self, order: int, level: np.ndarray) -> np.ndarray:
        """The count that a level stands for; levels that only false hits reach take the top one."""
        return self.means[order][np.minimum(level, len(self.means[order]) - 1)]

    def parts(self, code: np.ndarray, own: int) -> tuple[np.ndarray, np.ndarray]:
        """Unigram probability and the bigram's share, with ``own`` occurrences taken out."""
        level = code >> 6 & 63
        given = np.where(level == FIRST, float(self.documents), self.mean(1, level))
        word, given, pair = (
            np.maximum(count - own, 0) for count in (self.mean(1, code >> 12), given, self.mean(2, code & 63)))
        share = np.where(given > 0, np.minimum(pair / np.maximum(given, 1e-9), 1.0), 0.0)
        return (word + 1) / (self.tokens + self.vocabulary + 1), share

    def learn_weights(self, code: np.ndarray, times: np.ndarray) -> None:
        """The likeliest weight for each level of the history, given how often each triple occurs."""
        unigram, share = self.parts(code, 1)
        level = code >> 6 & 63
        value = np.array([
            np.bincount(level, weights=times * np.log10((1 - w) * unigram + w * share), minlength=64) for w in WEIGHTS])
        seen = np.bincount(level, minlength=64) > 0
        self.weights[seen] = np.array(WEIGHTS)[value.argmax(axis=0)][seen]

    def table(self) -> np.ndarray:
        """The log probability of every triple."""
        code = np.arange(CODES)
        unigram, share = self.parts(code, 0)
        weight = self.weights[code >> 6 & 63]
        return np.log10((1 - weight) * unigram + weight * share)


def load_filter(table: DataFrame, segments: int) -> dict[int, Filter]:
    """All segments in one piece per order; called only under ``BROADCAST_BYTES``."""
    parts: dict[int, list[bytes]] = {order: [b"\0" * 8] * segments for order in (1, 2)}
    for r in table.toLocalIterator():
        parts[r.order][r.segment] = bytes(r.bits)
    return {
        order: Filter(np.frombuffer(b"".join(own), np.uint64), np.cumsum([0, *(len(b) // 8 for b in own)]))
        for order, own in parts.items()
    }


@dataclass
class Summing:
    """Sums of exact counts over a text's tokens, where the counts are known here."""

    keys: np.ndarray
    counts: np.ndarray
    total: int

    def sums(self, own: Portion, distinct: np.ndarray, place: np.ndarray, level: np.ndarray) -> list[pa.Array]:
        """``known, base, rare, times`` of each text; ``rare`` are the tokens whose counts are not known.

        A token that the filter does not hold has the count 0.
        """
        at = np.minimum(np.searchsorted(self.keys, distinct), max(len(self.keys) - 1, 0))
        common = self.keys[at] == distinct if len(self.keys) else np.zeros(len(distinct), dtype=bool)
        count = np.where(common, self.counts[at], 0) if len(self.keys) else np.zeros(len(distinct), dtype=np.int64)
        rare = ~common & (level > 0)
        value = np.where(rare, 0.0, np.log10((count + 1) / self.total))
        known = np.add.reduceat((count > 0)[place].astype(np.int64), own.starts)
        base = np.add.reduceat(value[place], own.starts)
        some = rare[place]
        text = np.repeat(np.arange(len(own.sizes)), own.sizes)[some]
        each, times = np.unique(text * len(distinct) + place[some], return_counts=True)
        borders = pa.array(np.searchsorted(each, np.arange(len(own.sizes) + 1) * len(distinct)), pa.int32())
        return [
            pa.array(known, pa.int64()), pa.array(base),
            pa.ListArray.from_arrays(borders, pa.array(distinct[each % len(distinct)].view(np.int64))),
            pa.ListArray.from_arrays(borders, pa.array(times, pa.int32()))]


_FOUND = ["known", "base", "rare", "times"]
_FOUND_TYPES = "n_tokens long, levels binary, known long, base double, rare array<long>, times array<int>"


def _found(own: Portion, distinct, place, word_level, pair_level, summing: Summing) -> list[pa.Array]:
    """The columns of ``_FOUND_TYPES`` of a portion, from the levels of its distinct words and of its bigrams."""
    levels = (np.minimum(word_level, TOP_LEVEL)[place] << 6 | np.minimum(pair_level, 63)).astype("<u2")
    return [pa.array(own.sizes, pa.int64()), _packed(levels, own.starts), *summing.sums(own, distinct, place, word_level)]


def probed_where_read(docs: DataFrame, grams, summing) -> DataFrame:
    """``row, doc_id, held_out`` and ``_FOUND_TYPES`` of every text, with the broadcast filter ``grams``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, own in portions(batch):
                distinct, place = np.unique(own.tokens, return_inverse=True)
                word_level = grams.value[1].levels(distinct)
                yield pa.RecordBatch.from_arrays(
                    [part["row"], part["doc_id"], part["held_out"],
                     *_found(own, distinct, place, word_level, grams.value[2].levels(own.pairs()), summing.value)],
                    ["row", "doc_id", "held_out", "n_tokens", "levels", *_FOUND])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"row long, doc_id {kind}, held_out boolean, {_FOUND_TYPES}")


def answers_of(segment: bytes, asked: pd.Series) -> list[bytes]:
    """A byte for the level of each n-gram in the packed arrays ``asked``, which are probed at once:
    a probe of a few costs as much as one of a thousand."""
    one = Filter(np.frombuffer(segment, np.uint64), np.array([0, len(segment) // 8]))
    found = one.levels(np.frombuffer(b"".join(asked), np.uint64)).astype(np.uint8).tobytes()
    ends = np.cumsum([0, *(len(ids) // 8 for ids in asked)]).tolist()
    return [found[a:b] for a, b in zip(ends, ends[1:])]


def probed_in_place(docs: DataFrame, segments: DataFrame, n_segments: int, summing) -> DataFrame:
    """What ``probed_where_read`` gives, with the filter's segments where they are.

    A portion goes with its distinct words and each token's number among them, so that it is read once.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, own in gathered(batches):
            distinct, place = np.unique(own.tokens, return_inverse=True)
            name = rows["row"][0]
            for order, ids in ((1, distinct), (2, _distinct(own.pairs()))):
                by, first, some = _by_segment(ids, n_segments)
                n = len(some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * n, pa.int64()), pa.array([order] * n, pa.int32()), pa.array(some, pa.int64()),
                     _packed(ids[by], first), pa.nulls(n, record)], names)
            own_record = {
                **rows, "sizes": own.sizes.tolist(), "words": distinct.tobytes(), "place": place.astype("<u4").tobytes()}
            yield pa.RecordBatch.from_arrays(
                [pa.array([name], pa.int64()), pa.array([0], pa.int32()), pa.array([0], pa.int64()),
                 pa.nulls(1, pa.binary()), pa.array([own_record], record)], names)

    def probe(key: tuple, asked: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        blob = bytes(own["bits"].iloc[0]) if len(own) else b"\0" * 8
        return pd.DataFrame({
            "portion": asked["portion"], "order": asked["order"], "segment": asked["segment"],
            "levels": answers_of(blob, asked["ids"])})

    def assemble(key: tuple, records: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        record = records["record"].iloc[0]
        distinct, place = np.frombuffer(record["words"], np.uint64), np.frombuffer(record["place"], "<u4").astype(np.int64)
        own = Portion(distinct[place], np.asarray(record["sizes"], dtype=np.int64))
        pairs, pair_place = np.unique(own.pairs(), return_inverse=True)
        found = {}
        for order, ids in ((1, distinct), (2, pairs)):
            some = answers[answers["order"] == order].sort_values("segment")
            by, _, _ = _by_segment(ids, n_segments)
            found[order] = np.empty(len(ids), dtype=np.int64)
            found[order][by] = np.frombuffer(b"".join(some["levels"]), np.uint8)
        columns = _found(own, distinct, place, found[1], found[2][pair_place], summing.value)
        return pd.DataFrame({
            "row": list(record["row"]), "doc_id": list(record["doc_id"]), "held_out": list(record["held_out"]),
            **{name: column.to_pylist() for name, column in zip(["n_tokens", "levels", *_FOUND], columns)}})

    names = ["portion", "order", "segment", "ids", "record"]
    # an id as text stays whole among NULLs
    record = pa.struct([("row", pa.list_(pa.int64())), ("doc_id", pa.list_(pa.string())), ("held_out", pa.list_(pa.bool_())),
                        ("sizes", pa.list_(pa.int64())), ("words", pa.binary()), ("place", pa.binary())])
    record_type = ("struct<row:array<long>,doc_id:array<string>,held_out:array<boolean>,"
                   "sizes:array<long>,words:binary,place:binary>")
    asked = cut_lineage(docs.withColumn("doc_id", F.col("doc_id").cast("string")).mapInArrow(
        ask, f"portion long, order int, segment long, ids binary, record {record_type}"), "asked")
    answers = (
        asked.filter("order > 0").drop("record").groupBy("order", "segment")
        .cogroup(segments.groupBy("order", "segment"))
        .applyInPandas(probe, "portion long, order int, segment long, levels binary"))
    records = asked.filter("order = 0").select("portion", "record")
    found = records.groupBy("portion").cogroup(answers.groupBy("portion")).applyInPandas(
        assemble, f"row long, doc_id string, held_out boolean, {_FOUND_TYPES}")
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def _stored_codes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The triples of all tokens of a batch of stored levels, and where each text begins."""
    parts = [np.frombuffer(b, "<u2") for b in batch["levels"].to_pylist()]
    sizes = np.array([len(p) for p in parts])
    starts = np.cumsum(sizes) - sizes
    return codes_of(np.concatenate(parts), starts), starts


def code_counts(probed: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The triples of levels in the training texts, and how often each occurs: ``CODES`` rows at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = np.zeros(CODES, dtype=np.int64)
        for batch in batches:
            if len(batch):
                times += np.bincount(_stored_codes(batch)[0], minlength=CODES)
        code = np.flatnonzero(times)
        yield pa.RecordBatch.from_arrays([pa.array(code, pa.int64()), pa.array(times[code])], ["code", "times"])

    rows = probed.filter("NOT held_out").select("levels").mapInArrow(run, "code long, times long").groupBy("code").agg(
        F.sum("times").alias("times")).collect()
    return np.array([r.code for r in rows], dtype=np.int64), np.array([r.times for r in rows], dtype=np.int64)


def scored(probed: DataFrame, table) -> DataFrame:
    """``probed`` with ``score`` in place of the levels, from the broadcast ``table`` of all triples."""
    names = ["row", "doc_id", "held_out", "n_tokens", "known", "base"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                code, starts = _stored_codes(batch)
                yield pa.RecordBatch.from_arrays(
                    [*(batch[n] for n in names), pa.array(np.add.reduceat(table.value[code], starts))], [*names, "score"])

    kept = ", ".join(f"{n} {probed.schema[n].dataType.simpleString()}" for n in names)
    return probed.select(*names, "levels").mapInArrow(run, f"{kept}, score double")


def lm_scores(docs: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT,
              broadcast_bytes: int = BROADCAST_BYTES, bits_per_entry: int = BITS_PER_ENTRY) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``.

    Rows whose crc32 remainder by ``folds`` is ``held_out`` are scored but not learned from.
    """
    spark = docs.sparkSession
    docs = small_batches(docs).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(remainder("doc_id", folds) == held_out, F.lit(True)).alias("held_out"))
    train = docs.filter("NOT held_out")
    size = train.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    n_segments = max(1, math.ceil((size[0] or 0) / SEGMENT_TEXT_BYTES))
    grams = cut_lineage(gram_table(train, n_segments, bits_per_entry), "grams")
    unigrams = cut_lineage(unigram_table(grams), "unigrams")
    by_level = level_table(grams).collect()  # a few dozen rows per order
    means = {order: np.zeros(1 + max((r.level for r in by_level if r.order == order), default=0)) for order in (1, 2)}
    for r in by_level:
        means[r.order][r.level] = r.total / r.n if r.n else 0.0
    words = sorted(((r.level, r.n, r.total) for r in by_level if r.order == 1), reverse=True)
    model = Model(sum(w[2] for w in words), sum(w[1] for w in words), size[1], means, np.zeros(64))
    # whole levels from the top, as long as they hold at most FREQUENT tokens
    floor, held = math.inf, 0
    for level, n, _ in words:
        held += n
        if level == 0 or held > FREQUENT:
            break
        floor = 1 << (level - 1)
    frequent = [] if math.isinf(floor) else unigrams.filter(F.col("c") >= floor).collect()
    keys = np.array([r.token for r in frequent], dtype=np.int64).view(np.uint64)
    order = np.argsort(keys)
    total = model.tokens + model.vocabulary + 1
    summing = spark.sparkContext.broadcast(
        Summing(keys[order], np.array([r.c for r in frequent], dtype=np.int64)[order], total))
    segments = grams.select("order", "segment", "bits")
    filter_bytes = segments.agg(F.sum(F.octet_length("bits"))).first()[0] or 0
    if filter_bytes <= broadcast_bytes:
        probed = probed_where_read(docs, spark.sparkContext.broadcast(load_filter(segments, n_segments)), summing)
    else:
        probed = probed_in_place(docs, segments, n_segments, summing)
    probed = cut_lineage(probed, "probed")
    model.learn_weights(*code_counts(probed))
    rows = scored(probed, spark.sparkContext.broadcast(model.table()))
    c = F.coalesce("c", F.lit(0))
    each = probed.select(F.col("row").alias("of_row"), F.explode(F.arrays_zip("rare", "times")).alias("own")).select(
        "of_row", F.col("own.rare").alias("token"), F.col("own.times").alias("times"))
    rare = each.join(unigrams, "token", "left").groupBy("of_row").agg(
        F.sum(F.col("times") * F.log10((c + 1) / F.lit(float(total)))).alias("rare_base"),
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("rare_known"))
    return rows.join(rare, F.col("row") == F.col("of_row"), "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(int(model.tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"), "score")


def op9_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scores(documents(spark, folder))
