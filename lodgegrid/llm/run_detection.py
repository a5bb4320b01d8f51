"""Periodic runs of words, by a suffix automaton with link-cut access.

The suffix automaton of a word sequence has one state per class of substrings with equal end positions;
its suffix links form a tree in which the path from a prefix's state to the root holds all suffixes of
that prefix. The words are taken one by one, and the appended word's prefix is *accessed* in a link-cut
tree over the links: the path to the root, made of segments last recoloured at different positions, gets
the colour of the new end. A segment with colour ``e'`` whose deepest state has length ``L`` says that the
longest suffix whose last earlier occurrence ended at ``e'`` has ``L`` words. With ``d = e - e'`` and
``d <= L`` the two occurrences touch or overlap: the last ``L + d`` words are a square and more, of
smallest period ``d`` (a smaller one would have shown a later occurrence) and extended to the left as far
as it goes. It is a run if the next word does not keep the period, so each run is reported once, at its
last word.

Most words are in no run. In a run of period ``q`` every window of ``window_words`` words comes again ``q``
words before or after inside that run, so stretches that no such recurring window covers are cut away
first, with sorted window hashes, until nothing more falls. What is left holds every run whole, ends
included; the automaton reads exact words.

Cases
-----
* NULL, empty and blank texts have no words, no runs and the empty collapsed text.
* A text is one row's work: its length in words bounds the memory of a task (some 500 bytes a word that
  survives the cut). Nothing is shuffled, so hot keys and repeated rows change nothing; repeated rows are
  repeated in the result.
* A NULL ``doc_id`` stays NULL; ``planted`` leaves its words as they are.
* Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import documents

MIN_LENGTH, MIN_EXPONENT = 6, 4
SLICE_BYTES = 8 << 20

Run = tuple[int, int, int]


def window_words(min_length: int, min_exponent: int) -> int:
    """The longest window that comes again inside every run that holds it.

    A run of length ``l`` and period ``q`` repeats all its windows of up to ``l - 2 q + 1`` words.
    """
    return min(max(min_length, min_exponent * q) - 2 * q + 1 for q in range(1, min_length + 1))


def stretches(codes: np.ndarray, width: int, min_length: int, min_exponent: int) -> list[tuple[int, int]]:
    """``[low, high)`` ranges outside of which no run has a word; ``codes`` hash single words."""
    if len(codes) < max(min_length, width):
        return []
    window = codes[: len(codes) - width + 1].copy()
    for i in range(1, width):
        window = window * np.uint64(0x9E3779B97F4A7C15) + codes[i : len(codes) - width + 1 + i]
    found, open_ranges = [], [(0, len(codes))]
    while open_ranges:
        low, high = open_ranges.pop()
        if high - low < min_length:
            continue
        own = window[low : high - width + 1]
        order = np.argsort(own, kind="stable")
        near = np.diff(order)
        # the distance to the next equal window; unequal neighbours are as good as never
        near[np.diff(own[order]) != 0] = len(codes)
        near = near <= (high - low) // min_exponent
        again = np.zeros(len(own), dtype=bool)
        again[order[:-1][near]] = True
        again[order[1:][near]] = True
        covered = np.zeros(high - low + 2, dtype=np.int64)
        at = np.flatnonzero(again)
        np.add.at(covered, at + 1, 1)
        np.add.at(covered, at + width + 1, -1)
        edge = np.diff((np.cumsum(covered) > 0).astype(np.int8))
        parts = [(low + int(a), low + int(b)) for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]
        if parts == [(low, high)]:
            found.append((low, high))
        else:
            open_ranges += parts
    return sorted(found)


def suffix_automaton(words: list) -> tuple[list[int], list[int], list[int]]:
    """Suffix links and lengths of all states, and the state of each prefix. State 1 is the root."""
    link, length, step = [0, 0], [0, 0], [{}, {}]
    ends, last = [], 1
    for word in words:
        state = len(link)
        link.append(1)
        length.append(length[last] + 1)
        step.append({})
        p = last
        while p and word not in step[p]:
            step[p][word] = state
            p = link[p]
        if p:
            q = step[p][word]
            if length[p] + 1 == length[q]:
                link[state] = q
            else:
                copy = len(link)
                link.append(link[q])
                length.append(length[p] + 1)
                step.append(step[q].copy())
                while p and step[p].get(word) == q:
                    step[p][word] = copy
                    p = link[p]
                link[q] = link[state] = copy
        ends.append(state)
        last = state
    return link, length, ends


class LinkCutColours:
    """A link-cut tree whose preferred paths are the segments of one colour.

    Each segment is a splay tree ordered by depth. The colour is kept at the splay root: a segment has
    one colour, an access gives the whole path to the root its own, and what it cuts off keeps the old.
    """

    def __init__(self, parent: list[int]):
        self.up = parent
        self.left = [0] * len(parent)
        self.right = [0] * len(parent)
        self.colour = [-1] * len(parent)

    def _splay(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        moved = False
        top = x
        while True:
            y = up[x]
            if not y or (left[y] != x and right[y] != x):
                break
            if not moved:
                # the root of the splay tree has the colour
                moved, top = True, y
                while up[top] and (left[up[top]] == top or right[up[top]] == top):
                    top = up[top]
            z = up[y]
            inner = z and (left[z] == y or right[z] == y)
            # zig-zig turns the parent first, zig-zag the node twice
            turns = ((y, x) if (left[y] == x) == (left[z] == y) else (x, x)) if inner else (x,)
            for n in turns:
                p = up[n]
                g = up[p]
                if left[p] == n:
                    c = right[n]
                    left[p] = c
                    right[n] = p
                else:
                    c = left[n]
                    right[p] = c
                    left[n] = p
                if c:
                    up[c] = p
                up[p] = n
                up[n] = g
                if g:
                    if left[g] == p:
                        left[g] = n
                    elif right[g] == p:
                        right[g] = n
        if moved:
            self.colour[x] = self.colour[top]

    def access(self, node: int, colour: int) -> Iterator[tuple[int, int]]:
        """Recolours the path from ``node`` to the root; gives each old segment's deepest node and colour."""
        up, right, own = self.up, self.right, self.colour
        below = 0
        while node:
            self._splay(node)
            if own[node] >= 0:
                yield node, own[node]
            cut = right[node]
            if cut:
                own[cut] = own[node]
            right[node] = below
            below = node
            node = up[node]
        own[below] = colour


def runs_in(words: list, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[Run]:
    """``(start, length, period)`` of all runs of ``words``, by start and period, without the cut."""
    link, length, ends = suffix_automaton(words)
    # the root belongs to no segment: it stands for the empty suffix
    tree = LinkCutColours([0 if p == 1 else p for p in link])
    found, n = [], len(words)
    for end, state in enumerate(ends):
        for node, before in tree.access(state, end):
            period = end - before
            size = length[node] + period
            if length[node] >= period and size >= min_length and size >= min_exponent * period and (
                    end + 1 == n or words[end + 1] != words[end + 1 - period]):
                found.append((end - size + 1, size, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def runs_of(words: list[bytes], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[Run]:
    """All runs of ``words``, by start, then period."""
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    found = []
    for low, high in stretches(codes, window_words(min_length, min_exponent), min_length, min_exponent):
        found += [(low + s, size, q) for s, size, q in runs_in(words[low:high], min_length, min_exponent)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, size, period in runs:
        change[start + period] += 1
        change[start + size] -= 1
    gone = np.cumsum(change)
    return [word for word, n in zip(words, gone.tolist()) if not n]


def planted(words: list[bytes], number: int) -> list[bytes]:
    """``words`` with a periodic tail where ``number`` asks for one; -1 asks for none."""
    n = len(words)
    if number < 0 or number % 10 or not n:
        return words
    g = number // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    part = words[a : a + p]
    return words[:a] + (part * ((n - a) // p + 1))[: n - a]


RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(
    docs: DataFrame,
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
    number: Column | None = None,
    edit: Callable[[list[bytes], int], list[bytes]] | None = None,
) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row of ``docs``.

    ``runs`` holds ``start, length, period`` in words, by start and period: the stretches of at least
    ``min_length`` words and ``min_exponent`` (2 or more) periods. ``collapsed`` is the text's words,
    joined by a space, with each run cut to its first period. ``edit`` changes a row's words before
    that, given ``number`` of the row (NULL: -1).
    """
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run has two periods and two words at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                counts, runs, texts = [], [], []
                for text, own in zip(part["text"].cast(pa.binary()).to_pylist(), part["number"].to_pylist()):
                    words = (text or b"").split()
                    words = edit(words, own) if edit else words
                    found = runs_of(words, min_length, min_exponent)
                    counts.append(len(words))
                    runs.append([{"start": s, "length": size, "period": q} for s, size, q in found])
                    texts.append(b" ".join(collapsed(words, found)))
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(counts, pa.int64()), pa.array(runs, RUN_TYPE),
                     pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    each = docs.select("doc_id", "text", F.coalesce(number if number is not None else F.lit(-1), F.lit(-1)).cast("long").alias("number"))
    return each.mapInArrow(
        run, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``SLICE_BYTES`` of text, a row at least."""
    sizes = np.diff(np.frombuffer(batch["text"].buffers()[1], np.int32)[batch["text"].offset :][: len(batch) + 1]) \
        if len(batch) and pa.types.is_string(batch["text"].type) else np.full(len(batch), 1)
    part = np.cumsum(sizes.astype(np.int64)) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(batch)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs(
        documents(spark, folder), number=F.crc32(F.col("doc_id").cast("string")), edit=planted)
    # greatest length first, then smallest start, then smallest period
    order = F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("q")))
    best = F.array_min(order)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.s").alias("start"),
        (-F.col("best.l")).alias("length"),
        F.col("best.q").alias("period"),
        F.floor(F.lit(-1000) * F.col("best.l") / F.col("best.q")).alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
