"""Mixing sources to target weights, block by block.

The words of each source form one long row, its documents in a pseudorandom order, cut into blocks of
``BLOCK`` words. A source's quota of words becomes a number of block slots. Output shards hold
``SHARD_SLOTS`` slots each; how many of them a source gets is a multinomial draw conditioned on the
quotas, made by halving the range of shards with hypergeometric draws seeded by the range, so that a
shard finds its own counts, and where its slots start within the source, without seeing the others.
Slot ``j`` of a source of ``n`` blocks is in pass ``j // n`` and takes the block that the pass's keyed
permutation gives to ``j % n``. Slots and blocks are joined on (source, block); the last slot of a
source takes only the words that are left of its quota. Texts are not moved for this; ``mixed_texts``
joins them to the spans found.

The mix takes ``ratio`` times all words. Quotas are the sources' shares by weight, at most ``cap``
times a source's words; what is above goes to the other sources by weight until none is above.

Cases
-----
* Sources are ordered by code point with NULL last and get the weights in turn.
* NULL, empty and blank texts have size 0 and take 0. A source without words has target 0.
* Repeated rows are counted first and placed one after the other, so no hot row meets in one task; each
  takes its own words. Rows that share a ``doc_id`` but not a text or a source are different documents.
* No documents, no rows. Only ``doc_id``, ``text`` and ``source`` are read.
* The result depends on the documents and the seed alone, not on how they are spread over tasks.

The per-source table (one row per source) is the only thing that reaches the driver.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lodgegrid.session import cut_lineage

from .common import WORD_PATTERN, boxed, documents, small_batches, small_table, unboxed
from .feistel import permute, unpermute

WEIGHTS = (5, 2, 1)
RATIO = 1.5
CAP = 2
BLOCK = 512
SHARD_SLOTS = 4096
BUCKET_DOCS = 8192
SEED = 7
#: Copies of a repeated row whose texts are cut in one task.
COPY_BLOCK = 32


@dataclass(frozen=True)
class Source:
    """A source's quota: ``slots`` block slots, of which the last takes ``last_take`` words."""

    rank: int
    name: str | None
    words: int
    target: float
    blocks: int
    slots: int
    last_take: int


def targets(sizes: list[int], weights: list[float], total: float, cap: float = CAP) -> list[float]:
    """Shares of ``total`` by weight, none above ``cap`` times its size."""
    target = [0.0] * len(sizes)
    free = [i for i, s in enumerate(sizes) if s > 0]
    left = float(total)
    while free:
        share = left / sum(weights[i] for i in free)
        full = [i for i in free if weights[i] * share > cap * sizes[i]]
        if not full:
            for i in free:
                target[i] = weights[i] * share
            break
        for i in full:
            target[i] = float(cap * sizes[i])
            left -= target[i]
        free = [i for i in free if i not in full]
    return target


def quota(rank: int, name: str | None, words: int, target: float, block: int, seed: int) -> Source:
    """Slots whose words are the target, rounded."""
    blocks = math.ceil(words / block)
    passes, rest = divmod(round(target), words) if words else (0, 0)
    full, left = 0, 0
    if rest:
        # only the source's last block may be short; ``place`` is its position in the pass
        short = blocks * block - words
        place = int(unpermute(np.array([blocks - 1]), blocks, seed, rank, passes)[0])
        full = (rest + short) // block
        if full > place:
            left = rest + short - full * block
        else:
            full, left = divmod(rest, block)
    return Source(rank, name, words, target, blocks, passes * blocks + full + (left > 0), left or block)


def source_table(sized: DataFrame, weights=WEIGHTS, ratio: float = RATIO, cap: float = CAP,
                 block: int = BLOCK, seed: int = SEED) -> list[Source]:
    """Quotas of all sources in order; ``sized`` has ``source`` and ``size``."""
    sums = {r.source: int(r.words) for r in sized.groupBy("source").agg(F.sum("size").alias("words")).collect()}
    names = sorted(sums, key=lambda name: (name is None, name or ""))
    own = [weights[i % len(weights)] for i in range(len(names))]
    goals = targets([sums[n] for n in names], own, ratio * sum(sums.values()), cap)
    return [quota(i, n, sums[n], g, block, seed) for i, (n, g) in enumerate(zip(names, goals))]


def hypergeometric(good: int, bad: int, draws: int, uniform: float) -> int:
    """How many of ``draws`` from ``good + bad`` are good, by inversion of ``uniform`` in [0, 1).

    The probabilities come from their ratios, outward from the likeliest value, as far as twelve standard
    deviations and 50; what lies beyond is below what a double resolves. So one sampler serves all sizes.
    """
    total = good + bad
    least, most = max(0, draws - bad), min(good, draws)
    if least == most:
        return least
    mode = min(max((draws + 1) * (good + 1) // (total + 2), least), most)
    spread = math.sqrt(draws / total * good / total * bad * ((total - draws) / max(total - 1, 1)))
    reach = int(12 * spread) + 50
    low, high = max(least, mode - reach), min(most, mode + reach)
    k = np.arange(low, high, dtype=np.float64)
    step = np.log((good - k) / (k + 1)) + np.log((draws - k) / (bad - draws + k + 1))
    logs = np.concatenate([[0.0], np.cumsum(step)])
    chance = np.cumsum(np.exp(logs - logs[mode - low]))
    return low + min(int(np.searchsorted(chance, uniform * chance[-1], "right")), high - low)


@lru_cache(maxsize=4096)
def _left_counts(own: tuple[int, ...], left_total: int, low: int, high: int, seed: int) -> tuple[int, ...]:
    """The slots of each source that fall to the left when the shards from ``low`` to ``high`` are halved."""
    uniform = np.random.default_rng([seed, low, high]).random(len(own)).tolist()
    left, rest_draw, rest_all = [], left_total, sum(own)
    for k, u in zip(own, uniform):
        left.append(hypergeometric(k, rest_all - k, rest_draw, u))
        rest_draw, rest_all = rest_draw - left[-1], rest_all - k
    return tuple(left)


def shard_counts(shard: int, shards: int, slots: np.ndarray, per_shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of each source in ``shard`` and in all shards before it.

    Halves the range of shards down to one, drawing how many of each source's slots fall to the left.
    """
    low, high, own, before = 0, shards, tuple(map(int, slots)), np.zeros(len(slots), dtype=np.int64)
    while high - low > 1:
        middle = (low + high) // 2
        left = _left_counts(own, (middle - low) * per_shard, low, high, seed)
        if shard < middle:
            high, own = middle, left
        else:
            low, own, before = middle, tuple(a - b for a, b in zip(own, left)), before + np.array(left, dtype=np.int64)
    return np.array(own, dtype=np.int64), before


def slot_table(spark: SparkSession, sources: list[Source], block: int = BLOCK,
               per_shard: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """``shard, slot, rank, turn, block, take``: every slot of every shard and the block it holds."""
    slots = np.array([s.slots for s in sources], dtype=np.int64)
    shards = math.ceil(int(slots.sum()) / per_shard)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard in batch["id"]:
                counts, before = shard_counts(int(shard), shards, slots, per_shard, seed)
                parts = []
                for s, count, start in zip(sources, counts, before):
                    if count:
                        turn, place = np.divmod(np.arange(start, start + count, dtype=np.int64), s.blocks)
                        index = np.empty(count, dtype=np.int64)
                        for t in np.unique(turn):
                            at = turn == t
                            index[at] = permute(place[at], s.blocks, seed, s.rank, int(t))
                        take = np.full(count, block, dtype=np.int64)
                        if start + count == s.slots:
                            take[-1] = s.last_take
                        parts.append((np.full(count, s.rank), turn, index, take))
                rank, turn, index, take = (np.concatenate(p) for p in zip(*parts))
                order = np.random.default_rng([seed, int(shard)]).permutation(len(rank))
                yield pd.DataFrame({
                    "shard": shard, "slot": order, "rank": rank, "turn": turn, "block": index, "take": take})

    return spark.range(shards).mapInPandas(
        run, "shard long, slot long, rank int, turn int, block long, take long")


def sized_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, source, size`` with the number of words, written once."""
    return cut_lineage(docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD_PATTERN)), F.lit(0)).cast("long").alias("size")), "sizes")


def placed_documents(sized: DataFrame, sources: list[Source], seed: int = SEED) -> DataFrame:
    """``sized`` with the source's ``rank`` and each document's first word position in its source.

    Positions are sums within pseudorandom buckets of bounded size on top of sums over buckets.
    """
    spark = sized.sparkSession
    ranks = small_table(spark, [(s.rank, s.name) for s in sources], "rank int, _name string")
    buckets = max(1, math.ceil(sized.count() / BUCKET_DOCS))
    counted = (
        sized.join(ranks, F.col("source").eqNullSafe(F.col("_name"))).drop("_name")
        .groupBy("rank", "source", "doc_id", "text_hash", "size").agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("key", F.xxhash64(F.lit(seed), "doc_id", "text_hash"))
        .withColumn("bucket", F.pmod("key", F.lit(buckets)))
    )
    sums = counted.groupBy("rank", "bucket").agg(F.sum(F.col("size") * F.col("copies")).alias("words"))
    before = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(
        "rank", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    within = (Window.partitionBy("rank", "bucket").orderBy("key", "doc_id", "text_hash")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = counted.withColumn("inner", F.coalesce(F.sum(F.col("size") * F.col("copies")).over(within), F.lit(0)))
    return (
        placed.join(base, ["rank", "bucket"])
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        .select("rank", "source", "doc_id", "text_hash", "size",
                (F.col("base") + F.col("inner") + F.col("copy") * F.col("size")).alias("first"), "copy")
    )


def mix(docs: DataFrame, weights=WEIGHTS, ratio: float = RATIO, cap: float = CAP, block: int = BLOCK,
        per_shard: int = SHARD_SLOTS, seed: int = SEED) -> tuple[DataFrame, list[Source]]:
    """The spans of the mix and the sources' quotas.

    A span is ``rank, source, doc_id, text_hash, size, first, copy`` of its document, ``shard, slot,
    turn`` of its place and ``word_from, n_words`` within the document's words. A document that takes
    nothing has one row without a place and with 0 words.
    """
    sized = sized_documents(docs)
    sources = source_table(sized, weights, ratio, cap, block, seed)
    size, first = F.col("size"), F.col("first")
    held = placed_documents(sized, sources, seed).withColumn("block", F.explode_outer(F.when(size > 0, F.sequence(
        F.floor(first / block), F.floor((first + size - 1) / block)))))
    # the slots come from Python, so their size is not known when the join is planned
    slots = slot_table(docs.sparkSession, sources, block, per_shard, seed).hint("merge")
    start = F.greatest(first, F.col("block") * block)
    end = F.least(first + size, F.col("block") * block + F.col("take"))
    spans = held.join(slots, ["rank", "block"], "left").withColumn(
        "n_words", F.when(F.col("take").isNotNull(), F.greatest(end - start, F.lit(0))))
    return spans.select(
        "rank", "source", "doc_id", "text_hash", "size", "first", "copy", "shard", "slot", "turn",
        (start - first).alias("word_from"), F.coalesce("n_words", F.lit(0)).cast("long").alias("n_words")), sources


def _cut(text: str, runs: list[tuple[int, int]]) -> list[str]:
    """The text from word ``a`` to before word ``b`` for every run; a run of all words is the text."""
    places = [m.span() for m in re.finditer(WORD_PATTERN, text)]
    return [text if (a, b) == (0, len(places)) else text[places[a][0]:places[b - 1][1]] for a, b in runs]


def merged_runs(spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Touching spans of a pass, joined; ``spans`` holds ``(turn, word_from, n_words)``."""
    out: list[tuple[int, int, int]] = []
    for turn, a, n in sorted(spans):
        if out and out[-1][0] == turn and out[-1][2] == a:
            out[-1] = (turn, out[-1][1], a + n)
        else:
            out.append((turn, a, a + n))
    return [(a, b) for _, a, b in out]


def mixed_texts(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """The mix as rows of ``docs``: one row per run of words taken in a pass, with its text.

    ``n_chars``, where there is such a column, is set to the new text's length. Rows of equal
    ``doc_id``, text and source are taken from one of them, whose other columns they then share.
    """
    same = ["doc_id", "text_hash", "source"]
    taken = spans.filter("n_words > 0").groupBy(*same, "copy").agg(
        F.collect_list(F.struct("turn", "word_from", "n_words")).alias("spans")).withColumn(
        "copies", F.floor(F.col("copy") / COPY_BLOCK))

    @F.pandas_udf("array<string>")
    def parts(text: pd.Series, runs: pd.Series) -> pd.Series:
        return pd.Series([
            _cut(t, merged_runs([(s["turn"], s["word_from"], s["n_words"]) for s in own])) for t, own in zip(text, runs)])

    # the text moves in ``doc`` alone
    keyed = boxed(small_batches(docs), F.col("doc_id").alias("id"), F.xxhash64("text").alias("own_hash"),
                  F.col("source").cast("string").alias("own_source"))
    # one row stands for all copies, once per block of them
    single = keyed.groupBy("id", "own_hash", "own_source").agg(
        F.first("doc").alias("doc"), F.count(F.lit(1)).alias("n")).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPY_BLOCK))))
    rows = single.join(
        taken,
        F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("own_hash") == F.col("text_hash"))
        & F.col("own_source").eqNullSafe(F.col("source")) & (F.col("block") == F.col("copies")))
    cut = rows.select("doc", F.explode(parts("doc.text", "spans")).alias("part"))
    new = {"text": F.col("part")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.char_length("part").cast(docs.schema["n_chars"].dataType)
    return unboxed(cut, docs.columns, **new)


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    spans, sources = mix(documents(spark, folder))
    table = small_table(
        spark, [(s.rank, s.words, s.target) for s in sources], "rank int, source_size long, target double")
    taken = spans.groupBy("rank", "first", "doc_id", "text_hash", "size", "copy").agg(
        F.sum("n_words").alias("taken"))
    return taken.join(table, "rank").select("doc_id", "size", "source_size", "target", "taken")
