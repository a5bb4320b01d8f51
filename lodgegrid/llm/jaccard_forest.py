"""Near-duplicate join on word n-grams by a MinHash LSH forest.

A document is the set of its five-word shingles. Documents with equal sets form one class, and only one
row per class goes on. Its MinHash signature fills ``TREES`` tries: in each it is a label of
``DEPTH`` one-byte hashes, and sorted labels are the trie. Two classes meet where their labels share a
prefix. Prefixes are as long as the crowd in a trie's node asks for, and matches are shortened as far as
the recall asks for. From the full label the prefix is shortened until a pair at the threshold meets in
some trie with probability ``TARGET_RECALL``; shorter prefixes would only add pairs below the threshold.
Where more than ``WIDE_NODE`` classes meet at such a prefix, they part again by longer ones: the classes
of crowded nodes, and only they, get the labels of a deeper forest, ``DEEP_DEPTH`` hashes long in as many
tries as keep the recall. Texts that share much but less than the threshold part there, copies stay
together. Spark sorts labels by (tree, prefix) and joins the runs of equal ones. Every pair met is then
verified on the whole shingle sets, so no pair below the threshold stays. Groups are the connected
components of the links.

A deep node of more than ``WIDE_NODE`` classes forms no pairs. The classes that such nodes connect are a
wide group, all of whose pairs are verified a pair of blocks at a time; a block task writes a count and a
connection per class. So what is written grows with the classes, not with the square of a group. A class
of a wide group of ``m`` is sent to ``m / BLOCK`` tasks.

Cases
-----
* Words are as they stand in the text, case included. A text of one to four words is one shingle.
* NULL, empty and blank texts have no shingle. They are one class with each other and link to nothing.
* A NULL ``doc_id`` belongs to no class: it keeps its row, with NULL ids and 0 links. ``keep_one``
  compares such rows too, by their texts.
* Rows that share a ``doc_id`` but not a text count as several documents; a class or group is named by
  the smallest ``doc_id`` in it.
* Repeated rows are copies of each other. No documents, no rows.
* Columns beyond ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lodgegrid.session import cut_lineage

from .common import WORD_PATTERN, boxed, documents, id_carried, id_restored, small_batches, unboxed

WORDS = 5
THRESHOLD = 0.8
TREES = 32
DEPTH = 8
TARGET_RECALL = 0.9999
#: Classes at nodes of more than this part by longer prefixes; at deep ones they are verified in blocks.
WIDE_NODE = 32
DEEP_DEPTH = 12
BLOCK = 256
#: Ids of verified documents are broadcast up to this many (16 bytes each), and shuffled beyond.
BROADCAST_IDS = 1_000_000

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_RANDOM = np.random.default_rng(5)
_FACTORS = (_RANDOM.integers(0, 2**32, TREES * DEPTH, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_OFFSETS = _RANDOM.integers(0, 2**32, TREES * DEPTH, dtype=np.uint64).astype(np.uint32)


def prefix_depth(threshold: float, trees: int = TREES, depth: int = DEPTH, target: float = TARGET_RECALL) -> int:
    """The longest prefix at which a pair at the threshold meets with the target probability."""
    while depth > 1 and 1 - (1 - threshold ** depth) ** trees < target:
        depth -= 1
    return depth


def trees_for(threshold: float, depth: int = DEEP_DEPTH, target: float = TARGET_RECALL) -> int:
    """How many tries a pair at the threshold needs to meet in one of them with the target probability."""
    return math.ceil(math.log(1 - target) / math.log1p(-threshold ** depth)) if threshold < 1 else 1


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    parts = (text or "").encode("utf-8", "surrogatepass").split()
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    n = min(words, len(parts))
    total = np.full(len(parts) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        total = total * _GOLDEN + hashes[i:len(parts) - n + 1 + i]
        total ^= total >> np.uint64(29)
    return np.unique(total * _GOLDEN)


def minhashes(hashes: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The least value of each 32-bit hash function over the shingles."""
    short = ((hashes ^ (hashes >> np.uint64(32))) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    lowest = np.full(len(factors), 0xFFFFFFFF, dtype=np.uint32)
    step = max(256, (1 << 20) // len(factors))
    for low in range(0, len(short), step):
        part = short[low:low + step]
        np.minimum(lowest, (part[None, :] * factors[:, None] + offsets[:, None]).min(axis=1), out=lowest)
    return lowest


def labels(hashes: np.ndarray) -> np.ndarray:
    """One label per tree as a whole number: ``DEPTH`` one-byte MinHashes, the first the highest."""
    lowest = minhashes(hashes, _FACTORS, _OFFSETS)
    return (lowest >> np.uint32(24) ^ lowest).astype(np.uint8).reshape(TREES, DEPTH).view(">i8").ravel().astype(np.int64)


def deep_labels(hashes: np.ndarray, trees: int, depth: int = DEEP_DEPTH) -> np.ndarray:
    """One label per tree of the deeper forest: ``depth`` whole MinHashes, put into 64 bits."""
    draw = np.random.default_rng(6)
    factors = (draw.integers(0, 2**32, trees * depth, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
    offsets = draw.integers(0, 2**32, trees * depth, dtype=np.uint64).astype(np.uint32)
    own = minhashes(hashes, factors, offsets).reshape(trees, depth).astype(np.uint64)
    label = np.zeros(trees, dtype=np.uint64)
    for i in range(depth):
        label = (label ^ own[:, i]) * _GOLDEN
        label ^= label >> np.uint64(29)
    return label.view(np.int64)


def signature_table(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, text_hash, set_key, n_shingles, labels`` of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingles(t, words) for t in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "_no_id": batch["_no_id"], "text_hash": batch["text_hash"],
                "set_key": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
                "n_shingles": [len(s) for s in sets],
                "labels": [labels(s) if len(s) else None for s in sets],
            })

    rows = id_carried(small_batches(docs).select("doc_id", "text", F.xxhash64("text").alias("text_hash")))
    return id_restored(rows.mapInPandas(
        run, f"doc_id {kind}, _no_id boolean, text_hash long, set_key binary, n_shingles int, labels array<long>"))


def shared_nodes(classes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``set_key, n_shingles, tree, prefix, members, lead``: classes at trie nodes with several, written once."""
    depth = prefix_depth(threshold)
    nodes = classes.filter("labels IS NOT NULL").select(
        "set_key", "n_shingles", F.posexplode("labels").alias("tree", "label"),
    ).select(
        "set_key", "n_shingles", "tree",
        F.shiftrightunsigned("label", 8 * (DEPTH - depth)).alias("prefix"))
    return _shared(nodes)


def deep_nodes(classes: DataFrame, sets: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The nodes of the deeper forest, for the classes in ``sets``."""
    trees = trees_for(threshold)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"set_key": batch["set_key"], "deep": [
                deep_labels(np.frombuffer(b, np.uint64), trees) for b in batch["hashes"]]})

    labelled = sets.select("set_key", "hashes").mapInPandas(run, "set_key binary, deep array<long>")
    nodes = labelled.join(classes.select("set_key", "n_shingles"), "set_key").select(
        "set_key", "n_shingles", F.posexplode("deep").alias("place", "prefix"))
    return _shared(nodes.select("set_key", "n_shingles", (F.col("place") + TREES).alias("tree"), "prefix"))


def _shared(nodes: DataFrame) -> DataFrame:
    sizes = nodes.groupBy("tree", "prefix").agg(
        F.count(F.lit(1)).alias("members"), F.min("set_key").alias("lead")).filter("members > 1")
    return cut_lineage(nodes.join(sizes, ["tree", "prefix"]), "nodes")


def wide_groups(nodes: DataFrame, wide: int = WIDE_NODE) -> DataFrame:
    """``set_key, wide``: classes that meet at deep nodes of more than ``wide``, by connected group."""
    edges = nodes.filter((F.col("members") > wide) & (F.col("set_key") != F.col("lead")))
    groups = components(edges.select(F.col("set_key").alias("a"), F.col("lead").alias("b")).distinct())
    return cut_lineage(groups.select(F.col("node").alias("set_key"), F.col("root").alias("wide")), "wide-groups")


def candidate_pairs(nodes: DataFrame, groups: DataFrame, threshold: float = THRESHOLD,
                    wide: int = WIDE_NODE) -> DataFrame:
    """``a, b``: set keys that meet at a node of at most ``wide``; ``a < b``, not both in one wide group.

    A class meets fewer than ``wide`` others in a tree, so the pairs grow with the classes.
    """
    few = nodes.filter(F.col("members") <= wide).join(groups, "set_key", "left").select(
        "set_key", "n_shingles", "tree", "prefix", "wide")
    left = few.withColumnsRenamed({"set_key": "a", "n_shingles": "n_a", "wide": "wide_a"})
    right = few.withColumnsRenamed({"set_key": "b", "n_shingles": "n_b", "wide": "wide_b"})
    close = F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b") - 1e-9
    apart = F.coalesce(F.col("wide_a") != F.col("wide_b"), F.lit(True))
    return left.join(
        right,
        (left["tree"] == right["tree"]) & (left["prefix"] == right["prefix"])
        & (F.col("a") < F.col("b")) & close & apart,
    ).select("a", "b").distinct()


def shingle_sets(docs: DataFrame, classes: DataFrame, needed: DataFrame, words: int = WORDS) -> DataFrame:
    """``set_key, hashes`` of the classes in ``needed``, each once there, from the text of one document each."""
    needed = cut_lineage(needed.join(
        classes.select("set_key", "sample_id", "sample_hash"), "set_key"), "needed")
    ids = needed.select(F.col("sample_id").alias("id"), F.col("sample_hash").alias("hash"), "set_key")
    if needed.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("own_hash")).join(
        ids, (F.col("doc_id") == F.col("id")) & (F.col("own_hash") == F.col("hash")))

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({
                "set_key": batch["set_key"], "hashes": [shingles(t, words).tobytes() for t in batch["text"]]})

    # repeated rows give a class's text more than once
    return cut_lineage(
        texts.select("set_key", "text").mapInPandas(sets, "set_key binary, hashes binary"),
        "shingle-sets").dropDuplicates(["set_key"])


def verified_pairs(pairs: DataFrame, sets: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``a, b`` of the pairs whose whole shingle sets reach the threshold."""

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            true = []
            for x, y in zip(batch["hashes_a"], batch["hashes_b"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                true.append(both / (len(x) + len(y) - both) >= threshold)
            yield batch.loc[np.array(true, dtype=bool), ["a", "b"]]

    first = sets.withColumnsRenamed({"set_key": "a", "hashes": "hashes_a"})
    second = sets.withColumnsRenamed({"set_key": "b", "hashes": "hashes_b"})
    return cut_lineage(
        pairs.join(first, "a").join(second, "b").mapInPandas(verify, "a binary, b binary"), "links")


def overlaps(rows: list[np.ndarray], columns: list[np.ndarray]) -> np.ndarray:
    """How many hashes each of ``rows`` shares with each of ``columns``."""
    both = np.intersect1d(np.concatenate(rows), np.concatenate(columns))
    out = np.zeros((len(rows), len(columns)), dtype=np.float32)
    for low in range(0, len(both), 8192):
        part = both[low:low + 8192]
        marks = []
        for own in (rows, columns):
            marks.append(np.zeros((len(own), len(part)), dtype=np.float32))
            for i, hashes in enumerate(own):
                inside = hashes[np.searchsorted(hashes, part[0]):np.searchsorted(hashes, part[-1], "right")]
                at = np.searchsorted(part, inside)
                marks[-1][i, at[part[at] == inside]] = 1
        out += marks[0] @ marks[1].T
    return out


def wide_links(groups: DataFrame, classes: DataFrame, sets: DataFrame, threshold: float = THRESHOLD,
               block: int = BLOCK) -> DataFrame:
    """``set_key, others, root`` from every two blocks of each wide group.

    All pairs of a group are verified, a pair of blocks of about ``block`` classes at a time, and none
    is written: a row says how many documents a class is linked to there and the smallest class that
    these blocks connect it with.
    """
    sized = groups.groupBy("wide").agg(F.count(F.lit(1)).alias("members")).select(
        "wide", F.ceil(F.col("members") / block).cast("int").alias("blocks"))
    held = groups.join(sized, "wide").join(classes.select("set_key", "copies"), "set_key").withColumn(
        "own", F.pmod(F.xxhash64("set_key"), "blocks").cast("int"))
    dealt = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "wide", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "set_key", "copies")

    def verify(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("set_key")
        hashes = [np.frombuffer(b, np.uint64) for b in frame["hashes"]]
        size, copies = np.array(list(map(len, hashes))), frame["copies"].to_numpy()
        left, right = (np.flatnonzero(frame["own"].to_numpy() == k) for k in key[1:])
        others, root = np.zeros(len(frame), dtype=np.int64), list(range(len(frame)))
        if len(left) and len(right):
            both = overlaps([hashes[i] for i in left], [hashes[i] for i in right])
            linked = both / (size[left][:, None] + size[right][None, :] - both) >= threshold - 1e-7
            linked &= left[:, None] != right[None, :]
            others[left] += linked @ copies[right]
            if key[1] != key[2]:
                others[right] += linked.T @ copies[left]

            def top(i: int) -> int:
                while root[i] != i:
                    root[i] = root[root[i]]
                    i = root[i]
                return i

            for i, j in zip(*np.nonzero(linked)):
                x, y = top(left[i]), top(right[j])
                root[max(x, y)] = min(x, y)
            root = [top(i) for i in range(len(frame))]
        keys = frame["set_key"].tolist()
        return pd.DataFrame({"set_key": keys, "others": others, "root": [keys[i] for i in root]})

    return cut_lineage(
        dealt.join(sets, "set_key").groupBy("wide", "low", "high").applyInPandas(
            verify, "set_key binary, others long, root binary"), "wide-links")


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node in ``links`` (``a, b``); the root is the group's smallest node.

    Large-star and small-star rounds, each written once, until a round changes nothing.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))

    def mark(df: DataFrame):
        row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(row)

    edges = cut_lineage(edges, "edges")
    before = mark(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(lowest, "u").filter(F.col("v") > F.col("u")).select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut_lineage(large, "large-star")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u")
        edges = cut_lineage(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(lowest.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "small-star")
        after = mark(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS,
                    wide: int = WIDE_NODE, block: int = BLOCK) -> DataFrame:
    """``doc_id, class_id, copy_of, n_links`` per row of ``docs``.

    ``class_id`` is the smallest ``doc_id`` of its group of linked documents, ``copy_of`` that of the
    documents with the same shingles, and ``n_links`` how many other documents it is linked to, those
    with the same shingles included.
    """
    signed = cut_lineage(signature_table(docs, words), "signatures")
    named = signed.filter("doc_id IS NOT NULL")
    classes = cut_lineage(named.groupBy("set_key").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("sample"), F.count(F.lit(1)).alias("copies"),
        F.first("n_shingles").alias("n_shingles"), F.first("labels").alias("labels"),
    ).select("set_key", "copies", "n_shingles", "labels", F.col("sample.doc_id").alias("sample_id"),
             F.col("sample.text_hash").alias("sample_hash")), "classes")
    nodes = shared_nodes(classes, threshold)
    crowded = cut_lineage(nodes.filter(F.col("members") > wide).select("set_key").distinct(), "crowded")
    crowded_sets = shingle_sets(docs, classes, crowded, words)
    deep = deep_nodes(classes, crowded_sets, threshold)
    groups = wide_groups(deep, wide)
    pairs = cut_lineage(candidate_pairs(nodes.unionByName(deep), groups, threshold, wide), "pairs")
    others = pairs.select(F.explode(F.array("a", "b")).alias("set_key")).distinct().join(crowded, "set_key", "left_anti")
    sets = crowded_sets.unionByName(shingle_sets(docs, classes, others, words))
    links = verified_pairs(pairs, sets, threshold)
    within = wide_links(groups, classes, sets, threshold, block)
    slim = classes.select("set_key", "sample_id", "copies")
    ends = links.select(F.col("a").alias("set_key"), F.col("b").alias("other")).union(links.select("b", "a"))
    linked = ends.join(
        slim.select(F.col("set_key").alias("other"), F.col("copies").alias("others")), "other",
    ).select("set_key", "others").union(within.select("set_key", "others")).groupBy("set_key").agg(
        F.sum("others").alias("others"))
    edges = links.union(within.filter(F.col("set_key") != F.col("root")).select("set_key", "root"))
    groups = components(edges.distinct()).withColumnRenamed("node", "set_key")
    roots = groups.join(slim, "set_key").groupBy("root").agg(F.min("sample_id").alias("class_id"))
    table = (
        slim.join(linked, "set_key", "left").join(groups, "set_key", "left").join(roots, "root", "left")
        .select("set_key", F.coalesce("class_id", "sample_id").alias("class_id"),
                F.col("sample_id").alias("copy_of"),
                (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    )
    rows = named.select("doc_id", "set_key").join(table, "set_key").select(
        "doc_id", "class_id", "copy_of", "n_links")
    kind = docs.schema["doc_id"].dataType
    unnamed = signed.filter("doc_id IS NULL").select(
        "doc_id", F.lit(None).cast(kind).alias("class_id"), F.lit(None).cast(kind).alias("copy_of"),
        F.lit(0).cast("long").alias("n_links"))
    return rows.unionByName(unnamed)


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS) -> DataFrame:
    """``docs`` with one row of each group: the smallest ``doc_id``, and of its repeated rows one.

    Rows are told apart by ``doc_id`` and text, so of near copies under one ``doc_id`` one stays too, the
    one with the smallest hash. Rows without a ``doc_id`` come last in their groups; those of them without
    a word stay.
    """
    kind = docs.schema["doc_id"].dataType
    text_hash = F.hex(F.xxhash64("text"))
    if isinstance(kind, T.IntegralType):
        # as text that sorts as the numbers do
        low = F.lit(-(2**63)).cast("long")
        own = F.lpad(F.hex(F.col("doc_id").cast("long").bitwiseXOR(low)), 16, "0")
    else:
        own = F.col("doc_id").cast("string")
    named = F.when(F.col("doc_id").isNotNull(), F.concat(F.lit("0"), own, F.lit(":"), text_hash))
    without = F.when(F.col("text").rlike(WORD_PATTERN), F.concat(F.lit("1:"), text_hash))
    key = F.coalesce(named, without)
    groups = near_duplicates(docs.select(key.alias("doc_id"), "text"), threshold, words)
    kept = groups.filter(F.col("doc_id") == F.col("class_id")).select(F.col("doc_id").alias("kept_key")).distinct()
    rows = boxed(docs, key.alias("key"))
    unique = rows.join(kept, F.col("key") == F.col("kept_key"), "left_semi").dropDuplicates(["key"])
    return unboxed(unique.unionByName(rows.filter("key IS NULL")), docs.columns)


def op3_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(documents(spark, folder))
