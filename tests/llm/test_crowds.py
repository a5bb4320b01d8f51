"""Crowded nodes, copies without ids, large draws: what grows with a hot group."""

import math
import random

import numpy as np
import pytest

from lodgegrid.llm import jaccard_forest as forest
from lodgegrid.llm.mixing import hypergeometric, mix, mixed_texts, shard_counts

from .test_jaccard_forest import brute_force, result


def test_texts_that_share_boilerplate_form_no_group(spark, make_docs):
    rng = random.Random(3)
    shared = [f"s{i}" for i in range(60)]
    # 60 shared words and 36 own ones: a Jaccard of about 0.4 to each other, and no link
    rows = [(i, " ".join(shared + [f"d{i}w{rng.randrange(10**6)}" for _ in range(36)])) for i in range(1200)]
    docs = make_docs(rows)
    signed = forest.signature_table(docs)
    classes = signed.select(
        "set_key", "n_shingles", "labels", forest.F.lit(1).alias("copies"), forest.F.col("doc_id").alias("sample_id"),
        forest.F.col("text_hash").alias("sample_hash"))
    nodes = forest.shared_nodes(classes)
    crowded = nodes.filter("members > 32").select("set_key").distinct()
    assert crowded.count() > 300
    deep = forest.deep_nodes(classes, forest.shingle_sets(docs, classes, crowded))
    assert forest.wide_groups(deep).count() == 0
    assert deep.count() < 2000
    found = forest.near_duplicates(docs).collect()
    assert all(r.n_links == 0 and r.class_id == r.doc_id for r in found) and len(found) == 1200


def test_many_near_copies_keep_all_their_links(make_docs):
    rng = random.Random(8)
    rows = []
    for i in range(150):
        words = [f"w{j}" for j in range(150)]
        for _ in range(rng.choice([0, 1, 2, 3, 4])):
            words[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    assert result(forest.near_duplicates(make_docs(rows))) == brute_force(rows)


def test_the_deeper_forest_keeps_the_recall():
    trees = forest.trees_for(0.8)
    assert 1 - (1 - 0.8 ** forest.DEEP_DEPTH) ** trees >= 0.9999 > 1 - (1 - 0.8 ** forest.DEEP_DEPTH) ** (trees - 1)
    # measured on sets of a Jaccard of 0.8
    rng, met = np.random.default_rng(1), 0
    for _ in range(60):
        both, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (160, 20, 20))
        one, two = (forest.deep_labels(np.concatenate([both, own]), trees) for own in (a, b))
        met += (one == two).any()
    assert met == 60


def test_copies_without_ids_leave_one_row(make_docs):
    text = "one text of several words that stands in very many rows without any id at all"
    near = text.replace("several", "a few") + " " + " ".join(f"more{i}" for i in range(60))
    copy = near + " end"
    rows = [(None, text)] * 50 + [(1, text)] + [(2, near), (2, copy)] + [(None, "another one of them")] * 3 + [(None, None)] * 2
    kept = sorted(((r.doc_id, r.text) for r in forest.keep_one(make_docs(rows, ["key", "kept_key"])).collect()), key=repr)
    assert [k for k in kept if k[1] == text] == [(1, text)]
    assert sum(k[0] == 2 for k in kept) == 1  # near copies under one id
    assert kept.count((None, "another one of them")) == 1 and kept.count((None, None)) == 2
    wide = [(2**60 + 1, text), (-5, text), (2**60, text)]
    assert [r.doc_id for r in forest.keep_one(make_docs(wide)).collect()] == [-5]


@pytest.mark.parametrize("good, bad, draws", [(5, 7, 6), (40, 3, 20), (1, 1, 1), (300, 500, 100), (0, 4, 2), (9, 0, 4)])
def test_hypergeometric_against_its_probabilities(good, bad, draws):
    exact = [math.comb(good, k) * math.comb(bad, draws - k) / math.comb(good + bad, draws) for k in range(draws + 1)]
    grid = (np.arange(20_000) + 0.5) / 20_000
    found = np.bincount([hypergeometric(good, bad, draws, u) for u in grid.tolist()], minlength=draws + 1) / len(grid)
    assert np.abs(found - np.array(exact)).max() < 2e-4


def test_hypergeometric_of_very_many():
    good, bad, draws = 3 * 10**11, 10**12, 5 * 10**11
    drawn = np.array([hypergeometric(good, bad, draws, u) for u in np.random.default_rng(2).random(60).tolist()], dtype=float)
    p = good / (good + bad)
    spread = math.sqrt(draws * p * (1 - p) * (1 - draws / (good + bad)))
    z = (drawn - draws * p) / spread
    assert abs(z.mean()) < 0.5 and 0.7 < z.std() < 1.3


def test_shards_of_very_many_slots_add_up():
    slots = np.array([4 * 10**9, 2 * 10**9, 12345], dtype=np.int64)
    shards = math.ceil(int(slots.sum()) / 4096)
    at = shards // 3
    own, before = shard_counts(at, shards, slots, 4096, 7)
    following, upto = shard_counts(at + 1, shards, slots, 4096, 7)
    assert own.sum() == 4096 and (before + own == upto).all() and before.sum() == at * 4096
    assert (np.abs(own / 4096 - slots / slots.sum()) < 0.05).all() and following.sum() == 4096


def test_very_many_equal_rows_are_mixed(spark, make_docs):
    rows = [(1, "a b c d e", "s")] * 20_000 + [(2, "f g h", "t")]
    docs = make_docs(rows)
    spans, _ = mix(docs, block=64)
    texts = mixed_texts(docs, spans)
    words = sum(len(r.text.split()) for r in texts.select("text").collect())
    assert words == spans.agg({"n_words": "sum"}).first()[0]
