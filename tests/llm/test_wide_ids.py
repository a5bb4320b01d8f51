"""A NULL ``doc_id`` beside ids that a double cannot hold: every id comes back to the last bit."""

import pytest
from pyspark.sql import functions as F

from lodgegrid.llm.bloom_lm import lm_scores
from lodgegrid.llm.jaccard_forest import keep_one, near_duplicates
from lodgegrid.llm.packing import pack
from lodgegrid.llm.qda import classify, feature_table
from lodgegrid.llm.syncmers import anchor_table, fingerprints

WIDE = 2**60


@pytest.fixture(scope="module")
def wide_docs(make_docs):
    """All in one Arrow batch: two near copies, one other text, and a text without an id."""
    base = [f"w{i}" for i in range(200)]
    rows = [(WIDE + 1, " ".join(base)), (WIDE + 3, " ".join([*base[:-1], "new"])),
            (None, "a text without an id that is long enough for anchors"),
            (WIDE + 5, " ".join(f"x{i}" for i in range(100))), (-WIDE - 7, "short one"), (0, "an id of zero")]
    return make_docs(rows).coalesce(1)


IDS = sorted([WIDE + 1, WIDE + 3, WIDE + 5, -WIDE - 7, 0])


def ids_of(df):
    found = {r.doc_id for r in df.select("doc_id").distinct().collect()}
    assert None in found
    return sorted(found - {None})


@pytest.mark.parametrize("result", [near_duplicates, pack, lm_scores, fingerprints, anchor_table, feature_table])
def test_ids_come_back_whole(wide_docs, result):
    assert ids_of(result(wide_docs)) == IDS


def test_scores_over_a_partitioned_filter(wide_docs):
    assert ids_of(lm_scores(wide_docs, broadcast_bytes=0)) == IDS


def test_near_copies_are_linked_and_one_is_kept(wide_docs):
    found = {r.doc_id: (r.class_id, r.copy_of, r.n_links) for r in near_duplicates(wide_docs).collect()}
    assert found[WIDE + 1] == (WIDE + 1, WIDE + 1, 1) and found[WIDE + 3] == (WIDE + 1, WIDE + 3, 1)
    assert ids_of(keep_one(wide_docs)) == sorted(set(IDS) - {WIDE + 3})


def test_labels_and_folds_follow_the_whole_id(spark, wide_docs):
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(IDS)], "doc_id long, quality int")
    rows = classify(wide_docs, labels).collect()
    held = {r.doc_id: r.held_out for r in wide_docs.filter("doc_id IS NOT NULL").select(
        "doc_id", (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out")).collect()}
    assert {r.doc_id: r.held_out for r in rows} == held | {None: True}


def test_ids_of_text(spark):
    docs = spark.createDataFrame([("a", "one text"), (None, "another"), ("0", "third")], "doc_id string, text string")
    for result in (near_duplicates, pack, lm_scores, feature_table):
        assert ids_of(result(docs)) == ["0", "a"]
