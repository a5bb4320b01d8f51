"""The stages on the smallest tables, each against what plain Python makes of its input."""

import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from lodgegrid.session import cut_lineage

from .conftest import FOLDER
from .test_jaccard_forest import brute_force


@pytest.fixture(scope="module")
def steps(spark):
    """Rows before and after every stage."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(cut_lineage(stage(spark, out[-1], FOLDER), "step"))
    return out


def test_stages_return_the_columns_of_documents(steps):
    for df in steps[1:-1]:
        assert df.columns == steps[0].columns


def test_quality_rejects_what_is_labelled_bad(spark, steps):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r.doc_id for r in steps[1].collect()}
    assert [d for d, q in labels.items() if q == 0 and d in kept] == []
    assert [d for d, q in labels.items() if q == 1 and d not in kept] == []


def line_key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def test_lines_stay_in_the_smallest_document(steps):
    before = {r.doc_id: r.text.split("\n") for r in steps[1].collect()}
    first = {}
    for d in sorted(before):
        for line in before[d]:
            first.setdefault(line_key(line), d)
    expected = {d: "\n".join(x for x in own if len(line_key(x)) < 10 or first[line_key(x)] == d) for d, own in before.items()}
    after = {r.doc_id: (r.text, r.n_chars) for r in steps[2].collect()}
    assert after == {d: (t, len(t)) for d, t in expected.items()}


def test_one_of_each_group_stays(steps):
    rows = [(r.doc_id, r.text) for r in steps[2].collect()]
    expected = sorted(d for d, group, _ in brute_force(rows) if d == group)
    assert sorted(r.doc_id for r in steps[3].collect()) == expected


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def test_mixture_takes_words_of_its_input_at_most_twice(steps):
    before = {r.doc_id: r for r in steps[3].collect()}
    taken, sources = defaultdict(int), Counter()
    for r in steps[4].collect():
        assert r.text in before[r.doc_id].text and r.source == before[r.doc_id].source
        taken[r.doc_id] += len(words(r.text))
    for d, r in before.items():
        n = len(words(r.text))
        assert taken[d] <= 2 * n
        sources[r.source] += n
    assert sum(taken.values()) == pytest.approx(1.5 * sum(sources.values()), abs=len(sources))


def test_packing_covers_the_mixture(steps):
    mixed, pieces = steps[4].collect(), steps[5].collect()
    assert sum(p.start == 0 for p in pieces) == len(mixed)
    used = defaultdict(int)
    for p in pieces:
        used[p.sequence_id] += p.length
    assert max(used.values()) <= 2048
    assert sum(used.values()) == sum(p.doc_tokens for p in pieces if p.start == 0)


def test_run_gives_the_same_number_of_pieces(spark, steps):
    assert corpus_pipeline.run(spark, FOLDER).count() == steps[5].count()


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = cut_lineage(stage(spark, docs, FOLDER), "empty")
    assert docs.count() == 0


def test_odd_rows_and_extra_columns(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows * 2, ["size", "part", "kept", "doc", "score"])
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, cut_lineage(stage(spark, docs, FOLDER), "odd")
        if i < 4:
            assert docs.columns == before.columns
    assert docs.count() > 0
