import zlib

import numpy as np

from lodgegrid.llm.qda import FEATURES, classify, features, fit, keep_good

from .conftest import FOLDER


def test_sums_give_the_plain_discriminant(spark, small):
    """Scores equal those of a direct fit on all rows at once."""
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    known = {r.doc_id: r.quality for r in labels.collect()}
    docs = [(r.doc_id, r.text) for r in small.collect()]
    held = {d: zlib.crc32(str(d).encode()) % 5 == 0 for d, _ in docs}
    x = {d: np.array(features(t)) for d, t in docs}
    own = {k: np.array([x[d] for d, _ in docs if not held[d] and known.get(d) == k]) for k in (0, 1)}
    model = fit({k: (len(v), v.sum(axis=0), v.T @ v) for k, v in own.items()})
    rows = classify(small, labels).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.held_out == held[r.doc_id] and abs(r.score - model.score(x[r.doc_id][None])[0]) < 1e-6
        assert r.predicted == int(r.score >= 0.3)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    quality = {r.doc_id: r.quality for r in labels.collect()}
    rows = [r for r in classify(docs, labels).collect() if r.held_out and r.doc_id in quality]
    assert np.mean([r.predicted == quality[r.doc_id] for r in rows]) > 0.97
    assert all(r.predicted == 1 for r in rows if quality[r.doc_id] == 1)


def test_odd_rows(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows, ["x", "label", "quality", "held_out"])
    labels = spark.createDataFrame(
        [(1, 1), (5, 0), (6, 1), (7, None), (7, 1), (7, 0), (None, 1), (8, 2)], "doc_id long, quality int")
    rows = classify(docs, labels).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out for r in rows if r.doc_id is None)
    assert keep_good(docs, labels).columns == docs.columns
    one_class = classify(docs, labels.filter("quality = 1")).collect()
    assert len({r.score for r in one_class}) == 1 and one_class[0].score > 0.5
    assert classify(make_docs([]), labels).count() == 0
    assert {r.score for r in classify(docs, labels.limit(0)).collect()} == {0.5}
    assert len(FEATURES) == len(features(None)) == len(features("x y"))
