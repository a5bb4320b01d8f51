import hashlib

import numpy as np
import pytest

from lodgegrid.llm.syncmers import K, S, _rolled, anchor_table, anchors, decoded, encoded, fingerprints, likeness, matched, sketch

from .conftest import FOLDER


def brute_anchors(text):
    codes = np.array([ord(c) for c in text], dtype=np.uint64)
    inner = _rolled(codes, S)
    out = []
    for i in range(len(text) - K + 1):
        own = inner[i:i + K - S + 1]
        if own.min() in (own[0], own[-1]):
            out.append(i)
    return out


def test_anchors_are_closed_syncmers():
    text = "Die grüne Wiese ✓ liegt hinter dem Haus und die Kühe stehen darauf herum." * 3
    places, hashes = anchors(text)
    assert places.tolist() == brute_anchors(text)
    by_text = {}
    for p, h in zip(places.tolist(), hashes.tolist()):
        assert by_text.setdefault(text[p:p + K], h) == h


def test_anchors_do_not_depend_on_the_context_or_on_chunks(monkeypatch):
    import lodgegrid.llm.syncmers as module

    text = "".join(chr(97 + (i * i * 7 + i // 3) % 26) for i in range(3000))
    places, hashes = anchors(text)
    shifted, same = anchors("xyz" + text)
    assert [p + 3 for p in places] == [p for p in shifted.tolist() if p >= 3]
    monkeypatch.setattr(module, "CHUNK", 64)
    again, equal = module.anchors(text)
    assert again.tolist() == places.tolist() and equal.tolist() == hashes.tolist()


def test_likeness_is_the_overlap_of_short_texts_and_near_it_for_long():
    assert likeness(sketch(""), sketch("")) == 1.0 and likeness(sketch(""), sketch("a")) == 0.0
    assert likeness(sketch("abc"), sketch("abc")) == 1.0 and likeness(sketch("abc"), sketch("abd")) == 0.0
    rng = np.random.default_rng(2)
    text = "".join(chr(c) for c in rng.integers(97, 123, 60_000))
    other = "".join(chr(c) for c in rng.integers(97, 123, 20_000))
    assert likeness(sketch(text), sketch(text[:40_000] + other)) == pytest.approx(0.5, abs=0.13)
    assert likeness(sketch(text), sketch(other)) == 0.0


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for i, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        n = len(text) // 4
        edited = text[:len(text) - n] + following[:n]
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(),
                    round(likeness(sketch(text), sketch(edited)), 9), round(likeness(sketch(text), sketch(following)), 9)))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in df.collect()), key=repr)


@pytest.mark.parametrize("ranges", [1, 7])
def test_every_document_meets_its_next(small, ranges):
    rows = [(r.doc_id, r.text) for r in small.collect()]
    df = fingerprints(small, ranges)
    assert found(df) == expected(rows)
    prints = {}
    for r in df.collect():
        text = dict(rows)[r.doc_id]
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
    near = [r.near_edited for r in df.collect() if r.n_chars > 200]
    assert 0.5 < np.mean(near) < 0.75


def test_odd_rows(make_docs, odd_rows):
    docs = make_docs(odd_rows, ["place", "edge", "number"])
    assert found(fingerprints(docs, 3)) == expected(odd_rows)
    assert fingerprints(make_docs([]), 3).count() == 0
    assert found(fingerprints(make_docs([(5, "only one document here")]), 3)) == expected([(5, "only one document here")])
    assert anchor_table(docs).filter("doc_id = 8").count() == 1


def random_words(rng, n):
    return [f"w{i}" for i in rng.integers(0, 50_000, n)]


def set_overlap(x, y):
    """Overlap of all anchors, found k-mer by k-mer."""
    own, other = ({t[i:i + K] for i in brute_anchors(t)} for t in (x, y))
    return len(own & other) / len(own | other)


def test_likeness_is_near_the_overlap_of_all_anchors():
    rng = np.random.default_rng(5)
    errors = []
    for n in (60, 150, 400, 1200, 3000):
        for part in (0.2, 0.5, 0.75, 0.9):
            words = random_words(rng, n)
            cut = int(n * part)
            x, y = " ".join(words), " ".join(words[:cut] + random_words(rng, n - cut))
            errors.append(abs(likeness(sketch(x), sketch(y)) - set_overlap(x, y)))
            if n <= 150:
                assert errors[-1] < 0.011
    assert max(errors) < 0.1 and np.mean(errors) < 0.03


def test_a_passage_in_long_texts_is_found_by_its_place():
    rng = np.random.default_rng(6)
    passage = random_words(rng, 50)
    x = " ".join(random_words(rng, 9_000) + passage + random_words(rng, 11_000))
    y = " ".join(random_words(rng, 2_000) + passage + random_words(rng, 18_000))
    near, common = matched(sketch(x), sketch(y))
    assert 0 < near < 0.01 and 150 < common <= len(" ".join(passage))


def test_scattered_pieces_are_no_passage():
    rng = np.random.default_rng(7)
    pieces = [" ".join(random_words(rng, 5)) for _ in range(40)]
    x, y = "", ""
    for i, j in zip(range(40), rng.permutation(40)):
        x += pieces[i] + " " + " ".join(random_words(rng, 60)) + " "
        y += pieces[j] + " " + " ".join(random_words(rng, 60)) + " "
    assert set_overlap(x, y) > 0.02
    # pieces of under two kept anchors have no neighbour to agree with
    assert likeness(sketch(x), sketch(y)) < set_overlap(x, y)
    assert likeness(sketch(x), sketch("# " + x)) > 0.99


def test_fingerprints_come_back_from_text():
    rng = np.random.default_rng(8)
    for text in ("", "abc", "a" * 5000, " ".join(random_words(rng, 2000)), "x" * 3000 + " ".join(random_words(rng, 20))):
        own, back = sketch(text), decoded(encoded(sketch(text)))
        assert own.level == back.level and np.array_equal(own.hashes, back.hashes)
        assert np.array_equal(own.places, back.places) and likeness(own, back) == 1.0


def test_common_stretches_of_the_query(make_docs):
    rng = np.random.default_rng(9)
    text = " ".join(random_words(rng, 400))
    first, second = fingerprints(make_docs([(1, text), (2, text)]), 2).orderBy("doc_id").collect()
    assert first.near_next == second.near_next == 1.0 and first.fingerprint == second.fingerprint
    assert len(text) - 60 < first.common_next <= len(text)
    assert 0.6 * len(text) < first.common_edited < 0.8 * len(text)
