import math
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from lodgegrid.llm import bloom_lm
from lodgegrid.llm.bloom_lm import Filter, build_segment, levels_of, lm_scores, portion_of, word_hashes


def tokens_of(text):
    return (text or "").encode().lower().split() + [None]


def is_held(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 == 2


def check(rows, docs):
    counts = Counter(t for d, text in docs if not is_held(d) for t in tokens_of(text))
    n, v = sum(counts.values()), len(counts)
    expected = []
    for d, text in docs:
        own = tokens_of(text)
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)
        expected.append((d is None, d or 0, is_held(d), len(own), sum(counts[t] > 0 for t in own), n, round(base, 6)))
    found = [(r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows]
    assert sorted(found) == sorted(expected)
    assert all(r.score <= 0 and math.isfinite(r.score) for r in rows)


def test_filter_gives_levels_back():
    rng = np.random.default_rng(1)
    ids, counts = rng.integers(0, 2**63, 5000, dtype=np.uint64), rng.geometric(0.3, 5000)
    blob = build_segment(ids, counts)
    one = Filter(blob, np.array([0, len(blob)]))
    found = one.levels(ids)
    assert (found >= levels_of(counts)).all() and (found == levels_of(counts)).mean() > 0.95
    assert (one.levels(rng.integers(0, 2**63, 5000, dtype=np.uint64)) == 0).mean() > 0.95
    assert levels_of(np.array([1, 2, 3, 5, 100])).tolist() == sorted(levels_of(np.array([1, 2, 3, 5, 100])).tolist())


def test_small_table(small):
    docs = [(r.doc_id, r.text) for r in small.collect()]
    rows = lm_scores(small).collect()
    check(rows, docs)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_filter_in_place_scores_alike(small):
    some = small.filter("doc_id < 60")
    a = {r.doc_id: r.score for r in lm_scores(some).collect()}
    b = {r.doc_id: r.score for r in lm_scores(some, broadcast_bytes=0).collect()}
    assert a.keys() == b.keys() and all(b[k] == pytest.approx(a[k], rel=1e-9) for k in a)


def test_odd_rows(make_docs, odd_rows):
    docs = make_docs(odd_rows, ["row", "token", "held", "info"])
    check(lm_scores(docs).collect(), odd_rows)
    assert lm_scores(make_docs([])).count() == 0
    check(lm_scores(make_docs([(None, "only held out")])).collect(), [(None, "only held out")])


def test_words_are_told_apart_as_split_does():
    texts = [b"Ab cd\x0b\x0cEF\r\n", b"", b"  ", b"ab  x", "\u00e4\u00a0b \u2003c".encode(), b"word" * 3000 + b" end", b"q"]
    texts += [b"a b", b"ab"]  # a text's border parts words without a space
    data = np.frombuffer(b"".join(texts), np.uint8)
    hashes, counts = word_hashes(data, np.cumsum([0, *map(len, texts)]))
    words = [t.lower().split() for t in texts]
    assert counts.tolist() == list(map(len, words))
    flat = [w for own in words for w in own]
    by_word = {w: h for w, h in zip(flat, hashes.tolist())}
    assert [by_word[w] for w in flat] == hashes.tolist() and len(set(by_word.values())) == len(by_word)
    own = portion_of(data, np.cumsum([0, *map(len, texts)]))
    assert own.sizes.tolist() == [len(w) + 1 for w in words] and len(own.tokens) == own.sizes.sum()
    assert word_hashes(data[:0], np.zeros(3, dtype=np.int64))[1].tolist() == [0, 0]


def test_word_hashes_over_many_portions():
    rng = np.random.default_rng(2)
    words = [bytes(rng.integers(97, 123, rng.integers(1, 12), dtype=np.uint8)) for _ in range(300_000)]
    data = np.frombuffer(b" ".join(words), np.uint8)
    hashes, _ = word_hashes(data, np.array([0, len(data)]))
    assert len(set(hashes.tolist())) == len(set(words)) and len(hashes) == len(words)


def plain_model(docs):
    """Scores in plain Python, from the definition: exact counts, put on levels of the powers of 2."""
    weights = (0.0, 0.01, 0.03, 0.06, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
    trained = [tokens_of(text) for d, text in docs if not is_held(d)]
    one = Counter(t for own in trained for t in own)
    two = Counter((h, t) for own in trained for h, t in zip(["start", *own], own))
    n, v = sum(one.values()), len(one)

    def level(count):
        return count.bit_length()

    means = []
    for counts in (one, two):
        by_level = {}
        for c in counts.values():
            by_level.setdefault(level(c), []).append(c)
        means.append({k: sum(c) / len(c) for k, c in by_level.items()} | {0: 0.0})

    def parts(history, token, own):
        word = max(means[0][level(one[token])] - own, 0)
        given = len(trained) if history == "start" else means[0][level(one[history])]
        given, pair = max(given - own, 0), max(means[1][level(two[history, token])] - own, 0)
        return (word + 1) / (n + v + 1), min(pair / given, 1) if given else 0.0

    def key(history):
        return "start" if history == "start" else level(one[history])

    fit = {}
    for own in trained:
        for history, token in zip(["start", *own], own):
            unigram, share = parts(history, token, 1)
            sums = fit.setdefault(key(history), [0.0] * len(weights))
            for i, w in enumerate(weights):
                sums[i] += math.log10((1 - w) * unigram + w * share)
    chosen = {k: weights[max(range(len(weights)), key=lambda i: sums[i])] for k, sums in fit.items()}
    out = []
    for d, text in docs:
        own, score = tokens_of(text), 0.0
        for history, token in zip(["start", *own], own):
            unigram, share = parts(history, token, 0)
            w = chosen.get(key(history), 0.0)
            score += math.log10((1 - w) * unigram + w * share)
        out.append((d, score))
    return out


@pytest.mark.parametrize("broadcast_bytes", [1 << 30, 0])
def test_scores_against_a_plain_model(small, broadcast_bytes):
    some = small.filter("doc_id < 70")
    expected = dict(plain_model([(r.doc_id, r.text) for r in some.collect()]))
    # so many bits that no probe hits by chance
    found = {r.doc_id: r.score for r in lm_scores(some, broadcast_bytes=broadcast_bytes, bits_per_entry=4000).collect()}
    assert found.keys() == expected.keys()
    assert all(found[d] == pytest.approx(expected[d], rel=1e-9) for d in found)


def test_ids_of_any_type_and_size(make_docs):
    rows = [(2**60 + 1, "one two"), (None, "one two"), (2**60 + 3, "three")]
    for broadcast_bytes in (1 << 30, 0):
        found = lm_scores(make_docs(rows), broadcast_bytes=broadcast_bytes).collect()
        assert {r.doc_id for r in found} == {2**60 + 1, None, 2**60 + 3}


def test_portions_are_gathered_for_the_segments(make_docs, monkeypatch):
    monkeypatch.setattr(bloom_lm, "PORTION_BYTES", 200)
    rows = [(i, " ".join(f"w{(i * 7 + j) % 40}" for j in range(60))) for i in range(60)]
    batches = [make_docs(rows).coalesce(1).select("doc_id", "text").toArrow().to_batches()[0]]
    small = [own for batch in batches for _, own in bloom_lm.portions(batch)]
    found = list(bloom_lm.gathered(iter(batches)))
    assert len(small) > 20 and len(found) == 1
    assert found[0][0] == {"doc_id": list(range(60))}
    assert found[0][1].tokens.tolist() == np.concatenate([p.tokens for p in small]).tolist()
    monkeypatch.setattr(bloom_lm, "GATHERED_TOKENS", 200)
    parts = list(bloom_lm.gathered(iter(batches)))
    assert len(parts) > 5 and sum((ids["doc_id"] for ids, _ in parts), []) == list(range(60))
    assert all(len(own.tokens) <= 200 or len(own.sizes) <= 4 for _, own in parts)


def test_a_segment_is_probed_once_for_all_portions(monkeypatch):
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    blob = build_segment(ids, rng.geometric(0.3, 3000)).tobytes()
    one = Filter(np.frombuffer(blob, np.uint64), np.array([0, len(blob) // 8]))
    portions = [ids[a : a + 30] for a in range(0, 3000, 25)] + [rng.integers(0, 2**63, 40, dtype=np.uint64), ids[:0]]
    expected = [one.levels(p).astype(np.uint8).tobytes() for p in portions]
    calls, plain = [], Filter.levels
    monkeypatch.setattr(Filter, "levels", lambda self, asked: calls.append(len(asked)) or plain(self, asked))
    assert bloom_lm.answers_of(blob, pd.Series([p.tobytes() for p in portions])) == expected
    assert calls == [sum(map(len, portions))]
