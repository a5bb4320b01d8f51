import hashlib
import random
import zlib

import pytest

from lodgegrid.llm.run_detection import (
    collapsed, op11_periodic_runs, periodic_runs, planted, runs_in, runs_of, suffix_automaton, window_words)

from .conftest import FOLDER


def brute(words, min_length=6, min_exponent=4):
    n, found = len(words), []
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(min_length, min_exponent * q):
                own = words[i : i + size]
                if not any(own[d:] == own[:-d] for d in range(1, q)):
                    found.append((i, size, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def random_words(rng):
    n, letters = rng.randint(0, 70), rng.choice([1, 2, 3, 5, 20])
    words = [bytes([97 + rng.randrange(letters)]) for _ in range(n)]
    if n and rng.random() < 0.5:
        a, p = rng.randrange(n), 1 + rng.randrange(9)
        part = (words[a : a + p] * n)[: n - a]
        words = words[:a] + part
    return words


@pytest.mark.parametrize("limits", [(6, 4), (2, 2), (6, 2), (4, 3), (9, 5)])
def test_against_brute_force(limits):
    rng = random.Random(11)
    for _ in range(700):
        words = random_words(rng)
        expected = brute(words, *limits)
        assert runs_of(words, *limits) == runs_in(words, *limits) == expected


def test_window_comes_again_inside_every_run():
    assert window_words(6, 4) == 5 and window_words(2, 2) == 1


def test_suffix_automaton_knows_all_substrings():
    words = list("abcbcbcabca")
    link, length, ends = suffix_automaton(words)
    # a state stands for the substrings longer than its link's and as long as itself
    distinct = {tuple(words[i:j]) for i in range(len(words)) for j in range(i + 1, len(words) + 1)}
    assert sum(length[s] - length[link[s]] for s in range(2, len(link))) == len(distinct)
    assert [length[s] for s in ends] == list(range(1, len(words) + 1))


def expected_row(doc_id, text):
    words = (text or "").encode().split()
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute(words)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    lines = "".join(f"{s},{size},{q}\n" for s, size, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_against_brute_force(spark, make_docs, odd_rows, tmp_path):
    rng = random.Random(5)
    docs = [(i, " ".join(w.decode() for w in random_words(rng))) for i in range(300)]
    docs += [(1000 + i, " ".join(f"w{rng.randrange(40)}" for _ in range(300))) for i in range(60)]
    docs += [r for r in odd_rows if r[1] is None or len(r[1]) < 1000]
    make_docs(docs, ["number", "runs", "best"]).write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted((tuple(r) for r in op11_periodic_runs(spark, str(tmp_path)).collect()), key=repr)
    assert found == sorted((expected_row(*d) for d in docs), key=repr)
    assert sum(r[1] > 0 for r in found) > 100


def test_whole_table(spark, small):
    short = [(r.doc_id, r.text) for r in small.collect() if len(r.text or "") < 3000]
    found = {r.doc_id: tuple(r) for r in op11_periodic_runs(spark, FOLDER).collect()}
    assert len(found) == small.count()
    assert [found[d] for d, _ in short] == [expected_row(d, t) for d, t in short]


def test_long_texts_and_empty_table(spark, make_docs, odd_rows):
    words = "a b c d e f g".split() * 6000
    rows = [*odd_rows, (77, " ".join(["x", *words, "y"]))]
    found = {(r.doc_id, r.n_words): r for r in periodic_runs(make_docs(rows, ["runs"])).collect()}
    assert periodic_runs(make_docs(rows)).count() == len(rows)
    own = found[77, 42_002]
    assert [tuple(r) for r in own.runs] == [(1, 42_000, 7)] and own.collapsed == "x a b c d e f g y"
    assert found[5, 40_000].runs == [] and found[None, 0].collapsed == ""
    assert periodic_runs(make_docs([])).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(make_docs([]), min_exponent=1)


def test_edits():
    words = [b"%d" % i for i in range(10)]
    assert planted(words, -1) == planted(words, 11) == words and planted([], 10) == []
    assert planted(words, 10 * 12) == words[:2] + (words[2:3 + 8 // 7] * 8)[:8]
    assert collapsed([b"a"] * 6 + [b"b"], [(0, 6, 1)]) == [b"a", b"b"]
