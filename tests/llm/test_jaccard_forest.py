from collections import Counter, defaultdict

from lodgegrid.llm.jaccard_forest import components, keep_one, near_duplicates, prefix_depth


def sets_of(text):
    words = (text or "").encode().split()
    n = min(5, len(words))
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) if n else frozenset()


def brute_force(rows):
    """Links per row and group per row, from all pairs."""
    sets = [sets_of(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = Counter()
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a == b or (a and b and len(a & b) >= 0.8 * len(a | b)):
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    smallest = defaultdict(lambda: float("inf"))
    for i, (doc_id, _) in enumerate(rows):
        smallest[root(i)] = min(smallest[root(i)], doc_id)
    return sorted((d, smallest[root(i)], links[i]) for i, (d, _) in enumerate(rows))


def copies(n_groups, size):
    rows, word = [], 0
    for g in range(n_groups):
        base = [f"g{g}w{i}" for i in range(120 + g)]
        for k in range(size):
            own = list(base)
            for _ in range(k % 5):
                own[(word * 37) % len(own)] = f"new{word}"
                word += 1
            rows.append((len(rows) + 10, " ".join(own)))
    return rows


def result(df):
    return sorted((r.doc_id, r.class_id, r.n_links) for r in df.collect())


def test_groups_and_links_equal_brute_force(make_docs):
    rows = copies(8, 9) + [(1, "a b c d"), (2, "a b c d"), (3, "a b c"), (4, ""), (5, None), (6, " \n"), (7, "x")]
    docs = make_docs(rows, ["set_key", "labels", "a"])
    assert result(near_duplicates(docs)) == brute_force(rows)
    # the same when nearly all nodes are wide and groups take several blocks
    assert result(near_duplicates(docs, wide=2, block=4)) == brute_force(rows)


def test_small_table_equals_brute_force(small):
    rows = [(r.doc_id, r.text) for r in small.collect()]
    assert result(near_duplicates(small)) == brute_force(rows)


def test_prefix_is_shortened_to_the_recall():
    depth = prefix_depth(0.8)
    assert 1 - (1 - 0.8 ** depth) ** 32 >= 0.9999 > 1 - (1 - 0.8 ** (depth + 1)) ** 32
    assert prefix_depth(0.99) == 8


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (102, 101), (200, 300)]
    df = spark.createDataFrame(edges, "a long, b long")
    found = {(r.node, r.root) for r in components(df).collect()}
    assert found == {(i, 0) for i in range(41)} | {(i, 100) for i in (100, 101, 102)} | {(200, 200), (300, 200)}
    assert components(df.limit(0)).count() == 0


def test_one_of_each_group_stays(make_docs, odd_rows):
    docs = make_docs(odd_rows, ["set_key", "_kept", "class_id"])
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in kept.collect())
    assert [i[1] for i in ids] == [1, 2, 5, 5, 6, 7, 8, 0, 0]
    found = near_duplicates(docs).collect()
    assert len(found) == len(odd_rows)
    assert [(r.class_id, r.n_links) for r in found if r.doc_id is None] == [(None, 0)] * 2
    assert {(r.class_id, r.n_links) for r in found if r.doc_id in (1, 9)} == {(1, 1)}
    assert near_duplicates(make_docs([])).count() == 0 and keep_one(make_docs([])).count() == 0
