import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from lodgegrid.llm.packing import first_fit_decreasing, pack
from lodgegrid.llm.tokens import TextEncoder


def reference_ids(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_ids_equal_the_tokenizer(small, odd_rows):
    texts = [r.text for r in small.select("text").collect()] + [t for _, t in odd_rows if t]
    texts += ["<|endoftext|> a", " lead", "trail ", "a  b", "it's 'tis 's", "a\n b", "a \nb", "x  y", "1 22  333",
              "\x1c a", "a\u0085 b", "é è 中文 字", "tab\t x", "...! ?", " ", "  ", "a" * 300 + " " + "b" * 30]
    encoder = TextEncoder()
    assert [encoder.ids(t).tolist() for t in texts] == reference_ids(texts)


def brute_first_fit(lengths, capacity):
    free, placed = [], []
    for n in lengths:
        at = next((i for i, f in enumerate(free) if f >= n), None)
        if at is None:
            at = len(free)
            free.append(capacity)
        placed.append((at, capacity - free[at]))
        free[at] -= n
    return placed


def test_tree_finds_the_first_sequence_with_room():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 7, 300):
        lengths = sorted(rng.integers(1, 101, n).tolist(), reverse=True)
        assert first_fit_decreasing(lengths, 100) == brute_first_fit(lengths, 100)


def check_packing(rows, texts, sequence):
    ids_of = dict(zip(texts, reference_ids([t or "" for t in texts])))
    used, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        used[r.sequence_id].append((r.offset, r.length))
        pieces[(r.doc_id, r.doc_tokens)].append(r)
    for spans in used.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end and length > 0
            end += length
        assert end <= sequence
    return ids_of, used, pieces


def test_small_table_is_packed_whole(small):
    docs = {r.doc_id: r.text for r in small.collect()}
    rows = pack(small).collect()
    ids_of, used, _ = check_packing(rows, list(docs.values()), 2048)
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    assert by_doc.keys() == docs.keys()
    for doc_id, own in by_doc.items():
        ids, end = np.array(ids_of[docs[doc_id]] + [1], dtype="<u4"), 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == end and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
            end += r.length
        assert end == len(ids)
    filled = sum(n for spans in used.values() for _, n in spans)
    assert len(used) * 2048 <= 1.02 * filled + 2048


def test_odd_rows(make_docs, odd_rows):
    rows = pack(make_docs(odd_rows, ["sequence_id", "offset", "_key", "length"]), sequence=64, group_size=16).collect()
    check_packing(rows, [t for _, t in odd_rows], 64)
    assert sum(r.start == 0 for r in rows) == len(odd_rows)
    assert [(r.length, r.doc_tokens) for r in rows if r.doc_id in (2, 3)] == [(1, 1), (1, 1)]
    assert pack(make_docs([])).count() == 0
