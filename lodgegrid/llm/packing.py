"""Packing token pieces into fixed-length sequences by first-fit decreasing.

Every document is cut into pieces of at most one sequence. The pieces are dealt at random into groups
of about ``group_size``, and each group is packed on its own: pieces by falling length, each into the
first sequence with room, which a tournament tree over the sequences' free room finds in logarithmic
time. Only the pieces' numbers move, never their ids, and a group's size does not grow with the input.

The pieces are written once, so that their count is known before they are dealt and no text is
encoded twice.

Cases
-----
* NULL and empty texts are the end id alone, one piece of length 1.
* A NULL ``doc_id`` is kept. Rows that share a ``doc_id`` are packed one by one.
* Repeated rows go to different groups, since the row number is part of the dealing key; the same
  files read in the same splits are packed the same way.
* Pieces of equal length are taken by ``doc_id`` and ``start``.
* An empty table gives no rows. Columns beyond ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from lodgegrid.session import cut_lineage

from .common import documents, id_carried, id_restored, small_batches
from .tokens import VOCABULARY, encoder

SEQUENCE = 2048
GROUP_SIZE = 4096
SEED = 20


class FreeRoom:
    """A tournament tree: leaves are the free room of sequences, inner nodes the larger child."""

    def __init__(self, sequences: int, capacity: int):
        self.size = 1 << max(0, (max(sequences, 1) - 1).bit_length())
        self.tree = [capacity] * (2 * self.size)

    def place(self, length: int) -> tuple[int, int]:
        """The first sequence with room for ``length`` and its free room before."""
        tree, node = self.tree, 1
        while node < self.size:
            node *= 2
            if tree[node] < length:
                node += 1
        room = tree[node]
        tree[node] = room - length
        found = node - self.size
        node //= 2
        while node:
            left, right = tree[2 * node], tree[2 * node + 1]
            top = left if left > right else right
            if tree[node] == top:
                break
            tree[node] = top
            node //= 2
        return found, room


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """``(sequence, offset)`` of every piece; ``lengths`` fall and are at most ``capacity``."""
    room = FreeRoom(len(lengths), capacity)
    placed = []
    for length in lengths:
        sequence, free = room.place(length)
        placed.append((sequence, capacity - free))
    return placed


def piece_table(docs: DataFrame, sequence: int = SEQUENCE, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` of every piece of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = encoder(vocabulary)
        for batch in batches:
            out = []
            for doc_id, no_id, text in zip(batch["doc_id"], batch["_no_id"], batch["text"]):
                ids = tokens.closed_ids(text)
                for start in range(0, len(ids), sequence):
                    piece = ids[start:start + sequence]
                    out.append((doc_id, no_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
            yield pd.DataFrame(out, columns=["doc_id", "_no_id", "start", "length", "ids_crc32", "doc_tokens"])

    return id_restored(id_carried(small_batches(docs).select("doc_id", "text")).mapInPandas(
        run, f"doc_id {kind}, _no_id boolean, start long, length long, ids_crc32 long, doc_tokens long"))


def pack(docs: DataFrame, sequence: int = SEQUENCE, group_size: int = GROUP_SIZE, seed: int = SEED,
         vocabulary: str = VOCABULARY) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; ``padding`` is that of the piece's sequence.

    A sequence is padded to ``sequence`` ids unless its own length is a power of two.
    """
    pieces = piece_table(docs, sequence, vocabulary)
    dealt = cut_lineage(pieces.withColumn(
        "_key", F.xxhash64(F.lit(seed), "doc_id", "start", "ids_crc32", F.monotonically_increasing_id())),
        "pieces")
    groups = max(1, math.ceil(dealt.count() / group_size))

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(
            ["length", "_no_id", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True, True],
            kind="stable")
        placed = first_fit_decreasing(group["length"].tolist(), sequence)
        number = np.array([s for s, _ in placed], dtype="int64")
        filled = np.bincount(number, weights=group["length"]).astype("int64")
        spare = np.where(filled & (filled - 1) == 0, 0, sequence - filled)
        return group.drop(columns=["_key", "_group"]).assign(
            sequence_id=(int(key[0]) << 32) + number,
            offset=np.array([o for _, o in placed], dtype="int64"), padding=spare[number])

    kind = docs.schema["doc_id"].dataType.simpleString()
    grouped = id_carried(dealt.withColumn("_group", F.pmod("_key", F.lit(groups)))).groupBy("_group")
    return id_restored(grouped.applyInPandas(
        run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, _no_id boolean, "
             "sequence_id long, offset long, padding long"))


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(documents(spark, folder))
