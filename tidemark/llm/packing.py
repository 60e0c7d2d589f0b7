"""Best-fit-decreasing packing of token ids into rows of one length.

Each task packs blocks of its own documents: pieces go longest first into the fullest
row that still has room, found by a search tree over the remaining capacities. A document
longer than a row is cut; its pieces keep their document, offset and order, so every
document can be put together again. A row holds ids (padded at its end), the cumulative
lengths of its pieces and positions that start at 0 in each piece.

A null or empty text takes part with no tokens: it is listed in no row. Rows with equal or
null ids are documents of their own. An empty table gives no rows. Other columns of the
input are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.arrow import chunks, documents, row_ids
from tidemark.llm.bpe import read_ranks

ROW_TOKENS = 2048
# Tokens that a task gathers before it packs them: bounds its memory, not the input.
BLOCK_TOKENS = 4_000_000

SCHEMA = ("pack_id long, n_tokens long, ids binary, lengths array<int>, positions binary, "
          "doc_ids array<long>, doc_rows array<long>, doc_offsets array<int>")
FIELDS = pa.schema([
    ("pack_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("lengths", pa.list_(pa.int32())),
    ("positions", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("doc_rows", pa.list_(pa.int64())),
    ("doc_offsets", pa.list_(pa.int32()))])


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})


class Capacities:
    """How many open rows have each remaining capacity, as a segment tree over 1..size."""

    def __init__(self, size: int):
        self.leaves = 1
        while self.leaves <= size:
            self.leaves *= 2
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        self._change(capacity, 1)

    def _change(self, capacity: int, by: int) -> None:
        i = capacity + self.leaves
        while i:
            self.count[i] += by
            i //= 2

    def take(self, need: int) -> tuple[int, int] | None:
        """The row with the least capacity of at least ``need``; it leaves the tree."""
        i = need + self.leaves
        if not self.count[i]:
            while i > 1 and (i % 2 or not self.count[i + 1]):
                i //= 2
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        capacity = i - self.leaves
        self._change(capacity, -1)
        return capacity, self.rows[capacity].pop()


def best_fit(sizes: list[int], length: int) -> list[list[int]]:
    """Indices of ``sizes`` by row; the longest first, ties in their order."""
    tree, packs = Capacities(length), []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = tree.take(sizes[i])
        if found is None:
            found = length, len(packs)
            packs.append([])
        capacity, row = found
        packs[row].append(i)
        if capacity > sizes[i]:
            tree.add(capacity - sizes[i], row)
    return packs


def pack(docs: DataFrame, path: str, pattern: str, length: int = ROW_TOKENS, pad: int = 0) -> DataFrame:
    """Packed rows. ``ids`` and ``positions`` are little-endian unsigned 32-bit integers,
    ``lengths`` runs from 0 to the end of the last piece; ``doc_rows`` tells documents with
    equal ids apart and ``doc_offsets`` is where in its document a piece begins.
    """

    def task(batches):
        bpe, numbers, rows = encoder(path, pattern), row_ids(), row_ids()
        pieces: list[tuple] = []
        held = 0

        def out():
            made, count = [], np.arange(length, dtype="<u4")
            for members in best_fit([len(p[3]) for p in pieces], length):
                sizes = [len(pieces[i][3]) for i in members]
                used = sum(sizes)
                ids = np.concatenate([*(pieces[i][3] for i in members), np.full(length - used, pad, "<u4")]).tobytes()
                positions = np.concatenate([*(count[:n] for n in sizes), np.zeros(length - used, "<u4")])
                made.append((next(numbers), used, ids, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32),
                             positions.tobytes(), [pieces[i][0] for i in members], [pieces[i][1] for i in members],
                             [pieces[i][2] for i in members]))
                if len(made) == 500:
                    yield _batch(made)
                    made = []
            if made:
                yield _batch(made)

        for ids, texts in chunks(batches):
            for doc_id, text in zip(ids, texts):
                coded, row = np.array(bpe.encode_ordinary(text or ""), "<u4"), next(rows)
                for at in range(0, len(coded), length):
                    pieces.append((doc_id, row, at, coded[at:at + length]))
                held += len(coded)
                if held >= BLOCK_TOKENS:
                    yield from out()
                    pieces, held = [], 0
        if pieces:
            yield from out()

    return documents(docs).mapInArrow(task, SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), FIELDS)], schema=FIELDS)


def write(packs: DataFrame, folder: str) -> DataFrame:
    """Write the packed rows as Parquet and read them back."""
    packs.write.mode("overwrite").parquet(folder)
    return read(packs.sparkSession, folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(folder)
