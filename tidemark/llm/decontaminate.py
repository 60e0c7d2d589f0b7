"""Benchmark items inside documents, by size-partitioned MinHash containment.

Items are parted by the size of their shingle set. The sketch of an item holds its least
shingle hashes, as many as its part needs so that a document with the required share of
the item holds at least one of them: ``s = u - ceil(share * u) + 1`` for the part's upper
size ``u``. A document looks up all of its shingles, whatever its length; every item met is
verified by exact containment. Items are sent to the tasks in blocks of bounded size.

An item without words matches nothing; one with fewer than five words is one shingle. Null
or empty texts hold no item. Repeated documents and items are matched each on its own;
rows with equal pairs of ids come once, so ties are all there. An empty table on either side
gives an empty result, and ``clean`` all documents. Other columns are not looked at, whatever
they are called.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import per_document, stored
from tidemark.llm.shingles import shingle_sets

SHARE = 0.8
# Shingles of items that are sent to the tasks at once.
BLOCK_SHINGLES = 1_000_000
# Texts whose sets are made at once.
ROWS = 100

SCHEMA = "doc_id long, item_id long, n_item long, n_shared long"


def sketch_size(size: int, share: float) -> int:
    """Hashes kept of a set of ``size``: enough for the upper bound of its part, a power of two."""
    upper = 1 << max(0, size - 1).bit_length()
    return min(size, upper - math.ceil(share * upper - 1e-9) + 1)


class Index:
    """Sketches of a block of items, and their whole sets to verify by."""

    def __init__(self, items: list[tuple[int, np.ndarray]], share: float):
        self.items, self.share = items, share
        kept = [s[:sketch_size(len(s), share)] for _, s in items]
        hashes = np.concatenate(kept) if kept else np.empty(0, np.uint64)
        owners = np.repeat(np.arange(len(kept)), [len(k) for k in kept])
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owners = hashes[order], owners[order]
        # Most shingles of a document are in no sketch: one look at a bit table tells.
        self.bits = max(16, int(len(hashes)).bit_length() + 4)
        self.table = np.zeros(1 << self.bits, bool)
        self.table[self._slot(self.hashes)] = True

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)

    def matches(self, found: np.ndarray) -> list[tuple[int, int, int]]:
        """``item_id, n_item, n_shared`` of the items that a sorted set holds."""
        probe = found[self.table[self._slot(found)]] if len(self.hashes) else found[:0]
        a, b = np.searchsorted(self.hashes, probe, "left"), np.searchsorted(self.hashes, probe, "right")
        met = {int(o) for x, y in zip(a, b) if y > x for o in self.owners[x:y]}
        out = []
        for i in sorted(met):
            item_id, item = self.items[i]
            at = np.searchsorted(found, item)
            shared = int((found[np.minimum(at, len(found) - 1)] == item).sum())
            if shared >= self.share * len(item) - 1e-9:
                out.append((item_id, len(item), shared))
        return out


def indexes(items: DataFrame, share: float, block: int) -> list:
    """Broadcast indexes over all items, in blocks of a bounded number of shingles; at least one."""
    spark = items.sparkSession

    def sets(ids, texts):
        found = shingle_sets(texts)
        return ids, [len(s) for s in found], [s.tobytes() for s in found]

    held = stored(
        per_document(items.select(F.col("item_id").alias("doc_id"), "text"), sets, "doc_id long, n long, shingles binary")
        .filter("n > 0").distinct(), "items")
    total = held.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, math.ceil(2 * total / block))
    out = []
    for i in range(blocks):
        rows = held.filter(F.pmod(F.xxhash64("shingles"), F.lit(blocks)) == i).orderBy("doc_id", "shingles").collect()
        out.append(spark.sparkContext.broadcast(Index([(r["doc_id"], np.frombuffer(bytes(r["shingles"]), np.uint64)) for r in rows], share)))
    return out


def matches(docs: DataFrame, items: DataFrame, share: float = SHARE, block: int = BLOCK_SHINGLES) -> DataFrame:
    """``doc_id, item_id, n_item, n_shared``: every document that holds at least ``share`` of an item's shingles."""
    sent = indexes(items, share, block)

    def work(ids, texts):
        rows = [(i, *m) for i, s in zip(ids, shingle_sets(texts)) if len(s) for index in sent for m in index.value.matches(s)]
        return list(zip(*rows)) if rows else [[], [], [], []]

    return per_document(docs, work, SCHEMA).distinct()


def clean(docs: DataFrame, items: DataFrame, share: float = SHARE, block: int = BLOCK_SHINGLES) -> DataFrame:
    """The documents that hold no item, with all their columns.

    Each row is decided by its own text where it is read, so repeated and null ids make no
    difference and nothing is joined.
    """
    sent, at = indexes(items, share, block), docs.columns.index("text")

    def task(batches):
        for batch in batches:
            texts, kept = batch.column(at), []
            # The sets of a few texts at a time, as a batch may hold many long ones.
            for low in range(0, batch.num_rows, ROWS):
                found = shingle_sets(texts.slice(low, ROWS).to_pylist())
                kept += [low + i for i, s in enumerate(found) if not any(len(s) and index.value.matches(s) for index in sent)]
            yield batch.take(pa.array(kept, pa.int64()))

    return docs.mapInArrow(task, docs.schema)
