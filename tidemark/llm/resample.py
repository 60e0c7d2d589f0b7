"""Draws documents so that their words are distributed like those of a target.

Features are runs of one to ``longest`` consecutive words, joined by a space and hashed
into buckets by CRC-32. A bucket's gain is the log ratio of its share in the target to its
share in the documents; a document weighs the sum of its gains, plus noise that only
depends on its id, and the highest scores are drawn.

Frequent features travel to the tasks: of a word the CRC state, so that runs which begin
with it go on from there, and of a pair of words the bucket. All other features, the tail,
are hashed where they stand. Both ways give the same buckets, so the totals are exact
however many features are held as frequent; the number held is bounded.

Only A-Z are lower-cased. Words are runs of digits, letters a-z and all characters beyond
ASCII. A null text has no words, as an empty one: no features and weight 0. A null id has
noise of its own (that of an empty id) and comes after all others among equal scores. Rows
with equal ids are documents of their own; rows equal in all are drawn in any order. Empty
tables give empty totals, and an empty result if there are no documents. Columns other
than those named are left out, whatever they are called.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import batches_of, row_ids, stored
from tidemark.llm.terms import common
from tidemark.operators.ranking import ordered_rank

# Most words, and most pairs, that are sent to every task.
HEAD = 1 << 16
# Distinct features that a task gathers before it hands on the repeated ones, and how often those must have come.
GATHERED, OFTEN = 100_000, 4
# Range of the noise: the first eight hex digits of a hash.
SPAN = 1 << 32

Run = bytes | tuple[bytes, ...]


def _word_table() -> bytes:
    """Bytes as they count in a word; those that part words become blanks."""
    def kept(b: int) -> int:
        c = b + 32 if 65 <= b <= 90 else b
        return c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32

    return bytes(kept(b) for b in range(256))


WORDS = _word_table()


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(WORDS).split()


def longer_runs(words: list[bytes], longest: int):
    """Runs of two and more words, as tuples."""
    for n in range(2, longest + 1):
        yield from zip(*(words[i:] for i in range(n)))


class Head:
    """What a task knows of frequent features."""

    def __init__(self, words: list[bytes], pairs: list[tuple[bytes, ...]], buckets: int):
        self.buckets = buckets
        self.states = {w: zlib.crc32(w) for w in words}
        self.pairs = {p: self._hashed(p) % buckets for p in pairs}

    def _hashed(self, run: Run) -> int:
        first, rest = (run, ()) if isinstance(run, bytes) else (run[0], run[1:])
        state = self.states.get(first)
        if state is None:
            state = zlib.crc32(first)
        for word in rest:
            state = zlib.crc32(word, zlib.crc32(b" ", state))
        return state

    def bucket(self, run: Run) -> int:
        known = None if isinstance(run, bytes) else self.pairs.get(run)
        return self._hashed(run) % self.buckets if known is None else known


class Gains(dict):
    """The gain of every frequent feature; that of any other is worked out when asked for."""

    def __init__(self, head: Head, gains: list[int]):
        super().__init__((run, gains[head.bucket(run)]) for run in (*head.states, *head.pairs))
        self.head, self.gains = head, gains

    def __missing__(self, run: Run) -> int:
        return self.gains[self.head.bucket(run)]


def raw_texts(df: DataFrame) -> DataFrame:
    return df.select(F.col("text").cast("string").cast("binary").alias("text"))


def frequent(texts: DataFrame, longest: int, most: int) -> tuple[list[bytes], list[tuple[bytes, ...]]]:
    """The most frequent words and pairs, at most ``most`` of each.

    A feature is counted where it comes often enough among what a task holds at a time.
    Which ones are found decides about speed only.
    """
    def task(batches):
        seen: Counter = Counter()

        def out():
            often = [(r, n) for r, n in seen.items() if n >= OFTEN]
            seen.clear()
            yield pa.RecordBatch.from_arrays([
                pa.array([r if isinstance(r, bytes) else b" ".join(r) for r, _ in often], pa.binary()),
                pa.array([isinstance(r, tuple) for r, _ in often], pa.bool_()), pa.array([n for _, n in often], pa.int64())],
                names=["term", "is_pair", "n"])

        for batch in batches:
            for text in batch.column(0):
                words = words_of(text.as_py())
                seen.update(words)
                if longest > 1:
                    seen.update(zip(words, words[1:]))
                if len(seen) > GATHERED:
                    yield from out()
        yield from out()

    counted = stored(
        texts.mapInArrow(task, "term binary, is_pair boolean, n long").groupBy("is_pair", "term").agg(F.sum("n").alias("n")), "features")
    words = [bytes(r["term"]) for r in common(counted.filter("NOT is_pair"), most)]
    pairs = [tuple(bytes(r["term"]).split(b" ")) for r in common(counted.filter("is_pair"), most)] if longest > 1 else []
    return words, pairs


def totals(texts: DataFrame, head, longest: int, buckets: int) -> np.ndarray:
    """Features per bucket over all texts: one vector per task, summed."""
    def add(sums, found, known):
        at = np.fromiter(map(known.bucket, found), np.int64, len(found))
        np.add.at(sums, at, np.fromiter(found.values(), np.int64, len(found)))

    def task(batches):
        known, sums = head.value, np.zeros(buckets, np.int64)
        for batch in batches:
            found: Counter = Counter()
            for text in batch.column(0):
                words = words_of(text.as_py())
                found.update(words)
                found.update(longer_runs(words, longest))
                if len(found) > GATHERED:
                    add(sums, found, known)
                    found.clear()
            add(sums, found, known)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[used])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in texts.mapInArrow(task, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row per bucket
        out[row["bucket"]] = row["n"]
    return out


def gains_of(source: np.ndarray, target: np.ndarray) -> list[int]:
    """Per bucket the floor of 1000 times the log ratio of smoothed shares, in doubles."""
    n, all_source, all_target = len(source), int(source.sum()), int(target.sum())
    return [math.floor(1000 * math.log((t + 1) * (all_source + n) / ((s + 1) * (all_target + n))))
            for s, t in zip(source.tolist(), target.tolist())]


def noise(doc_id: int | None, seed: str) -> int:
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / SPAN)))


def weighed(docs: DataFrame, head, gains: list[int], longest: int, seed: str) -> DataFrame:
    """``row, doc_id, n_words, n_features, weight, score`` of every document."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(gains)

    def task(batches):
        table, numbers = Gains(head.value, sent.value), row_ids()
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            for doc_id, text in zip(ids, batch.column(1)):
                words = words_of(text.as_py())
                n, weight = len(words), sum(map(table.__getitem__, words))
                for run in longer_runs(words, longest):
                    n, weight = n + 1, weight + table[run]
                rows.append((next(numbers), doc_id, len(words), n, weight, weight + noise(doc_id, seed)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [()] * 6)],
                names=["row", "doc_id", "n_words", "n_features", "weight", "score"])

    raw = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return raw.mapInArrow(task, "row long, doc_id long, n_words long, n_features long, weight long, score long")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, longest: int = 1, buckets: int = 10_000,
    seed: str = "2024", most: int = HEAD,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every document.

    Of the documents with ``least_words`` and more, ``percent`` of a hundred (rounded down)
    are drawn by score and ranked from 1; equal scores by the smaller id. The others have
    no rank.
    """
    texts, wanted = raw_texts(docs), raw_texts(target)
    with batches_of(docs.sparkSession):
        head = docs.sparkSession.sparkContext.broadcast(Head(*frequent(texts, longest, most), buckets))
        gains = gains_of(totals(texts, head, longest, buckets), totals(wanted, head, longest, buckets))
        rows = stored(weighed(docs, head, gains, longest, seed), "weighed")
    fit = F.col("n_words") >= least_words
    drawn = rows.filter(fit).count() * percent // 100
    ranked = ordered_rank(rows, [fit.desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")])
    return ranked.select(
        "doc_id", "n_features", "weight", "score", F.when(fit & (F.col("rank") <= drawn), F.col("rank")).alias("rank"))
