"""Log probability of a text, over all ways to cut its words into pieces.

The pieces are those of an existing vocabulary; their probabilities are learned here from
the distinct words of the training documents, apart for the first and later places in a
word and for the last and earlier ones. A word's probability is the sum over all
segmentations, by a forward recursion in log space; a word seen in training is also an
entry of its own, and the share of words seen once is what the pieces have. A text's
probability is the product over its words and one end: it sums to 1 over all texts. The
values of a distinct word are computed once.

Training documents are those whose ``crc32(doc_id)`` leaves a remainder of ``1..folds-1``.
A null or empty text is one end token. A null id is neither trained on nor held out. Rows
with equal ids are scored each on its own. An empty table gives an empty result; without
training documents all pieces are equally likely. Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import stored
from tidemark.llm.bpe import coder
from tidemark.llm.terms import COMMON_TERMS, count_terms, summed

FOLDS = 10
# Added to the count of every piece in every place.
PIECE_SMOOTHING = 0.1
# The end of a text; no word is empty.
END = ""
# Places of a piece: 2 * (not first) + (last).
PLACES = 4
LETTERS = frozenset(b" \t\n\v\f\rABCDEFGHIJKLMNOPQRSTUVWXYZ")


def words(text: str) -> list[str]:
    """Words of the text with A-Z in lower case; only ASCII white space parts them."""
    found = b" ".join(text.encode().lower().split()).decode()
    return found.split(" ") if found else []


def tokens(text: str) -> list[str]:
    return [*words(text), END]


def trains(doc_id: int | None, folds: int = FOLDS) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds != 0


class Lattice:
    """Log10 probabilities of pieces by place, and the forward recursion over a word."""

    def __init__(self, path: str, pattern: str, weights: np.ndarray):
        bpe = coder(path, pattern)
        self.tables: list[dict[bytes, float]] = [{} for _ in range(PLACES)]
        for i, token in enumerate(bpe.token_bytes):
            if token and LETTERS.isdisjoint(token):
                for place in range(PLACES):
                    self.tables[place][token] = float(weights[place, i])
        self.longest = max((len(t) for t in self.tables[0]), default=1)

    def word(self, word: bytes) -> float:
        first, first_last, later, later_last = self.tables
        size, longest = len(word), self.longest
        reach = [-math.inf] * size
        for j in range(1, size):
            terms = [first[word[:j]]] if j <= longest and word[:j] in first else []
            for i in range(max(1, j - longest), j):
                weight = later.get(word[i:j])
                if weight is not None and reach[i] > -math.inf:
                    terms.append(reach[i] + weight)
            reach[j] = log_sum(terms)
        terms = [first_last[word]] if word in first_last else []
        for i in range(max(1, size - longest), size):
            weight = later_last.get(word[i:])
            if weight is not None:
                terms.append(reach[i] + weight)
        return log_sum(terms)


def log_sum(terms: list[float]) -> float:
    if not terms:
        return -math.inf
    if len(terms) == 1:
        return terms[0]
    most = max(terms)
    return most if most == -math.inf else most + math.log10(sum([10.0 ** (t - most) for t in terms]))


def piece_counts(counted: DataFrame, path: str, pattern: str) -> DataFrame:
    """``slot, n``: in how many distinct training words a piece stands in a place; ``slot``
    is place times vocabulary size plus piece. At most four rows per piece.
    """

    def task(batches):
        bpe = coder(path, pattern)
        size = len(bpe.token_bytes)
        sums = np.zeros(PLACES * size, np.int64)
        for batch in batches:
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not n or not word:
                    continue
                ids = np.frombuffer(bpe.encode_piece(word), "<u4").astype(np.int64)
                place = np.full(len(ids), 2)
                place[0] -= 2
                place[-1] += 1
                np.add.at(sums, place * size + ids, 1)
        slots = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int64()), pa.array(sums[slots])], names=["slot", "n"])

    return counted.select("term", "n").mapInArrow(task, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))


def weights(counts: list, path: str, pattern: str) -> np.ndarray:
    """Log10 probabilities by place and piece; pieces that no word can hold get none."""
    bpe = coder(path, pattern)
    size = len(bpe.token_bytes)
    n = np.zeros(PLACES * size)
    for row in counts:
        n[row["slot"]] = row["n"]
    usable = np.array([bool(t) and LETTERS.isdisjoint(t) for t in bpe.token_bytes])
    n = (n + PIECE_SMOOTHING).reshape(PLACES, size) * usable
    with np.errstate(divide="ignore"):
        return np.concatenate([np.log10(n[:2] / n[:2].sum()), np.log10(n[2:] / n[2:].sum())])


def score(docs: DataFrame, path: str, pattern: str, folds: int = FOLDS, most: int = COMMON_TERMS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    ``base_score`` is the smoothed unigram score of the words, ``score`` the log10
    probability of the text under the piece model.
    """
    counted = stored(count_terms(docs, tokens, lambda doc_id: trains(doc_id, folds)), "words")
    total = counted.agg(
        F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("v"), F.count_if((F.col("n") == 1) & (F.col("term") != END)).alias("once"),
        F.sum(F.when(F.col("term") == END, F.col("n"))).alias("documents")).first()
    n, v, trained = total["n"] or 0, total["v"] or 0, total["documents"] or 0
    # An end and a word never seen have their share even where nothing was learned.
    end = (trained + 1) / (n + 2)
    new = ((total["once"] or 0) + 1) / (n - trained + 1)
    table = weights(piece_counts(counted, path, pattern).collect(), path, pattern)  # four rows a piece at most
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def value(batches):
        lattice = Lattice(path, pattern, sent.value)
        by_pieces = math.log10((1 - end) * new)
        for batch in batches:
            out = []
            for word, seen in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if word == END:
                    out.append(math.log10(end))
                    continue
                terms = [by_pieces + lattice.word(word.encode())]
                if seen and new < 1:
                    terms.append(math.log10((1 - end) * (1 - new) * seen / (n - trained)))
                out.append(log_sum(terms))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], names=["term", "n", "score"])

    valued = counted.select("term", "n").mapInArrow(value, "term string, n long, score double").select(
        "term", "n", F.lit(1.0).alias("n_tokens"), F.when(F.col("n") > 0, 1.0).otherwise(0.0).alias("n_known"),
        F.log10((F.col("n") + 0.1) / F.lit(n + 0.1 * (v + 1))).alias("base_score"), "score")
    out = summed(
        docs, tokens, stored(valued, "word-scores"), ["n_tokens", "n_known", "base_score", "score"],
        lambda doc_id, _: (doc_id is not None and not trains(doc_id, folds),), {"held_out": "boolean"}, most)
    return out.select(
        "doc_id", "held_out", F.col("n_tokens").cast("long").alias("n_tokens"), F.col("n_known").cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
