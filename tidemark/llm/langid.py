"""Language identification with a string kernel.

The kernel of two texts is the share of n-grams that both hold, over all lengths of a
blended spectrum: ``|A and B| / sqrt(|A| |B|)`` on presence, whatever the length of the
texts. A Nystroem map over landmark texts turns it into features for one ridge regression
per language. As the kernel is linear in the presence vectors, landmarks and weights fold
into one matrix, and a batch of whole texts is scored by one matrix product.

The model is fitted on a bounded sample of labelled rows (``TRAIN_DOCS``), parted evenly
between the languages. A text that is null or has no letter is ``und`` with score 0; so is
everything if nothing could be learned. Rows with equal or null ids are predicted each on
its own; null ids are not learned from. Of equal scores the language first in order is taken.
An empty table gives an empty result. Columns other than ``doc_id``, ``text`` and ``lang`` are
not looked at, whatever they are called.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import BATCH_ROWS, per_document

UNDETERMINED = "und"
FOLDS, HELD_OUT = 4, 2
# Labelled documents that the model is fitted on, and landmarks among them.
TRAIN_DOCS, LANDMARKS = 2_400, 400
# Lengths of the n-grams in bytes, and hash buckets of their presence.
SPECTRUM, BITS = (2, 3, 4), 14
RIDGE, SHARPNESS = 1e-2, 6.0
# Texts whose presence vectors are held at once.
ROWS = 128

LETTER = regex.compile(r"\p{L}")
OTHER = regex.compile(r"[\P{L}]+")
MIX = np.uint64(0x9E3779B97F4A7C15)


def presence(texts: list[str]) -> np.ndarray:
    """One row of n-gram presence per text; runs of other characters than letters count as one space."""
    out = np.zeros((len(texts), 1 << BITS), bool)
    for i, text in enumerate(texts):
        data = np.frombuffer(f" {OTHER.sub(' ', text.lower())} ".encode(), np.uint8).astype(np.uint64)
        code = np.full(len(data), 1, np.uint64)
        for n in range(1, max(SPECTRUM) + 1):
            if len(data) < n:
                break
            code = (code[:len(data) - n + 1] << np.uint64(8)) | data[n - 1:]
            if n in SPECTRUM:
                out[i, (code * MIX) >> np.uint64(64 - BITS)] = True
    return out


def normalised(found: np.ndarray) -> np.ndarray:
    rows = found.astype(np.float32)
    rows /= np.sqrt(np.maximum(rows.sum(axis=1, keepdims=True), 1))
    return rows


def unpacked(bits: np.ndarray) -> np.ndarray:
    return normalised(np.unpackbits(bits, axis=1))


def kernel(bits: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """The kernel of rows given as packed bits with the landmarks; few rows are unpacked at once."""
    return np.vstack([unpacked(bits[at:at + ROWS]) @ marks.T for at in range(0, len(bits), ROWS)])


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS, landmarks: int = LANDMARKS) -> tuple[list[str], np.ndarray]:
    """Languages and the matrix that scores presence vectors, from a bounded sample of labelled rows."""
    key = F.crc32(F.col("doc_id").cast("string"))
    labelled = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).filter(
        (F.pmod(key, F.lit(FOLDS)) != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang")
              .limit(train_docs).collect()}
    if not counts:
        return [], np.zeros((1 << BITS, 0), np.float32)
    each = max(1, train_docs // len(counts))
    # A hash of the id decides: the same rows wherever they lie, about as many of each language.
    share = F.create_map(*(x for lang, n in counts.items() for x in (F.lit(lang), F.lit(min(1.0, each / n)))))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = labelled.filter(F.coalesce(draw < share[F.col("lang")], F.lit(False)))

    def work(ids, texts):
        return ids, [np.packbits(p).tobytes() for p in presence([t or "" for t in texts])]

    packed = per_document(sample, work, "doc_id long, bits binary")
    langs = sample.select("doc_id", "lang")
    rows = packed.join(langs, "doc_id").distinct().orderBy(F.xxhash64("doc_id"), "lang").limit(2 * train_docs).collect()
    # Unpacked, the sample would take 64 KB a row of the driver's memory; packed, it takes 2.
    bits = np.frombuffer(b"".join(bytes(r["bits"]) for r in rows), np.uint8).reshape(len(rows), -1)
    names = sorted({r["lang"] for r in rows})
    y = np.where(np.array([[r["lang"] == n for n in names] for r in rows]), 1.0, -1.0)
    # Landmarks: as many of each language.
    rank = np.zeros(len(rows), int)
    seen: dict[str, int] = {}
    for i, r in enumerate(rows):
        rank[i] = seen.get(r["lang"], 0)
        seen[r["lang"]] = rank[i] + 1
    marks = unpacked(bits[np.argsort(rank, kind="stable")[:landmarks]])
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    kept = values > 1e-6 * values.max()
    root = vectors[:, kept] / np.sqrt(values[kept])
    phi = kernel(bits, marks).astype(np.float64) @ root
    phi1 = np.hstack([phi, np.ones((len(phi), 1))])
    balance = np.array([1.0 / seen[r["lang"]] for r in rows])[:, None]
    gram = (phi1 * balance).T @ phi1
    solved = np.linalg.solve(gram + RIDGE * np.eye(len(gram)) * len(names) / max(1, len(rows)), (phi1 * balance).T @ y)
    matrix = marks.T.astype(np.float64) @ (root @ solved[:-1])
    return names, np.vstack([matrix, solved[-1:]]).astype(np.float32)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """``doc_id, lang_pred, score`` of every text; the score is a softmax over the languages."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    return per_document(
        docs, lambda ids, texts: (ids, *classified(texts, sent.value)), "doc_id long, lang_pred string, score double")


def classified(texts: list[str | None], model: tuple[list[str], np.ndarray]) -> tuple[list[str], list[float]]:
    """Language and score of every text, in batches of one matrix product each."""
    names, matrix = model
    langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    lettered = [i for i, t in enumerate(texts) if names and t and LETTER.search(t)]
    for at in range(0, len(lettered), ROWS):
        part = lettered[at:at + ROWS]
        raw = normalised(presence([texts[i] for i in part])) @ matrix[:-1] + matrix[-1]
        odds = np.exp(SHARPNESS * (raw - raw.max(axis=1, keepdims=True)).astype(np.float64))
        odds /= odds.sum(axis=1, keepdims=True)
        for i, best, row in zip(part, odds.argmax(axis=1), odds):
            langs[i], scores[i] = names[best], float(row[best])
    return langs, scores


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``, learning from the rows that are not held out."""
    rest = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS))
    out = predict(docs, fit(docs))
    return out.select("doc_id", F.coalesce(rest == HELD_OUT, F.lit(False)).alias("held_out"), "lang_pred", "score")


def keep_known(docs: DataFrame, model: tuple[list[str], np.ndarray] | None = None) -> DataFrame:
    """The rows, with all their columns, whose text has a language; the others are rejected.

    Each row is decided by its own text, so repeated and null ids make no difference. If
    nothing could be learned, every text with a letter stays.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model or fit(docs))
    at = docs.columns.index("text")

    def task(batches):
        for batch in batches:
            kept = known(batch.column(at).to_pylist(), sent.value)
            yield batch.take(pa.array(kept, pa.int64()))

    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return docs.mapInArrow(task, docs.schema)


def known(texts: list[str | None], model: tuple[list[str], np.ndarray]) -> list[int]:
    """Places of the texts that are in one of the learned languages."""
    if not model[0]:
        return [i for i, t in enumerate(texts) if t and LETTER.search(t)]
    return [i for i, lang in enumerate(classified(texts, model)[0]) if lang != UNDETERMINED]
