"""Vectors for texts: a pluggable function and a cache keyed by model and text."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Embedder = Callable[[list[str]], "list[list[float]] | np.ndarray"]

CACHE = "cache_key string, model string, vector array<float>"
RESULT = f"{CACHE}, error string"

# What is said of a text that the model returns nothing for, or a vector of another length.
EMPTY_VECTOR = "Embedding: empty vector"
WRONG_LENGTH = "Embedding: vector of {found} values where {wanted} are expected"
ERROR_CHARS = 1000

# Errors of the way to the model, not of a text: the task fails and Spark tries it again; no item is charged.
OUTAGES = (ConnectionError, TimeoutError)

_WORD = re.compile(r"[A-Za-z0-9]+")


def bag_of_words(dim: int = 64) -> Embedder:
    """An offline stand-in for a model: hashed word counts, scaled to length one."""
    class Buckets(dict):
        def __missing__(self, word: str) -> int:
            if len(self) > 500_000:
                self.clear()
            digest = hashlib.md5(word.encode()).digest()
            self[word] = int.from_bytes(digest[:4], "big") % dim
            return self[word]

    def embed(texts: list[str], buckets: dict = Buckets()) -> np.ndarray:
        out = np.zeros((len(texts), dim), dtype=np.float32)
        for row, body in enumerate(texts):
            hits = [buckets[w.lower()] for w in _WORD.findall(body)]
            if hits:
                out[row] = np.bincount(hits, minlength=dim)
        norms = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norms == 0, 1, norms)

    return embed


def cache_key(model: str, text: Column) -> Column:
    return F.sha2(F.concat(F.encode(F.lit(model), "UTF-8"), F.unhex(F.lit("00")), F.encode(text, "UTF-8")), 256)


def cache_misses(chunks: DataFrame, cache: DataFrame, model: str) -> DataFrame:
    """Each text not yet embedded by the model, once: ``(cache_key, text)``.

    Equal texts collapse on the map side before the shuffle, so a boilerplate chunk that
    makes up a third of all rows reaches its reducer once per map task.
    """
    keyed = chunks.select(cache_key(model, F.col("text")).alias("cache_key"), "text")
    known = cache.filter(F.col("model") == model).select("cache_key")
    return keyed.groupBy("cache_key").agg(F.first("text").alias("text")).join(known, "cache_key", "left_anti")


def _vectors(embedder: Embedder, texts: list[str], dims: int | None) -> list[tuple[np.ndarray | None, str | None]]:
    """Vector or error of each text. If a batch fails, its texts are tried one by one; an outage is passed on."""
    try:
        found = [np.asarray(x, dtype=np.float32) for x in embedder(texts)]
        if len(found) != len(texts):
            raise ValueError(f"{len(found)} vectors for {len(texts)} texts")
    except OUTAGES:
        raise
    except Exception as error:  # of any model: it is the text's failure, not the run's
        if len(texts) == 1:
            return [(None, f"Embedding: {error}"[:ERROR_CHARS])]
        return [out for text in texts for out in _vectors(embedder, [text], dims)]
    return [
        (None, EMPTY_VECTOR) if not x.size else
        (x, None) if dims in (None, x.size) else (None, WRONG_LENGTH.format(found=x.size, wanted=dims)) for x in found]


def embed_results(texts: DataFrame, embedder: Embedder, model: str, batch_size: int = 256, dims: int | None = None) -> DataFrame:
    """Embed ``(cache_key, text)`` rows in Arrow batches; a text has a vector or an error.

    With ``dims`` a vector of another length is an error of its text.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, batch_size):
                part = batch.slice(start, batch_size)
                vectors, errors = zip(*_vectors(embedder, part.column(1).to_pylist(), dims))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([model] * part.num_rows, pa.string()),
                        pa.array(vectors, pa.list_(pa.float32())),
                        pa.array(errors, pa.string()),
                    ],
                    names=["cache_key", "model", "vector", "error"])

    return texts.select("cache_key", "text").mapInArrow(run, RESULT)


def embed_texts(texts: DataFrame, embedder: Embedder, model: str, batch_size: int = 256) -> DataFrame:
    """The cache rows of the texts that got a vector; a text without one is a failed chunk."""
    return embed_results(texts, embedder, model, batch_size).filter("vector IS NOT NULL").drop("error")


def item_errors(chunks: DataFrame, results: DataFrame, model: str) -> DataFrame:
    """``job_id, error``: the first error among the chunks of each item that has one."""
    keyed = chunks.select("job_id", cache_key(model, F.col("text")).alias("cache_key"))
    failed = results.filter("error IS NOT NULL").select("cache_key", "error")
    return keyed.join(failed, "cache_key").groupBy("job_id").agg(F.min("error").alias("error"))


def attach_vectors(chunks: DataFrame, cache: DataFrame, model: str) -> DataFrame:
    """The chunks that have a vector, with it; a chunk without one has failed.

    The cache is unique per key and holds no empty vector, so a hot text skews only the
    chunk side, which adaptive execution splits, and a caller that does not use the
    vectors does not read them.
    """
    vectors = cache.filter(F.col("model") == model).select("cache_key", "vector")
    return chunks.withColumn("cache_key", cache_key(model, F.col("text"))).join(vectors, "cache_key").drop("cache_key")
