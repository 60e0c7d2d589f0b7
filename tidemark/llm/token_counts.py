"""Token counts by distinct pre-token.

The pieces of a pre-token are counted once, whatever its number of occurrences; a
document's count is the sum over its pre-token frequencies. No token ids are kept.

A null or empty text has no tokens. Rows with equal or null ids are counted each on its
own. An empty table gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

import json
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.arrow import stored
from tidemark.llm.terms import COMMON_TERMS, count_terms, summed

OVER = 1024


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


# Letters and digits of other blocks depend on the Unicode version of the library.
UNSETTLED = regex.compile(r"[^\x00-\u052F\u2000-\u206F\u4E00-\u9FA5]")


@lru_cache(maxsize=4)
def _splitter(path: str, pattern: str):
    """Cuts a text into special strings, which stay whole, and pre-tokens."""
    with open(path, encoding="utf-8") as file:
        special = [t["content"] for t in json.load(file).get("added_tokens", [])]
    fast, exact = regex.compile(pattern), tokenizer(path).pre_tokenizer

    def cut(text: str) -> list[str]:
        if UNSETTLED.search(text):
            return [text[a:b] for _, (a, b) in exact.pre_tokenize_str(text)]
        return fast.findall(text)

    if not special:
        return cut
    marks = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")")

    def split(text: str) -> list[str]:
        if not any(s in text for s in special):
            return cut(text)
        out: list[str] = []
        for i, part in enumerate(marks.split(text)):
            out.extend([part] if i % 2 else cut(part))
        return out

    return split


def count_tokens(docs: DataFrame, path: str, pattern: str, over: int = OVER, most: int = COMMON_TERMS) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every text.

    ``path`` is a byte-level tokenizer file, ``pattern`` its pre-token pattern; ``most``
    bounds the pre-tokens that are sent to every task.
    """

    def split(text: str) -> list[str]:
        return _splitter(path, pattern)(text)

    def pieces(batches):
        coder = tokenizer(path)
        for batch in batches:
            counts = []
            for at in range(0, batch.num_rows, 1000):
                words = batch.column(0).slice(at, 1000).to_pylist()
                counts += [len(e.ids) for e in coder.encode_batch(words, add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64())], names=["term", "n", "n_tokens"])

    valued = stored(count_terms(docs, split).mapInArrow(pieces, "term string, n long, n_tokens long"), "pieces")
    out = summed(docs, split, valued, ["n_tokens"], lambda _, text: (len((text or "").encode()),), {"n_bytes": "long"}, most)
    count = F.col("n_tokens").cast("long")
    return out.select("doc_id", "n_bytes", count.alias("n_tokens"), (count > over).alias("over_limit"))
