"""Sums over the terms of a document, with each distinct term valued once.

``count_terms`` counts the distinct terms of all texts. ``common`` picks the commonest of
them, never more than a fixed number, so that they can travel to every task; all others
are joined by shuffle. A term that fills a third of all texts is thus never a join key.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import chunks, documents, row_ids

# Most terms that are sent to every task.
COMMON_TERMS = 1 << 18
# Distinct terms that a task gathers before it hands them on.
GATHERED = 300_000
# Rows of one outgoing batch.
OUT_ROWS = 100_000

Split = Callable[[str], list[str]]


def count_terms(docs: DataFrame, split: Split, counted: Callable[[int | None], bool] | None = None) -> DataFrame:
    """``term, n`` for every term of every text; texts that ``counted`` refuses add 0 to theirs."""

    def task(batches):
        seen: Counter = Counter()

        def out():
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["term", "n"])
            seen.clear()

        for ids, texts in chunks(batches):
            for doc_id, text in zip(ids, texts):
                found = split(text or "")
                if counted is None or counted(doc_id):
                    seen.update(found)
                else:
                    for term in found:
                        seen.setdefault(term, 0)
            if len(seen) > GATHERED:
                yield from out()
        if seen:
            yield from out()

    return documents(docs).mapInArrow(task, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def common(valued: DataFrame, most: int = COMMON_TERMS) -> list:
    """The rows of the commonest terms, ``most`` at the utmost: those above a count that so many reach."""
    step = F.floor(F.log2(F.col("n") + 1) * 8)
    levels = sorted(((r["level"], r["terms"]) for r in valued.filter("n > 1").groupBy(step.alias("level"))
                     .agg(F.count("*").alias("terms")).collect()), reverse=True)  # under 600 levels
    taken, least = 0, math.inf
    for level, number in levels:
        if taken + number > most:
            break
        taken, least = taken + number, level
    if least == math.inf:
        return []
    return valued.filter((F.col("n") > 1) & (step >= least)).collect()


def summed(docs: DataFrame, split: Split, valued: DataFrame, columns: list[str], extra: Callable[[int | None, str | None], tuple],
           extra_columns: dict[str, str], most: int = COMMON_TERMS) -> DataFrame:
    """Per document: ``extra_columns`` and, for each of ``columns``, the sum of its value over all terms.

    ``valued`` holds ``term``, ``n`` and one numeric column per name. Each row of the input
    is a document of its own, also when ids repeat or are null.
    """
    table = {r["term"]: tuple(float(r[c]) for c in columns) for r in common(valued.select("term", "n", *columns), most)}
    sent = docs.sparkSession.sparkContext.broadcast(table)
    width, kinds = len(columns), list(extra_columns.items())
    arrow_kind = {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}
    schema = ", ".join(["row long", "doc_id long", "term string", "freq long", *(f"{n} {k}" for n, k in kinds),
                        *(f"known_{c} double" for c in columns)])
    fields = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("term", pa.string()), ("freq", pa.int64()),
                        *((n, arrow_kind[k]) for n, k in kinds), *((f"known_{c}", pa.float64()) for c in columns)])

    def task(batches):
        table, numbers = sent.value, row_ids()
        blank = (None,) * len(kinds) + (None,) * width
        rows: list[tuple] = []
        for ids, texts in chunks(batches):
            for doc_id, text in zip(ids, texts):
                row, sums, rare = next(numbers), [0.0] * width, []
                for term, freq in Counter(split(text or "")).items():
                    values = table.get(term)
                    if values is None:
                        rare.append((row, doc_id, term, freq, *blank))
                    else:
                        for i, v in enumerate(values):
                            sums[i] += v * freq
                head = (*extra(doc_id, text), *sums)
                # The first row carries what is known already. A document without rare terms
                # gets a key of its own that no term equals: not one null key for all of them.
                if rare:
                    rare[0] = (*rare[0][:4], *head)
                else:
                    rare = [(row, doc_id, f"\x00{row}", 0, *head)]
                rows += rare
                if len(rows) >= OUT_ROWS:
                    yield _batch(rows, fields)
                    rows = []
        if rows:
            yield _batch(rows, fields)

    spread = documents(docs).mapInArrow(task, schema)
    joined = spread.join(valued.select("term", *columns), "term", "left")
    return joined.groupBy("row", "doc_id").agg(
        *(F.max(n).alias(n) for n, _ in kinds),
        *((F.sum(F.coalesce(f"known_{c}", F.lit(0.0))) + F.sum(F.coalesce(F.col(c) * F.col("freq"), F.lit(0.0)))).alias(c)
          for c in columns),
    ).drop("row")


def _batch(rows: list[tuple], fields: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=fields)
