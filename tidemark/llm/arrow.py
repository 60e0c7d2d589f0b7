"""Arrow-batch helpers: documents in bounded chunks, rows out, row ids."""

from __future__ import annotations

import gc
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import work_dir

# Rows of one Arrow batch, and text of one chunk inside a task: they bound a worker's memory.
BATCH_ROWS = 1_000
CHUNK_BYTES = 1_000_000
# What the listeners of a query get to let go of its plan.
SETTLE_SECONDS = 0.5


@contextmanager
def batches_of(spark: SparkSession, rows: int = BATCH_ROWS):
    """Arrow batches of at most ``rows`` for what is run inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def documents(df: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` of the input; other columns, whatever their names, are left out."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def chunks(batches: Iterator[pa.RecordBatch], limit: int = CHUNK_BYTES) -> Iterator[tuple[list, list[str | None]]]:
    """Document ids and texts in chunks of about ``limit`` characters; a longer text is a chunk of its own."""
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1)
        start, size = 0, 0
        lengths = pc.binary_length(texts).to_pylist()
        for i, n in enumerate(lengths):
            if size and size + (n or 0) > limit:
                yield ids[start:i], texts.slice(start, i - start).to_pylist()
                start, size = i, 0
            size += n or 0
        if start < len(ids):
            yield ids[start:], texts.slice(start).to_pylist()


def per_document(df: DataFrame, work: Callable, schema: str) -> DataFrame:
    """Run ``work(ids, texts)`` on chunks; it returns the columns of the output in schema order."""
    names = [part.split()[0] for part in _fields(schema)]

    def task(batches):
        target = None
        for ids, texts in chunks(batches):
            columns = work(ids, texts)
            target = target or to_arrow(schema)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t.type) if not isinstance(c, pa.Array) else c.cast(t.type)
                 for c, t in zip(columns, target)], names=names)

    return documents(df).mapInArrow(task, schema)


def _fields(schema: str) -> list[str]:
    parts, depth, last = [], 0, 0
    for i, c in enumerate(schema):
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            parts.append(schema[last:i].strip())
            last = i + 1
    return [*parts, schema[last:].strip()]


def to_arrow(schema: str) -> list[pa.Field]:
    """The Arrow fields of a plain DDL schema."""
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64(),
        "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
        "array<binary>": pa.list_(pa.binary()), "array<string>": pa.list_(pa.string()),
    }
    return [pa.field(p.split(None, 1)[0], kinds[p.split(None, 1)[1]]) for p in _fields(schema)]


def row_ids() -> Iterator[int]:
    """Numbers that no other task gives; a repeated task gives the same ones again."""
    context = TaskContext.get()
    at = (context.partitionId() if context else 0) << 36
    while True:
        yield at
        at += 1


def stored(df: DataFrame, purpose: str, path: str | None = None) -> DataFrame:
    """Write once to the shared folder and read back: lineage ends here."""
    path, spark, schema = path or work_dir(df.sparkSession, purpose), df.sparkSession, df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def forget(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``stored`` wrote and that no later step reads."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nobody holds any more.

    It does so when the driver collects its garbage. The listeners of the last query get a
    moment to let go of its plan; what the first pass lets go of may hold more.
    """
    for _ in range(2):
        gc.collect()
        time.sleep(SETTLE_SECONDS)
        spark.sparkContext._jvm.System.gc()
