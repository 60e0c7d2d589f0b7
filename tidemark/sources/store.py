"""Versioned table snapshots behind a small pointer file.

A snapshot is written to a new folder, then the pointer is swapped by rename, so a
reader sees the old or the new table and a path being read is never overwritten. A
lost executor costs a task retry; a lost driver leaves the old pointer in place.

A table may be split by a partition column. A write then names the partitions it
holds, and the pointer keeps the other partitions where earlier versions put them:
work grows with the partitions touched, not with the table.
"""

from __future__ import annotations

import json

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH = "1970-01-01 00:00:00"

# Steps of the last runs that a table remembers, to leave out when a run is repeated.
REMEMBERED_RUNS = 16


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- pointer files through the Hadoop file system, so any shared store works

    def _fs(self, path: str):
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def _read_json(self, path: str) -> dict | None:
        fs, target = self._fs(path)
        if not fs.exists(target):
            return None
        stream = fs.open(target)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _write_json(self, path: str, body: dict) -> None:
        fs, target = self._fs(path)
        _, part = self._fs(f"{path}.next")
        stream = fs.create(part, True)
        try:
            stream.write(bytearray(json.dumps(body).encode()))
        finally:
            stream.close()
        rename = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.getUri(), self.spark._jsc.hadoopConfiguration()
        )
        option = self.spark._jvm.org.apache.hadoop.fs.Options.Rename
        flags = self.spark._sc._gateway.new_array(option, 1)
        flags[0] = option.OVERWRITE
        rename.rename(part, target, flags)

    # -- tables

    def pointer(self, table: str) -> dict | None:
        return self._read_json(f"{self.root}/{table}/current.json")

    def version(self, table: str) -> int:
        return (self.pointer(table) or {"version": 0})["version"]

    def read(self, table: str, schema: str | T.StructType) -> DataFrame:
        """The current snapshot, or an empty table before the first write.

        A partition column that is not part of the schema comes last.
        """
        fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        current = self.pointer(table)
        if not current or not current["paths"]:
            return self.spark.createDataFrame([], fields)
        names = fields.names
        if current["by"] and current["by"] not in names:
            fields = T.StructType([*fields, T.StructField(current["by"], T.StringType())])
        frames = [
            self.spark.read.schema(fields).option("basePath", base).parquet(*paths)
            for base, paths in _by_base(current["paths"]).items()
        ]
        return reduce(DataFrame.unionByName, frames).select(*fields.names)

    def write(
        self,
        table: str,
        rows: DataFrame,
        by: str | None = None,
        touched: list[str] | None = None,
        run: str | None = None,
        buckets: int | None = None,
        counts: dict[str, Column] | None = None,
        observed: dict[str, Observation] | None = None,
        options: dict[str, str] | None = None,
        **facts: object,
    ) -> int:
        """Write the next snapshot and swap the pointer.

        ``touched`` names the partitions that ``rows`` replaces; ``None`` replaces all.
        ``run`` names the caller's step: writing the same step again changes nothing.
        ``buckets`` is remembered with the table if its partitions are numbered buckets, and so
        are further ``facts`` of the table. ``counts`` are aggregates of the rows, taken as they
        are written, and ``observed`` further ones that the caller attached to what the rows are
        made from; ``self.counts`` gives them back, also when the step is repeated.
        ``options`` go to the Parquet writer.
        """
        current = self.pointer(table) or {"version": 0, "paths": {}, "by": by, "runs": []}
        if run is not None and run in current["runs"]:
            return current["version"]
        version = current["version"] + 1
        base = f"{self.root}/{table}/v{version:08d}"
        seen = dict(observed or {})
        if counts:
            seen[""] = Observation()
            rows = rows.observe(seen[""], *[c.alias(name) for name, c in counts.items()])
        writer = rows.write.mode("overwrite").options(**(options or {}))
        (writer.partitionBy(by) if by else writer).parquet(base)
        if by:
            paths = {} if touched is None else {
                key: path for key, path in current["paths"].items() if key not in set(touched)
            }
            paths.update(self._partition_paths(base, by))
        else:
            paths = {"": base}
        runs = [*current["runs"], run][-REMEMBERED_RUNS:] if run else current["runs"]
        self._write_json(
            f"{self.root}/{table}/current.json",
            {
                "version": version, "paths": paths, "by": by, "runs": runs, "buckets": buckets or current.get("buckets"),
                "facts": {**current.get("facts", {}), **facts},
                "counts": {f"{prefix}{name}": n for prefix, o in seen.items() for name, n in o.get.items()},
            },
        )
        return version

    def counts(self, table: str) -> dict[str, int]:
        """The aggregates that were taken when the current snapshot was written."""
        return (self.pointer(table) or {}).get("counts", {})

    def fact(self, table: str, name: str):
        """What was remembered with the table under this name."""
        return (self.pointer(table) or {}).get("facts", {}).get(name)

    def _partition_paths(self, base: str, by: str) -> dict[str, str]:
        fs, target = self._fs(base)
        found = {}
        for status in fs.listStatus(target):
            name = status.getPath().getName()
            if name.startswith(f"{by}="):
                found[name.split("=", 1)[1]] = f"{base}/{name}"
        return found

    # -- the change cursor: two values, so it lives in the pointer file itself

    def cursor(self) -> dict:
        saved = self._read_json(f"{self.root}/cursor.json") or {}
        return {
            "last_changed": (saved.get("last_changed") or "").strip() or EPOCH,
            "last_uuid": saved.get("last_uuid") or "",
            "last_run_at": (saved.get("last_run_at") or "").strip() or EPOCH,
        }

    def save_cursor(self, **values: str | None) -> None:
        """Store the given values; blank ones keep what is there."""
        kept = {k: v for k, v in values.items() if v is not None and str(v).strip()}
        self._write_json(f"{self.root}/cursor.json", {**self.cursor(), **kept})

    def last_cleanup(self) -> str:
        return (self._read_json(f"{self.root}/cleanup.json") or {}).get("last_run_at") or EPOCH

    def save_cleanup(self, now: str) -> None:
        self._write_json(f"{self.root}/cleanup.json", {"last_run_at": now})


def _by_base(paths: dict[str, str]) -> dict[str, list[str]]:
    """Group partition folders under the version folder that holds them."""
    groups: dict[str, list[str]] = {}
    for key, path in sorted(paths.items()):
        base = path.rsplit("/", 1)[0] if key else path
        groups.setdefault(base, []).append(path)
    return groups


def bucket_of(c: Column, buckets: int) -> Column:
    """The partition of a key: a zero-padded bucket number as text."""
    width = len(str(buckets - 1))
    return F.lpad(F.pmod(F.xxhash64(c), F.lit(buckets)).cast("string"), width, "0")
