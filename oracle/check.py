"""Run registered queries and their oracle SQL side by side: ``python -m oracle.check [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from tidemark.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations").split()


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def norm(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return ""
        if isinstance(v, float):
            return f"{v:.6f}"
        return str(v)

    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def check(spark, sf_dir: str, names: list[str] | None = None) -> list[str]:
    from oracle.sql import ORACLES
    from tidemark.plans.catalog import QUERIES

    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    bad = []
    for name in names or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            got = [tuple(r) for r in df.collect()]
        except Exception as error:  # report and go on
            bad.append(name)
            print(f"FAIL {name}: spark: {str(error)[:600]}")
            continue
        spent = time.time() - start
        if name not in ORACLES:
            print(f"rows {name}: {len(got)} rows {spent:.1f}s")
            continue
        try:
            cur = con.execute(ORACLES[name])
            cols = [d[0] for d in cur.description]
            want = cur.fetchall()
        except Exception as error:
            bad.append(name)
            print(f"FAIL {name}: oracle: {str(error)[:600]}")
            continue
        left, right = rows_of(df.columns, got), rows_of(cols, want)
        if sorted(df.columns) != sorted(cols) or left != right:
            bad.append(name)
            print(f"DIFF {name}: {len(left)} vs {len(right)} rows, {sorted(df.columns)} vs {sorted(cols)}")
            for a, b in list((a, b) for a, b in zip(left, right) if a != b)[:2]:
                print("   spark ", tuple(x[:150] for x in a))
                print("   oracle", tuple(x[:150] for x in b))
        else:
            print(f"ok   {name}: {len(left)} rows {spent:.1f}s")
    return bad


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = build_session(
        "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
                       "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("OFF")
    failed = check(session, folder, sys.argv[2:])
    print("failed:", failed)
    sys.exit(bool(failed))
