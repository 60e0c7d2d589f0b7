import duckdb
import pytest

from oracle.check import rows_of
from tests.conftest import SF_SMALL
from tidemark.llm.catalog import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings", "pages"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_SMALL}/{table}.parquet'")
    cur = con.execute(ORACLES[name])
    columns = [d[0] for d in cur.description]
    df = QUERIES[name](spark, SF_SMALL)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, cur.fetchall())
