import public_tokenizers as P

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tests.conftest import SF_SMALL
from tests.llm.cases import empty, shingles
from tests.llm.test_jaccard import brute as groups
from tests.llm.test_pii import brute as spans
from tests.llm.test_tokens import reference


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    items = [s for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect() if (s := shingles(r.text))]
    kept = {d: t for d, t in texts.items() if any(c.isalpha() for c in t or "")}
    kept = {d: kept[d] for d, _, c in groups(list(kept.items())) if d == c}
    kept = {d: t for d, t in kept.items() if not any(10 * len(s & shingles(t)) >= 8 * len(s) for s in items)}
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert set(found) == set(kept)
    lib = reference()
    for d, r in found.items():
        assert len(lib.encode_ordinary(r.text)) == r.n_tokens
        assert not spans(r.text)
        if not any(c.isdigit() for c in kept[d]) and "@" not in kept[d]:
            assert r.text == kept[d]


def test_stages_take_empty_tables_and_return_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs.limit(0), SF_SMALL)
        assert out.count() == 0
        assert name == "byte_bpe" or out.schema.names == docs.schema.names


def test_registered(spark):
    names = set(queries())
    assert {f"op{n}" for n in range(1, 14)} <= {n.split("_")[0] for n in names} and "pipeline" in names
    assert "op3_benchmark_decontamination" in oracle_sql() and "pipeline" not in oracle_sql()
    assert P.PATTERN and empty(spark).count() == 0
