"""Registered queries against their SQL, and the pipeline against its stages."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakeloom.llm import decontam
from lakeloom.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.conftest import SF
from tests.llm.test_exact import brute_fingerprint


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(llm, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    names = sorted(columns)
    at = [columns.index(n) for n in names]
    rows = [[r[k] for k in at] for r in want.fetchall()]
    df = QUERIES[name](llm, SF)
    assert sorted(df.columns) == names
    got = [list(r) for r in df.select(*names).collect()]

    def canon(x):
        return sorted([f"{v:.6f}" if isinstance(v, float) else str(v) for v in r] for r in x)
    assert canon(got) == canon(rows)


def test_pipeline_stages(llm, documents):
    docs = documents
    for name, stage in corpus_pipeline.STAGES:
        out = stage(llm, docs, SF).cache()
        if name != "mixing":
            assert out.columns == documents.columns
            assert out.subtract(docs).count() == 0 or name == "repeated_passages"
        if name == "near_duplicates":
            prints = [brute_fingerprint(r.text) for r in out.where("doc_id is not null").collect()]
            assert all(bin(a ^ b).count("1") > 4 for i, a in enumerate(prints) for b in prints[:i])
        if name == "decontamination":
            bench = llm.read.parquet(f"{SF}/benchmark.parquet")
            assert decontam.contaminated(out, bench).count() == 0
        if name == "mixing":
            assert out.where(F.col("taken") > 2 * F.col("size")).count() == 0
            assert out.where(F.col("taken") > 0).count() == out.count() > 0
        docs = out


def test_pipeline_run(llm):
    assert corpus_pipeline.run(llm, SF).count() > 0
