"""Every registered query against its DuckDB oracle on sf0.001 (the driver
checks sf0.01 the same way)."""

import duckdb
import pytest

import __spark_entry__ as E
from lakeloom.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def norm(v):
    return round(v, 6) if isinstance(v, float) else v


def canon(rows):
    return sorted((tuple(norm(x) for x in r) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = canon(df.select(*cols).collect())
    rel = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in rel.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    want = canon([tuple(r[i] for i in idx) for r in rel.fetchall()])
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "arquivo_origem" in df.columns
