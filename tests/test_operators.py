"""Lookup (C1), star join (C6), manifest (C2, C4, C5, D2), integrity."""

import os

from pyspark.sql import functions as F

from lakeloom.functions.keys import key_prefix, normalised_key
from lakeloom.functions.text import parse_state_list
from lakeloom.operators.integrity import fk_report, pk_check, pk_report
from lakeloom.operators.lookup import lookup_enrich
from lakeloom.operators.manifest import (any_new_data, coverage_status, landed_as_raw,
                                         period_state_grid, should_load_fact, skip_landed)
from lakeloom.operators.sizing import is_small
from lakeloom.operators.star import StarEdge, star_join


def names(df):
    return [r.file_name for r in df.orderBy("seq").collect()]


# --- C1 -------------------------------------------------------------------

def test_lookup_never_multiplies_rows(spark):
    mun = spark.createDataFrame([(1, 110001), (2, 350010), (3, 990001), (4, None)],
                                "id int, cod_ibge int")
    uf = spark.createDataFrame([("11", "Rondônia"), (" 11 ", "Duplicate"), ("35", "São Paulo")],
                               "cod_ibge string, nome string")
    base = mun.withColumn("cod_ibge_uf", key_prefix("cod_ibge"))
    for max_rows in (10, 0, None):  # broadcast, shuffle join, planner's choice
        out = lookup_enrich(base, uf, F.col("cod_ibge_uf"), normalised_key(uf["cod_ibge"]),
                            uf["nome"], "uf", broadcast_max_rows=max_rows)
        rows = {r.id: r.uf for r in out.collect()}
        assert out.count() == 4
        assert rows == {1: "Duplicate", 2: "São Paulo", 3: None, 4: None}  # min of duplicates


def test_is_small(spark):
    df = spark.range(100)
    assert is_small(df, 100) and not is_small(df, 99)


# --- C6 -------------------------------------------------------------------

def test_star_join_roles(spark):
    fact = spark.createDataFrame([(1, 10, 20, "A1"), (2, 10, None, "Z9")],
                                 "id int, proc_solic bigint, proc_rea bigint, diag string")
    sigtap = spark.createDataFrame([(10, "ten"), (20, "twenty")], "ip_cod bigint, ip_name string")
    cid = spark.createDataFrame([("A1", "cholera")], "cid10 string, name string")
    out = star_join(fact, [StarEdge("proc_solic", sigtap, "ip_cod", "solic"),
                           StarEdge("proc_rea", sigtap, "ip_cod", "rea"),
                           StarEdge("diag", cid, "cid10", "dx", ("name",))])
    rows = {r.id: (r.solic_ip_name, r.rea_ip_name, r.dx_name) for r in out.collect()}
    assert rows == {1: ("ten", "twenty", "cholera"), 2: ("ten", None, None)}


# --- C4 / B12 ---------------------------------------------------------------

def test_grid_rollover_and_order(spark):
    g = period_state_grid(spark, "2023", "11", 2024, "2", " sp, ,rj")
    assert names(g) == ["RDSP2311.dbc", "RDRJ2311.dbc", "RDSP2312.dbc", "RDRJ2312.dbc",
                        "RDSP2401.dbc", "RDRJ2401.dbc", "RDSP2402.dbc", "RDRJ2402.dbc"]
    r = g.orderBy("seq").first()
    assert (r.seq, r.uf, r.ano, r.mes, r.aamm) == (0, "SP", 2023, 11, "2311")


def test_grid_edge_cases(spark):
    assert names(period_state_grid(spark, 2023, 1, 2023, 1, ["ac"])) == ["RDAC2301.dbc"]
    assert period_state_grid(spark, 2024, 1, 2023, 12, "SP").count() == 0   # start after end
    assert period_state_grid(spark, "x", 1, 2023, 12, "SP").count() == 0    # not a number
    assert period_state_grid(spark, 2023, 1, 2023, 2, " , ").count() == 0  # no states
    assert period_state_grid(spark, 2023, 1, 2023, 2, None).count() == 0


def test_parse_state_list(spark):
    df = spark.createDataFrame([(" sp, ,rj",), ("",), (None,)], "s string")
    assert [r.x for r in df.select(parse_state_list("s").alias("x")).collect()] == \
        [["SP", "RJ"], [], []]


# --- C2 / B11 / C5 / D2 -------------------------------------------------------

def test_skip_landed_maps_csv_to_dbc(spark):
    grid = period_state_grid(spark, 2023, 1, 2023, 2, "SP,RJ")
    landed = spark.createDataFrame([("RDSP2301.csv",), ("RDRJ2301.CSV",), ("RDSP2302.tmp",)],
                                   "file_name string")
    todo = skip_landed(grid, landed_as_raw(landed))
    assert sorted(r.file_name for r in todo.collect()) == ["RDRJ2302.dbc", "RDSP2302.dbc"]


def test_coverage_precedence_and_gate(spark):
    grid = period_state_grid(spark, 2023, 1, 2023, 1, "A,B,C,D")
    fn = lambda *xs: spark.createDataFrame([(x,) for x in xs], "file_name string")
    st = coverage_status(grid, fn("RDA2301.dbc"), fn("RDA2301.dbc", "RDB2301.dbc", "RDB2301.dbc"),
                         fn("RDA2301.dbc", "RDB2301.dbc", "RDC2301.dbc"))
    assert {r.uf: r.status for r in st.collect()} == \
        {"A": "ignored", "B": "exists", "C": "success", "D": "error"}
    assert st.count() == 4
    assert should_load_fact(st)
    assert any_new_data(st.filter("uf <> 'C'")).first().any_new_data is False


# --- D1 / C3 ------------------------------------------------------------------

def test_pk_check_constructed_violations(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "d"), (None, "e")], "k int, v string")
    r = pk_check(df, "t", "k").first()
    assert (r.n_rows, r.null_key_rows, r.duplicate_keys, r.duplicate_rows, r.ok) == (5, 1, 1, 3, False)
    clean = pk_report([("t", df.filter("k = 2"), ["k", "v"])]).first()
    assert clean.ok and clean.pk == "k,v"
    empty = pk_check(df.limit(0), "t", "k").first()
    assert (empty.n_rows, empty.ok) == (0, True)


def test_fk_report_constructed_orphans(spark):
    fact = spark.createDataFrame([(1, "A1"), (2, "A1"), (9, "B2"), (9, None), (None, "Z9")],
                                 "sexo bigint, diag string")
    dims = {"dim_sexo": spark.createDataFrame([(1,), (2,), (2,)], "cod bigint"),
            "dim_cid10": spark.createDataFrame([("A1",), ("B2",)], "cid10 string")}
    edges = [("sexo", "dim_sexo", "cod"), ("diag", "dim_cid10", "cid10"),
             ("sexo", "dim_missing", "cod")]
    rep = {r.fk_column + "/" + r.dim_table: r for r in fk_report(fact, edges, dims).collect()}
    s = rep["sexo/dim_sexo"]
    assert (s.orphan_rows, s.orphan_keys, s.target_unique, s.ok) == (2, 1, False, False)
    d = rep["diag/dim_cid10"]
    assert (d.orphan_rows, d.orphan_keys, d.target_unique, d.ok) == (1, 1, True, False)
    m = rep["sexo/dim_missing"]
    assert (m.orphan_rows, m.orphan_keys, m.target_unique) == (4, 3, None)


def test_fk_report_integer_code_against_text_key(spark):
    fact = spark.createDataFrame([(110001,), (110002,), (1,)], "uf_zi bigint")
    dim = spark.createDataFrame([("110001",), ("01",)], "cod_ibge string")
    r = fk_report(fact, [("uf_zi", "dim_m", "cod_ibge")], {"dim_m": dim}).first()
    # compared as text: 110002 and 1 ("1" is not "01") are orphans
    assert (r.orphan_rows, r.orphan_keys, r.target_unique) == (2, 2, True)


def test_star_join_rules_for_repeated_keys(spark):
    import pytest

    fact = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id int, k int")
    dim = spark.createDataFrame([(10, "b", 1), (10, "a", 2), (10, "a", 1), (20, None, 5), (None, "z", 9)], "k int, n string, m int")
    edge = [StarEdge("k", dim, "k", "d")]
    assert star_join(fact, edge).count() == 5
    got = {r.id: (r.d_n, r.d_m) for r in star_join(fact, edge, repeated="smallest").collect()}
    assert got == {1: ("a", 1), 2: (None, 5), 3: (None, None)}
    assert star_join(fact, edge, dedupe=True).count() == 3
    with pytest.raises(Exception, match="occurs more than once"):
        star_join(fact, edge, repeated="fail").collect()
    once = [StarEdge("k", dim.where("k = 20"), "k", "d", ("m",))]
    assert {r.id: r.d_m for r in star_join(fact, once, repeated="fail").collect()} == {1: None, 2: 5, 3: None}
    with pytest.raises(ValueError):
        star_join(fact, edge, repeated="any")


def test_contents_of_files(spark, tmp):
    import hashlib

    from lakeloom.operators.contents import (CONTENT_SCHEMA, coverage_status_by_content, file_contents, landed_contents,
                                             record_landed)

    data = {"a.csv": b"x" * 1000, "sub/b.csv": b"y" * 10, "c d.csv": bytes(range(256)) * 4}
    for name, content in data.items():
        os.makedirs(os.path.dirname(os.path.join(tmp, "in", name)), exist_ok=True)
        with open(os.path.join(tmp, "in", name), "wb") as fh:
            fh.write(content)

    def want(b, n):
        return hashlib.sha256("".join(hashlib.sha256(b[i:i + n]).hexdigest() for i in range(0, len(b), n)).encode()).hexdigest()
    got = {r.file_name: (r.length, r.digest) for r in file_contents(spark, f"{tmp}/in", chunk=300).collect()}
    assert got == {k.rsplit("/", 1)[-1]: (len(v), want(v, 300)) for k, v in data.items()}

    def frame(rows):
        return spark.createDataFrame(rows, CONTENT_SCHEMA)
    assert landed_contents(spark, f"{tmp}/ledger").count() == 0
    record_landed(spark, f"{tmp}/ledger", frame([("a", 1, "x"), ("b", 1, "x"), ("c", 1, "x"), ("i", 1, "x")]), "1")
    record_landed(spark, f"{tmp}/ledger", frame([("b", 1, "bad")]), "2")
    record_landed(spark, f"{tmp}/ledger", frame([("b", 2, "y")]), "2")  # again: replaced
    grid = spark.createDataFrame([(n,) for n in "abcdeifg"], "file_name string")
    arrived = frame([("a", 1, "x"), ("b", 2, "y"), ("c", 1, "z"), ("d", 3, "q"), ("i", 9, "n"), ("f", 1, "1"), ("f", 1, "2")])
    skip = spark.createDataFrame([("i",)], "file_name string")
    status = coverage_status_by_content(grid, skip, landed_contents(spark, f"{tmp}/ledger"), arrived)
    assert {r.file_name: r.status for r in status.collect()} == {
        "a": "exists", "b": "exists", "c": "changed", "d": "success", "e": "error", "i": "ignored", "f": "changed", "g": "error"}


def test_grid_of_state_rows(spark):
    import datetime as dt

    from lakeloom.operators.manifest import period_state_grid_rows

    period = spark.createDataFrame([(dt.date(2023, 11, 1), dt.date(2024, 1, 1))], "first date, last date")
    states = spark.createDataFrame([(" sp",), ("RJ ",), ("SP",), ("",), (None,), ("ac",)], "uf string")
    got = sorted(tuple(r) for r in period_state_grid_rows(period, states).collect())
    want = sorted(tuple(r) for r in period_state_grid(spark, 2023, 11, 2024, 1, "ac,rj,sp").collect())
    assert got == want and len(got) == 9
    assert period_state_grid_rows(period, states.limit(0)).count() == 0
