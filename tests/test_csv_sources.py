"""CSV scans: declared spec (A1, B9), inferred (A2), many files (A8), provenance (B1)."""

import os

from pyspark.sql import functions as F

from lakeloom.functions.coerce import apply_spec, lenient_cast
from lakeloom.functions.provenance import with_file_name_attrs, with_source_file
from lakeloom.sources.csv import read_declared_csv, read_inferred_csv
from lakeloom.spec import FACT_COLUMNS


def write(path, text):
    with open(path, "w", encoding="utf-8", newline="") as fh:
        fh.write(text)


def test_declared_binds_by_position_and_nulls_bad_values(spark, tmp):
    d = os.path.join(tmp, "sih")
    os.makedirs(d)
    write(os.path.join(d, "RDSP2301.csv"),
          "X,Y,Z,W\n1,\"Sao Paulo, SP\",2.5,a\nnot-a-number,plain,oops,b\n3,,,\n")
    write(os.path.join(d, "RDRJ2302.CSV"), "other,header,names,here\n4,rio,1e3,c,extra\n5\n")
    spec = [("code", "bigint"), ("name", "string"), ("val", "double"), ("tag", "string")]
    df = with_source_file(read_declared_csv(spark, d, spec))
    rows = sorted((tuple(r) for r in df.collect()), key=repr)
    assert df.columns == ["code", "name", "val", "tag", "arquivo_origem"]
    assert (1, "Sao Paulo, SP", 2.5, "a", "RDSP2301.csv") in rows      # quoted comma
    assert (None, "plain", None, "b", "RDSP2301.csv") in rows          # bad -> NULL, row kept
    assert (3, None, None, None, "RDSP2301.csv") in rows               # empty -> NULL
    assert (4, "rio", 1000.0, "c", "RDRJ2302.CSV") in rows             # extra field ignored
    assert (5, None, None, None, "RDRJ2302.CSV") in rows               # missing fields NULL
    assert len(rows) == 5                                              # headers consumed


def test_fact_spec_shape(spark, tmp):
    assert len(FACT_COLUMNS) == 113
    kinds = [t for _, t in FACT_COLUMNS]
    assert (kinds.count("bigint"), kinds.count("double"), kinds.count("string")) == (66, 19, 28)
    p = os.path.join(tmp, "f.csv")
    header = ",".join(n.upper() for n, _ in FACT_COLUMNS)
    write(p, header + "\n" + ",".join(["12"] * 113) + "\n")
    df = read_declared_csv(spark, p, FACT_COLUMNS)
    r = df.collect()[0]
    assert r.uf_zi == 12 and r.val_tot == 12.0 and r.n_aih == "12"


def test_inferred_lowercases_names(spark, tmp):
    p = os.path.join(tmp, "MUNICIPIOS.CSV")
    write(p, "ID,COD_IBGE,Municipio\n1,110001,Alta\n2,110002,Ariquemes\n")
    df = read_inferred_csv(spark, tmp)
    assert df.columns == ["id", "cod_ibge", "municipio"]
    assert dict(df.dtypes)["cod_ibge"] == "int"
    assert df.count() == 2


def test_lenient_cast_matches_try_cast(spark):
    vals = ["7", " 7 ", "+7", "7.5", "1e2", "x", "", None, "NaN", "1,5", "99999999999999999999"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    for t in ("bigint", "int", "double"):
        eq = df.select(lenient_cast("s", t).eqNullSafe(F.col("s").try_cast(t)).alias("e")).collect()
        assert all(r.e for r in eq), t


def test_apply_spec_missing_column_is_typed_null(spark):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    out = apply_spec(df, [("a", "bigint"), ("c", "double")])
    assert out.dtypes == [("a", "bigint"), ("c", "double")]
    assert tuple(out.collect()[0]) == (1, None)


def test_file_name_attrs(spark):
    df = spark.createDataFrame([("RDSP2301.csv",), ("RDAC9912.dbc",), ("junk.csv",), (None,)],
                               "arquivo_origem string")
    rows = {r.arquivo_origem: (r.uf, r.ano, r.mes) for r in with_file_name_attrs(df).collect()}
    assert rows["RDSP2301.csv"] == ("SP", 2023, 1)
    assert rows["RDAC9912.dbc"] == ("AC", 1999, 12)
    assert rows["junk.csv"] == (None, None, None)
