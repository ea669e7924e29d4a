"""CSV records over splits (line breaks in quotes) and files whose headers differ."""

import os
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeloom.functions.inference import infer_types
from lakeloom.functions.provenance import with_source_file
from lakeloom.sinks.targets import Target, dual_publish, publish_zone, read, write
from lakeloom.sources.csv import read_declared_csv, read_inferred_csv
from lakeloom.sources.records import QuoteRules, header_names, survey

SPEC = [("i", "bigint"), ("t", "string"), ("u", "string")]


def put(folder, name, text, encoding="utf-8"):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding=encoding, newline="") as fh:
        fh.write(text)


@pytest.fixture
def splits_of(spark):
    """Cut files into splits of so many bytes."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")

    def set_(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    yield set_
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


VALUES = st.one_of(st.none(), st.text(alphabet='",\n\r ab', min_size=1, max_size=12))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(VALUES, VALUES), min_size=1, max_size=40), st.sampled_from([16, 50, 300]))
def test_any_value_survives_any_split(spark, splits_of, tmp_path_factory, values, size):
    path = str(tmp_path_factory.mktemp("any") / "t")
    splits_of(1 << 20)
    df = spark.createDataFrame([(k, *v) for k, v in enumerate(values)], "i bigint, t string, u string").coalesce(1)
    write(df, Target.path(path, "csv"))
    splits_of(size)
    got = rows(read_declared_csv(spark, path, SPEC))
    assert got == Counter((k, *v) for k, v in enumerate(values))


def test_one_large_file_is_read_by_many_tasks(spark, splits_of, tmp):
    body = "".join(f'{k},"line {k}\nsecond, ""{"x" * (k % 50)}""\r\nthird",{"plain" if k % 2 else ""}\n' for k in range(3000))
    put(tmp, "big.csv", "a,b,c\n" + body)
    splits_of(8 << 10)
    df = read_declared_csv(spark, tmp, SPEC, source_file="src")
    assert df.select("i").rdd.getNumPartitions() > 8
    got = {r.i: r for r in df.collect()}
    assert len(got) == 3000 == df.count()
    for k in (0, 1, 1499, 2999):
        assert got[k].t == f'line {k}\nsecond, "{"x" * (k % 50)}"\r\nthird'
        assert got[k].u == ("plain" if k % 2 else None) and got[k].src == "big.csv"


def test_a_record_longer_than_many_splits(spark, splits_of, tmp):
    long = "no quote in here\n" * 400
    put(tmp, "a.csv", f'h1,h2,h3\n1,"{long}",x\n2,"{long}{long}",y\n3,z,"end\n"\n')
    put(tmp, "b.csv", "h1,h2,h3\n4,plain,\n" + "5,5,5\n" * 100)
    splits_of(500)
    got = Counter((r.i, r.t, r.u) for r in read_declared_csv(spark, tmp, SPEC).collect())
    assert got == Counter({(1, long, "x"): 1, (2, long * 2, "y"): 1, (3, "z", "end\n"): 1, (4, "plain", None): 1, (5, "5", "5"): 100})


ODD = ["5'11\" tall,a\"b,c", 'x "quoted" y,z,"w"', '"closed"tail,b,"c"', '"","",""', '"a""b",",",c', ' "blank before",b,c',
       '1,"only"",two",3', 'a"b,"c,d",e', '"a"b"c,d,e']


def test_quotes_outside_of_quoted_values_are_data(spark, tmp):
    put(f"{tmp}/odd", "a.csv", "x,y,z\n" + "\n".join(ODD) + "\n")
    put(f"{tmp}/odd", "b.csv", 'x,y,z\n1,"now\nhere",3\n')
    spec = [(n, "string") for n in "xyz"]
    plain = spark.read.options(header=True, quote='"', escape='"').schema("x string, y string, z string").csv(f"{tmp}/odd/a.csv")
    assert rows(read_declared_csv(spark, f"{tmp}/odd", spec)) == rows(plain) + Counter({("1", "now\nhere", "3"): 1})
    rules = QuoteRules(",")
    for line in ODD:
        assert not rules.ends_inside(line, False), line
    for line in ('"', 'a,"b', '"a"" ', ',,"x,""', 'a"b,"c'):
        assert rules.ends_inside(line, False), line
    for line, want in (("", True), ('""', True), ('"', False), ('x",y', False), ('x","y', True), ('x"",y', True), ('",a"b', False)):
        assert rules.ends_inside(line, True) is want, line
    rules.ends_inside('"' + '""' * 500_000 + "x" * 500_000, False)


def test_headers_blank_lines_endings_and_encodings(spark, tmp):
    put(f"{tmp}/a", "a.csv", '\r\n﻿'.replace("\r\n", "") + 'one,"two\nwords",three\r\n\r\n1,"é\n",x\r\n   \r\n2,,\r\n')
    put(f"{tmp}/a", "empty.csv", "")
    put(f"{tmp}/a", "header_only.csv", "one,two,three\n")
    assert rows(read_declared_csv(spark, f"{tmp}/a", SPEC)) == Counter({(1, "é\n", "x"): 1, (2, None, None): 1})
    put(f"{tmp}/l", "a.csv", 'a,b,c\n1,"ção\n2",x\n', "latin-1")
    assert rows(read_declared_csv(spark, f"{tmp}/l", SPEC, encoding="ISO-8859-1")) == Counter({(1, "ção\n2", "x"): 1})
    put(f"{tmp}/s", "a.csv", 'a;b;c\n1;"x;\ny, z";w\n')
    assert rows(read_declared_csv(spark, f"{tmp}/s", SPEC, sep=";")) == Counter({(1, "x;\ny, z", "w"): 1})
    with pytest.raises(ValueError):
        read_declared_csv(spark, f"{tmp}/s", SPEC, encoding="UTF-16")
    # a quote that never closes takes the rest of its file, not of others
    put(f"{tmp}/o", "a.csv", 'a,b,c\n1,"open,x\n2,y,z\n')
    put(f"{tmp}/o", "b.csv", 'a,b,c\n3,"p\nq",r\n')
    got = rows(read_declared_csv(spark, f"{tmp}/o", SPEC))
    assert got[(3, "p\nq", "r")] == 1 and sum(got.values()) == 2


def test_splits_that_changed_since_the_survey_fail(spark, splits_of, tmp):
    put(tmp, "a.csv", "a,b,c\n" + '1,"x\ny",z\n' * 500)
    splits_of(1000)
    df = read_declared_csv(spark, tmp, SPEC)
    assert df.count() == 500
    splits_of(700)
    with pytest.raises(Exception, match="read them again"):
        df.select("t").collect()


def test_provenance_is_asked_of_the_reader(spark, tmp):
    put(tmp, "RDSP2301.csv", 'a,b,c\n1,"x\ny",z\n')
    put(tmp, "RDRJ2302.csv", "a,b,c\n2,x,z\n")
    df = read_declared_csv(spark, tmp, SPEC, source_file="arquivo_origem")
    assert with_source_file(df) is df
    assert {(r.i, r.arquivo_origem) for r in df.collect()} == {(1, "RDSP2301.csv"), (2, "RDRJ2302.csv")}
    with pytest.raises(ValueError):
        with_source_file(read_declared_csv(spark, tmp, SPEC))


def test_publishing_keeps_line_breaks(spark, tmp):
    df = spark.createDataFrame([(1, 'a\n"b", c\r\n'), (2, None), (3, " x ")], "id bigint, t string")
    paths = publish_zone({"raw/t/": df}, tmp)
    assert rows(read_declared_csv(spark, paths["raw/t/"], [("id", "bigint"), ("t", "string")])) == rows(df)
    back = dual_publish(spark, df, Target.path(f"{tmp}/st", "csv"), Target.path(f"{tmp}/fact"))
    assert rows(back) == rows(df)
    assert rows(read(spark, Target.path(f"{tmp}/st", "csv"), df.schema)) == rows(df)
    parted = Target.path(f"{tmp}/p", "csv", partition_by=("k",))
    write(df.withColumn("k", F.lit(7)), parted)
    assert rows(read(spark, parted).select("id", "t")) == rows(df)


# ------------------------------------------------------------------- layouts

def test_columns_bind_by_name_across_layouts(spark, tmp):
    put(f"{tmp}/d", "a.csv", "ID,COD\n1,10\n2,20\n")
    put(f"{tmp}/d", "b.csv", "cod,id,extra\n30,3,\"x\ny\"\n")
    put(f"{tmp}/d", "c.csv", "id\n4\n")
    put(f"{tmp}/d", "d.csv", "cod,id\n")
    put(f"{tmp}/e", "a.csv", "A,b\n1,x\n")
    put(f"{tmp}/e", "b.csv", "a,B\n2,z\n")
    assert rows(read_inferred_csv(spark, f"{tmp}/e")) == Counter({(1, "x"): 1, (2, "z"): 1})
    df = read_inferred_csv(spark, f"{tmp}/d", source_file="src")
    assert dict(df.dtypes) == {"id": "int", "cod": "int", "extra": "string", "src": "string"}
    assert {(r.id, r.cod, r.extra, r.src) for r in df.collect()} == {
        (1, 10, None, "a.csv"), (2, 20, None, "a.csv"), (3, 30, "x\ny", "b.csv"), (4, None, None, "c.csv")}


def test_types_widen_over_all_files(spark, tmp):
    put(f"{tmp}/w", "a.csv", "i,l,b,d,t,m,f,z\n1,1,1,1,2024-01-02,2024-01-02,true,\n")
    put(f"{tmp}/w", "b.csv", "z,f,m,t,d,b,l,i\n,FALSE,x,2024-01-02 03:04:05,1.5,123456789012345678901,3000000000,-7\n")
    df = read_inferred_csv(spark, f"{tmp}/w")
    assert dict(df.dtypes) == {"i": "int", "l": "bigint", "b": "decimal(38,0)", "d": "double", "t": "timestamp",
                               "m": "string", "f": "boolean", "z": "string"}
    got = {r.i: r for r in df.collect()}
    assert int(got[-7].b) == 123456789012345678901 and got[1].t.hour == 0 and got[-7].t.hour == 3 and got[-7].f is False


@pytest.mark.parametrize("values, want", [
    ([], "string"), ([None], "string"), (["1", None], "int"), (["1", "2147483648"], "bigint"),
    (["1.0", "2147483648"], "double"), (["1", "99999999999999999999"], "decimal(38,0)"),
    (["1.5", "99999999999999999999"], "string"), (["9" * 60], "string"), (["2024-01-01"], "date"),
    (["2024-01-01", "2024-01-01T10:00:00"], "timestamp"), (["2024-13-01"], "string"), (["true", "1"], "string"),
    (["1e5"], "double"), (["NaN", "1"], "double"), (["x", "1"], "string")])
def test_least_type(spark, values, want):
    df = spark.createDataFrame([(v,) for v in values], "`a b` string")
    assert infer_types(df, ["a b"]) == [("a b", want)]


def test_header_names():
    assert header_names('A,"b\nc" ,,a') == ("a0", "b\nc", "_c2", "a3")
    assert header_names('x,"y,z"') == ("x", "y,z")


def test_one_layout_without_breaks_stays_with_the_plain_reader(spark, tmp):
    put(tmp, "a.csv", 'A,b\n1,"x, y"\n')
    put(tmp, "b.csv", "A,b\n2,z\n")
    found = survey(spark, tmp)
    assert found.layouts == [("a", "b")] and found.headers == 1 and not found.line_breaks and not found.crossing
    plan = read_inferred_csv(spark, tmp)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "csv" in plan.lower()
    assert rows(read_inferred_csv(spark, tmp)) == Counter({(1, "x, y"): 1, (2, "z"): 1})
