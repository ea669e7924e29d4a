"""Sinks (K2-K7), static dimensions (A7, L4), loads (L1-L3), landing stream."""

import os

from pyspark.sql import functions as F

from lakeloom.plans.loads import (load_dimension, load_fact, municipality_dimension,
                                  static_dimension_loads)
from lakeloom.sinks.targets import (Target, create_if_absent, dual_publish, jdbc_options,
                                    publish_zone, write, zone_folder)
from lakeloom.sources.catalog import register_external_table
from lakeloom.sources.files import list_files
from lakeloom.sources.static_dims import STATIC_DIMENSIONS, static_codes, static_dimensions
from lakeloom.streaming.landing import land_new_files


def test_static_dimensions(spark):
    dims = static_dimensions(spark)
    assert len(dims) == 12
    counts = {n: df.count() for n, df in dims.items()}
    assert sum(counts.values()) == 103
    assert counts["dim_cobranca"] == 28 and counts["dim_marca_uti"] == 14
    assert dims["dim_marca_uti"].columns == ["seq", "desc", "cod"]
    assert dims["dim_espec"].columns == ["cod", "espec"]
    assert static_codes(spark).count() == 103
    for name, _, pk, _ in STATIC_DIMENSIONS:
        assert dims[name].select(pk).distinct().count() == counts[name]


def test_create_if_absent_first_wins(spark, tmp):
    t = Target.path(os.path.join(tmp, "dim"))
    a = spark.createDataFrame([(1, "a")], "cod bigint, d string")
    b = spark.createDataFrame([(1, "b"), (2, "c")], "cod bigint, d string")
    assert create_if_absent(spark, t, lambda: a) is True
    assert create_if_absent(spark, t, lambda: b) is False
    assert [tuple(r) for r in spark.read.parquet(t.location).collect()] == [(1, "a")]
    tt = Target.table("lakeloom_test_cia")
    assert create_if_absent(spark, tt, lambda: a) and not create_if_absent(spark, tt, lambda: b)
    assert spark.table("lakeloom_test_cia").count() == 1


def test_csv_sink_and_zone(spark, tmp):
    df = spark.createDataFrame([(1, None, "x,y")], "a int, b string, c string")
    paths = publish_zone({"raw/sih/": df}, tmp)
    assert paths == {"raw/sih/": os.path.join(tmp, "sih")}
    assert zone_folder("raw/ibge-municipios/") == "ibge-municipios"
    assert zone_folder("draw/x") == "draw/x" and zone_folder("a/raw/b") == "a/raw/b"
    files = [open(os.path.join(paths["raw/sih/"], f)).read().splitlines()
             for f in sorted(os.listdir(paths["raw/sih/"])) if f.endswith(".csv")]
    assert all(f[0] == "a,b,c" for f in files)            # header in every file
    assert [ln for f in files for ln in f[1:]] == ['1,,"x,y"']  # NULL -> empty, minimal quoting
    assert {r.file_name for r in list_files(spark, paths["raw/sih/"], "*.csv").collect()} \
        == {f for f in os.listdir(paths["raw/sih/"]) if f.endswith(".csv")}
    assert list_files(spark, os.path.join(tmp, "missing")).count() == 0


def test_dual_publish_and_register(spark, tmp):
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    out = dual_publish(spark, df, Target.path(os.path.join(tmp, "st")), Target.path(os.path.join(tmp, "fat")))
    assert out.count() == 10 and spark.read.parquet(os.path.join(tmp, "st")).count() == 10
    loc = os.path.join(tmp, "tbl")
    write(df.filter("id < 5"), Target.path(loc, "csv"))
    write(df.filter("id >= 5"), Target.path(loc, "csv"), mode="append")
    t = register_external_table(spark, "lakeloom_test_ext", loc, [("id", "bigint"), ("v", "bigint")])
    assert t.count() == 10
    t2 = register_external_table(spark, "lakeloom_test_ext", loc, [("x", "string"), ("y", "string")],
                                 replace=True)
    assert t2.columns == ["x", "y"] and t2.count() == 10   # data kept, columns replaced


def test_jdbc_options():
    o = jdbc_options("jdbc:postgresql://h/db", "fat_sih", "u", "p", "org.postgresql.Driver",
                     url_params={"reWriteBatchedInserts": "true"})
    assert o["url"] == "jdbc:postgresql://h/db?reWriteBatchedInserts=true"
    assert (o["batchsize"], o["numPartitions"], o["dbtable"]) == ("50000", "4", "fat_sih")
    o2 = jdbc_options("jdbc:postgresql://h/db?ssl=true", "t", url_params={"a": "b"})
    assert o2["url"].endswith("?ssl=true&a=b")


def test_load_dimension_actions(spark, tmp):
    t = Target.path(os.path.join(tmp, "dim_x"))
    src = spark.createDataFrame([(1, "a"), (1, "b")], "cod bigint, d string")
    r = load_dimension(spark, lambda: src, t, "dim_x", "cod").first()
    assert (r.action, r.n_rows, r.duplicate_keys, r.ok) == ("written", 2, 1, False)
    assert load_dimension(spark, lambda: src, t, "dim_x", "cod").first().action == "exists"
    empty = load_dimension(spark, lambda: src.limit(0), Target.path(os.path.join(tmp, "e")), "e", "cod")
    assert empty.first().action == "empty"


def test_static_dimension_loads(spark, tmp):
    rep = static_dimension_loads(spark, lambda n: Target.path(os.path.join(tmp, n)))
    rows = rep.collect()
    assert len(rows) == 12 and all(r.action == "written" and r.ok for r in rows)
    again = static_dimension_loads(spark, lambda n: Target.path(os.path.join(tmp, n))).collect()
    assert all(r.action == "exists" for r in again)


def test_municipality_dimension(spark):
    mun = spark.createDataFrame([(1, 110001, "Alta"), (2, 990001, "Nowhere")],
                                "id int, cod_ibge int, municipio string")
    uf = spark.createDataFrame([(11, 11, "Rondônia")], "id int, cod_ibge int, nome string")
    rows = {r.id: (r.cod_ibge_uf, r.uf) for r in municipality_dimension(mun, uf).collect()}
    assert rows == {1: ("11", "Rondônia"), 2: ("99", None)}


def test_load_fact_reports_orphans(spark, tmp):
    d = os.path.join(tmp, "raw")
    os.makedirs(d)
    with open(os.path.join(d, "RDSP2301.csv"), "w") as fh:
        fh.write("sexo,espec\n1,1\n3,99\n7,\n")
    scan = spark.read.option("header", True).schema("sexo bigint, espec bigint").csv(d)
    dims = static_dimensions(spark)
    rep = load_fact(spark, scan, Target.path(os.path.join(tmp, "st")), Target.path(os.path.join(tmp, "fat")),
                    dims, edges=[("sexo", "dim_sexo", "cod"), ("espec", "dim_espec", "cod")])
    got = {r.fk_column: (r.orphan_rows, r.ok) for r in rep.collect()}
    assert got == {"sexo": (1, False), "espec": (1, False)}
    fat = spark.read.parquet(os.path.join(tmp, "fat"))
    assert {r.arquivo_origem for r in fat.collect()} == {"RDSP2301.csv"}


def test_landing_takes_each_file_once(spark, tmp):
    raw, out, ck = (os.path.join(tmp, x) for x in ("raw", "out", "ck"))
    os.makedirs(raw)
    spec = [("a", "bigint"), ("b", "string")]
    with open(os.path.join(raw, "RDSP2301.csv"), "w") as fh:
        fh.write("a,b\n1,x\nbad,y\n")
    assert land_new_files(spark, raw, spec, out, ck) == 2
    assert land_new_files(spark, raw, spec, out, ck) == 0
    with open(os.path.join(raw, "RDSP2302.CSV"), "w") as fh:
        fh.write("a,b\n3,z\n")
    assert land_new_files(spark, raw, spec, out, ck) == 1
    rows = sorted(((r.a, r.b, r.arquivo_origem) for r in spark.read.parquet(out).collect()), key=repr)
    assert rows == sorted([(1, "x", "RDSP2301.csv"), (None, "y", "RDSP2301.csv"), (3, "z", "RDSP2302.CSV")],
                          key=repr)


def test_partitioned_external_table_prunes(spark, tmp):
    import contextlib
    import io
    loc = os.path.join(tmp, "part_tbl")
    df = spark.createDataFrame([(1, "SP"), (2, "SP"), (3, "RJ")], "id bigint, uf string")
    write(df, Target.path(loc, "csv", partition_by=("uf",)))
    t = register_external_table(spark, "lakeloom_test_part", loc, [("id", "bigint"), ("uf", "string")],
                                partition_by=["uf"])
    sp = t.filter("uf = 'SP'")
    assert sorted(r.id for r in sp.collect()) == [1, 2]
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        sp.explain()
    assert "PartitionFilters: [isnotnull(uf" in buf.getvalue()


def test_fact_partitioned_by_file_period(spark, tmp):
    d = os.path.join(tmp, "raw")
    os.makedirs(d)
    for name, body in (("RDSP2301.csv", "sexo\n1\n3\n"), ("RDRJ2302.csv", "sexo\n1\n")):
        with open(os.path.join(d, name), "w") as fh:
            fh.write(body)
    scan = spark.read.option("header", True).schema("sexo bigint").csv(d)
    fat = Target.path(os.path.join(tmp, "fat"), partition_by=("uf", "ano", "mes"))
    load_fact(spark, scan, Target.path(os.path.join(tmp, "st")), fat,
              static_dimensions(spark), edges=[("sexo", "dim_sexo", "cod")])
    assert sorted(os.listdir(os.path.join(tmp, "fat", "uf=SP"))) == ["ano=2023"]
    back = spark.read.parquet(os.path.join(tmp, "fat"))
    assert sorted((r.uf, r.ano, r.mes, r.sexo) for r in back.collect()) == \
        [("RJ", 2023, 2, 1), ("SP", 2023, 1, 1), ("SP", 2023, 1, 3)]
