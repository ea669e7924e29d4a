"""Inputs that used to lose or change rows without an error."""

import gzip
import os
import struct

import pytest
from pyspark.sql import types as T

from lakeloom.functions.coerce import jdbc_safe
from lakeloom.functions.provenance import file_name_attrs
from lakeloom.plans.queries import static_dim_lookup
from lakeloom.sinks.targets import Target, create_if_absent, dual_publish, read, write
from lakeloom.sources.catalog import register_external_table
from lakeloom.sources.csv import read_declared_csv
from lakeloom.sources.dbf import dbf_fields, encode_dbf, read_dbf
from lakeloom.sources.fixed_width import MUNICIPALITY_LAYOUT, read_fixed_width
from lakeloom.sources.literal import literal_table
from lakeloom.streaming.landing import land_new_files

SPEC = [("id", "bigint"), ("name", "string")]
TEXTS = ['say "hi", ok', "  two leading", "trailing  ", "a,b", '"', "plain", None]


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_landing_takes_backdated_files(spark, tmp):
    put(f"{tmp}/raw/a.csv", "id,name\n1,x\n2,y\n")
    assert land_new_files(spark, f"{tmp}/raw", SPEC, f"{tmp}/out", f"{tmp}/ck") == 2
    put(f"{tmp}/raw/old.csv", "id,name\n3,z\n")
    os.utime(f"{tmp}/raw/old.csv", (1_000_000_000, 1_000_000_000))
    assert land_new_files(spark, f"{tmp}/raw", SPEC, f"{tmp}/out", f"{tmp}/ck") == 1
    assert sorted(r.id for r in spark.read.parquet(f"{tmp}/out").collect()) == [1, 2, 3]


def test_landing_counts_every_batch(spark, tmp):
    for i in range(8):
        put(f"{tmp}/raw/f{i}.csv", f"id,name\n{i},x\n{i + 100},y\n")
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        assert land_new_files(spark, f"{tmp}/raw", SPEC, f"{tmp}/out", f"{tmp}/ck",
                              max_files_per_trigger=1) == 16
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)


def test_every_file_of_a_folder_is_read(spark, tmp):
    put(f"{tmp}/z/a.csv", "id,name\n1,x\n")
    put(f"{tmp}/z/b.Csv", "id,name\n2,x\n")
    with gzip.open(f"{tmp}/z/c.csv.gz", "wt") as f:
        f.write("id,name\n3,x\n")
    assert sorted(r.id for r in read_declared_csv(spark, f"{tmp}/z", SPEC).collect()) == [1, 2, 3]


def test_csv_keeps_quotes_and_blanks(spark, tmp):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id bigint, name string")
    write(df, Target.path(f"{tmp}/csv", "csv"))
    want = sorted(map(tuple, df.collect()))
    for got in (read_declared_csv(spark, f"{tmp}/csv", SPEC),
                read(spark, Target.path(f"{tmp}/csv", "csv"), df.schema),
                register_external_table(spark, "quotes_and_blanks", f"{tmp}/csv", SPEC)):
        assert sorted(map(tuple, got.collect())) == want
    spark.sql("DROP TABLE quotes_and_blanks")


def test_staging_as_csv_keeps_zeros(spark, tmp):
    df = spark.createDataFrame([("01310", 'a "b", c', 1), ("0012345", "x", 2)], "cep string, t string, n bigint")
    out = dual_publish(spark, df, Target.path(f"{tmp}/st", "csv"), Target.path(f"{tmp}/fact"))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, df.collect()))


def test_half_written_folder_is_not_a_loaded_table(spark, tmp):
    os.makedirs(f"{tmp}/dim/_temporary/0")
    target = Target.path(f"{tmp}/dim")
    assert create_if_absent(spark, target, lambda: spark.range(3)) is True
    # Spark's "ignore" mode must not have skipped the write either
    assert create_if_absent(spark, target, lambda: spark.range(9)) is False
    assert spark.read.parquet(f"{tmp}/dim").count() == 3


def test_stale_record_count_of_a_dbf(spark, tmp):
    data = bytearray(encode_dbf([(1, "a"), (2, "b"), (3, "c")],
                                dbf_fields([("k", "N", 5, 0), ("v", "C", 4, 0)])))
    data[4:8] = struct.pack("<I", 1)
    os.makedirs(f"{tmp}/d")
    with open(f"{tmp}/d/t.dbf", "wb") as f:
        f.write(bytes(data))
    assert read_dbf(spark, f"{tmp}/d").count() == 3


def test_corrupt_fixed_width_file_fails(spark, tmp):
    lines = "".join(f"{i:>7}  {i:>6} {'name':<43}\n" for i in range(4000)).encode()
    packed = gzip.compress(lines)
    os.makedirs(f"{tmp}/f")
    with open(f"{tmp}/f/a.cnv.gz", "wb") as f:
        f.write(packed[:len(packed) // 2])
    with pytest.raises(Exception):
        read_fixed_width(spark, f"{tmp}/f", MUNICIPALITY_LAYOUT).count()
    assert read_fixed_width(spark, f"{tmp}/f", MUNICIPALITY_LAYOUT, ignore_corrupt=True).count() < 4000


def test_file_name_attributes_are_strict(spark):
    names = ["RDSP2301.csv", "RDSP12302301.csv", "RDSP2399.csv", "RDSP2300.csv", "RDsp2301.csv"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = df.select("n", *[c.alias(k) for k, c in file_name_attrs("n").items()]).collect()
    assert [tuple(r)[1:] for r in got] == [("SP", 2023, 1)] + [(None, None, None)] * 4


def test_literal_lookup_does_not_move_the_fact(spark):
    plan = static_dim_lookup(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "hashpartitioning(l_" not in plan


def test_literal_table_types(spark):
    df = literal_table(spark, [(1, "a", None), (2, None, 0.5)], "k bigint, s string, d double")
    assert [f.dataType for f in df.schema] == [T.LongType(), T.StringType(), T.DoubleType()]
    assert [tuple(r) for r in df.collect()] == [(1, "a", None), (2, None, 0.5)]
    assert literal_table(spark, [], "k bigint").collect() == []


def test_jdbc_safe_by_type_family(spark):
    df = spark.sql("SELECT 1 a, 'x' b, array(1) c, map('k', 1) d, struct(1 AS z) e, null f, "
                   "DATE'2020-01-01' g, 1.5BD h, true i, X'00' j")
    out = jdbc_safe(df)
    assert out.columns == df.columns
    assert {f.name for f in out.schema if f.dataType != df.schema[f.name].dataType} == {"c", "d", "e"}
    assert jdbc_safe(df.drop("c", "d", "e")).schema == df.drop("c", "d", "e").schema
