"""Publishing that survives broken and concurrent loads; column replacement."""

import os
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from lakeloom import hadoop
from lakeloom.sinks.targets import Target, _jdbc_table_exists, create_if_absent, exists, read, write
from lakeloom.sinks.versions import current_folder, read_version, versions
from lakeloom.sources.catalog import partition_columns, register_external_table, replace_columns


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def broken(df):
    return df.withColumn("id", F.when(F.col("id") == 7, F.raise_error(F.lit("bad row")).cast("bigint")).otherwise(F.col("id")))


def test_a_failed_refresh_leaves_the_old_version(spark, tmp):
    t = Target.path(f"{tmp}/t", versioned=True)
    assert not exists(spark, t)
    write(spark.range(5), t)
    held = read(spark, t)
    with pytest.raises(Exception, match="bad row"):
        write(broken(spark.range(20)), t)
    assert ids(read(spark, t)) == ids(held) == list(range(5)) and versions(spark, f"{tmp}/t") == [1]
    assert [n for n in os.listdir(f"{tmp}/t") if n.startswith("load-")] == [current_folder(spark, f"{tmp}/t").rsplit("/", 1)[1]]
    write(spark.range(3), t)
    # a reader of the old version is not disturbed by the next one
    assert ids(held) == list(range(5)) and ids(read(spark, t)) == [0, 1, 2]
    write(spark.range(2), t)
    assert versions(spark, f"{tmp}/t") == [2, 3] and ids(read_version(spark, f"{tmp}/t", 2)) == [0, 1, 2]
    with pytest.raises(FileNotFoundError):
        read_version(spark, f"{tmp}/t", 1)
    with pytest.raises(ValueError):
        write(spark.range(1), t, mode="append")


def test_concurrent_refreshes_each_become_a_version(spark, tmp):
    t = Target.path(f"{tmp}/t", versioned=True)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: write(spark.range(k + 1), t), range(4)))
    assert versions(spark, f"{tmp}/t")[-1] == 4 and ids(read(spark, t)) in [list(range(k + 1)) for k in range(4)]


@pytest.mark.parametrize("versioned", [False, True])
def test_one_of_many_loaders_wins(spark, tmp, versioned):
    t = Target.path(f"{tmp}/t", versioned=versioned)
    gate = threading.Barrier(4)

    def load(k):
        def build():
            gate.wait(60)
            return spark.range(10 * k, 10 * k + 10)
        return create_if_absent(spark, t, build)

    with ThreadPoolExecutor(4) as pool:
        won = list(pool.map(load, range(4)))
    assert sum(won) == 1
    k = won.index(True)
    assert ids(read(spark, t)) == list(range(10 * k, 10 * k + 10))
    assert not create_if_absent(spark, t, lambda: spark.range(1))
    assert not [n for n in os.listdir(tmp) if ".load-" in n or ".repair-" in n]


def test_unfinished_folders_do_not_count(spark, tmp):
    place = f"{tmp}/t"
    spark.range(100).write.parquet(place)
    os.remove(f"{place}/_SUCCESS")
    t = Target.path(place)
    assert not exists(spark, t)
    gate = threading.Barrier(2)

    def build():
        gate.wait(60)
        return spark.range(4)

    with ThreadPoolExecutor(2) as pool:
        won = list(pool.map(lambda _: create_if_absent(spark, t, build), range(2)))
    assert sorted(won) == [False, True] and ids(read(spark, t)) == [0, 1, 2, 3]
    aside = [n for n in os.listdir(tmp) if ".unfinished-" in n]
    assert len(aside) == 1 and spark.read.parquet(f"{tmp}/{aside[0]}").count() == 100
    # a partitioned folder is judged by its marker alone
    p = Target.path(f"{tmp}/p", partition_by=("id",))
    write(spark.range(3).withColumn("x", F.lit(1)), p)
    assert exists(spark, p)
    with pytest.raises(Exception, match="bad row"):
        create_if_absent(spark, Target.path(f"{tmp}/q"), lambda: broken(spark.range(9)))
    assert not os.path.exists(f"{tmp}/q") and not [n for n in os.listdir(tmp) if ".load-" in n]


def test_claims_and_moves(spark, tmp):
    assert hadoop.claim(spark, f"{tmp}/d/x", "one") and not hadoop.claim(spark, f"{tmp}/d/x", "two")
    assert hadoop.read_text(spark, f"file:{tmp}/d/x") == "one" and hadoop.names(spark, f"{tmp}/d") == ["x"]
    assert hadoop.claim(spark, f"{tmp}/d/y", "y") and not hadoop.move_new(spark, f"{tmp}/d/y", f"{tmp}/d/x")
    assert hadoop.move_new(spark, f"{tmp}/d/y", f"{tmp}/d/z") and hadoop.names(spark, f"{tmp}/nowhere") == []
    with ThreadPoolExecutor(8) as pool:
        assert sum(pool.map(lambda k: hadoop.claim(spark, f"{tmp}/race", str(k)), range(8))) == 1


def test_a_database_that_cannot_be_reached_is_an_error(spark):
    with pytest.raises(Exception):
        _jdbc_table_exists(spark, Target.jdbc("t", "jdbc:nothing://nowhere/db"))


def test_columns_of_a_partitioned_table_are_replaced(spark, tmp):
    name = "lakeloom_test_replace"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df = spark.createDataFrame([("1", "2.5", "SP"), ("x", "3", "RJ")], "a string, b string, uf string")
    write(df, Target.path(f"{tmp}/t", "csv", partition_by=("uf",)))
    register_external_table(spark, name, f"{tmp}/t", [("a", "string"), ("b", "string"), ("uf", "string")], partition_by=["uf"])
    t = replace_columns(spark, name, [("code", "bigint"), ("amount", "double")])
    assert t.dtypes == [("code", "bigint"), ("amount", "double"), ("uf", "string")]
    assert partition_columns(spark, name) == ["uf"]
    assert sorted(((r.code, r.amount, r.uf) for r in t.collect()), key=str) == [(1, 2.5, "SP"), (None, 3.0, "RJ")]
    again = register_external_table(spark, name, f"{tmp}/t", [("a", "string"), ("uf", "string")], replace=True)
    assert again.columns == ["a", "uf"] and again.where("uf = 'SP'").first().a == "1"
    for bad in ([("uf", "string")], [("a", "string"), ("uf", "int")], [("a", "string"), ("A", "string")]):
        with pytest.raises(ValueError):
            replace_columns(spark, name, bad)
    for kw in ({"fmt": "parquet"}, {"partition_by": ["a"]}, {"options": {"sep": ";"}}):
        with pytest.raises(ValueError, match="drop it first"):
            register_external_table(spark, name, f"{tmp}/t", [("a", "string")], replace=True, **kw)
    # another location: its partitions are found there
    write(df.withColumn("uf", F.lit("AC")), Target.path(f"{tmp}/u", "csv", partition_by=("uf",)))
    moved = register_external_table(spark, name, f"{tmp}/u", [("a", "string"), ("b", "string")], replace=True)
    assert {r.uf for r in moved.collect()} >= {"AC"}
    spark.sql(f"DROP TABLE {name}")


def test_copies_are_compared_row_by_row(spark):
    from lakeloom.operators.integrity import compare_copies

    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (None, "2")], "i int, t string")
    assert tuple(compare_copies(a, a.select("t", "i").repartition(3)).first()) == (4, 4, 0, True)
    b = spark.createDataFrame([(1, "x"), (2, None), (None, "2"), (2, "")], "i int, t string")
    assert tuple(compare_copies(a, b).first()) == (4, 4, 2, False)
    assert tuple(compare_copies(a.limit(0), a.limit(0)).first()) == (0, 0, 0, True)
    with pytest.raises(ValueError):
        compare_copies(a, b.withColumn("z", F.lit(1)))
