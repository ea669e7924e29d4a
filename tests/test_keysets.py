"""Foreign keys by bitmaps against the path by key and brute force."""

import random

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import keysets
from lakeloom.operators.integrity import fk_report, fk_report_by_key


def rows(df):
    return sorted(map(tuple, df.select("fk_column", "dim_table", "dim_key", "orphan_rows", "orphan_keys", "target_unique",
                                       "ok").collect()))


def brute(fact, edges, dims):
    out = []
    for fk, d, k in edges:
        have = [r[k] for r in dims[d]]
        lost = [r[fk] for r in fact if r[fk] is not None and r[fk] not in set(have)]
        out.append((fk, d, k, len(lost), len(set(lost)), None not in have and len(set(have)) == len(have), not lost))
    return sorted(out)


@pytest.mark.parametrize("held, merged", [(1 << 21, 1 << 21), (64, 1 << 16)])
def test_all_kinds_of_keys(spark, monkeypatch, held, merged):
    monkeypatch.setattr(keysets, "HELD_KEYS", held)
    monkeypatch.setattr(keysets, "MERGED_KEYS", merged)
    rng = random.Random(2)
    wide = [rng.randrange(-2**63, 2**63) for _ in range(300)] + [-2**63, 2**63 - 1, -1, 0, -32768, 32767]
    fact = [{"hot": rng.choice([7, 7, 7, 8, None]), "dense": rng.randrange(6000) - 100, "wide": rng.choice(wide),
             "again": rng.randrange(50)} for _ in range(4000)]
    dims = {"codes": [{"c": 7}, {"c": 9}], "dense": [{"k": i} for i in range(-50, 5000)], "wide": [{"w": w} for w in wide[5:]],
            "twice": [{"k": i % 40} for i in range(60)], "nulls": [{"k": None}, {"k": 3}], "none": []}
    edges = [("hot", "codes", "c"), ("dense", "dense", "k"), ("wide", "wide", "w"), ("again", "twice", "k"),
             ("dense", "nulls", "k"), ("again", "none", "k"), ("again", "dense", "k")]
    f = spark.createDataFrame([tuple(r.values()) for r in fact], "hot tinyint, dense int, wide bigint, again smallint").repartition(5)
    ds = {n: spark.createDataFrame([tuple(r.values()) for r in v], f"{'c' if n == 'codes' else 'w' if n == 'wide' else 'k'} bigint")
          for n, v in dims.items()}
    assert rows(fk_report(f, edges, ds)) == brute(fact, edges, dims) == rows(fk_report_by_key(f, edges, ds))


def test_mixed_text_missing_and_empty(spark):
    f = spark.createDataFrame([(1, "1"), (2, "x"), (None, None)], "a int, t string")
    ds = {"n": spark.createDataFrame([(1,)], "k bigint"), "s": spark.createDataFrame([("1",), ("x",)], "k string")}
    edges = [("a", "n", "k"), ("a", "s", "k"), ("t", "n", "k"), ("t", "s", "k"), ("a", "gone", "k")]
    assert rows(fk_report(f, edges, ds)) == rows(fk_report_by_key(f, edges, ds))
    assert rows(fk_report(f.limit(0), edges, ds)) == rows(fk_report_by_key(f.limit(0), edges, ds))
    assert fk_report(f, [], ds).collect() == []


def test_containers_are_few(spark):
    f = spark.range(200_000, numPartitions=4).select(F.col("id").alias("k"), (F.col("id") % 3).alias("c"))
    sets = keysets.containers(f, [(0, 0, "k"), (0, 1, "c")])
    got = sets.groupBy("col").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("keys")).alias("b")).collect()
    got = {r.col: (r.n, r.b) for r in got}
    # seven buckets of keys, touched by ten tasks' ranges; codes are six bytes a task
    assert got[0][0] <= 11 and got[0][1] <= 11 * 4096 and got[1] == (4, 24)
