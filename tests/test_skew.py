"""A key holding a third of the rows: joins are split by AQE, reports
aggregate map-side before the shuffle, results stay whole."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from lakeloom.operators.integrity import fk_report, fk_report_by_key, pk_check
from lakeloom.operators.lookup import lookup_enrich
from lakeloom.operators.star import StarEdge, star_join

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skew_session(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def final_plan(df) -> tuple[list, str]:
    rows = df.collect()  # runs the frame's own adaptive plan
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return rows, buf.getvalue()


def hot_fact(spark, n=60000):
    # every third row carries code 7
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("code"), "id")


def code_dim(spark, n=60000):
    return spark.range(n).select(F.col("id").alias("cod"),
                                 F.concat(F.lit("d"), F.col("id").cast("string")).alias("descr"))


def test_lookup_hot_key_is_split(skew_session):
    spark = skew_session
    out = lookup_enrich(hot_fact(spark), code_dim(spark), F.col("code"), F.col("cod"),
                        F.col("descr"), "descr")
    rows, plan = final_plan(out)
    assert "skew=true" in plan
    assert len(rows) == 60000
    assert sum(1 for r in rows if r.descr == "d7") == 20000 + 1  # the hot key, and id 7 itself


def test_star_join_hot_key_is_split(skew_session):
    spark = skew_session
    out = star_join(hot_fact(spark), [StarEdge("code", code_dim(spark), "cod", "d")])
    rows, plan = final_plan(out)
    assert "skew=true" in plan
    assert len(rows) == 60000 and all(r.d_descr == f"d{r.code}" for r in rows)


def test_reports_aggregate_before_shuffle(spark):
    fact = hot_fact(spark)
    dims = {"dim": code_dim(spark)}
    rep = fk_report_by_key(fact, [("code", "dim", "cod")], dims)  # keys of any type; integers go by bitmaps
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        rep.explain()
    plan = buf.getvalue()
    # the exploded (edge, key) pairs are counted map-side before any exchange:
    # the first operator above the explode (past projections/filters) is the
    # partial aggregate
    lines = plan.splitlines()
    gen = next(i for i, ln in enumerate(lines) if "Generate explode" in ln)
    above = [ln for ln in reversed(lines[:gen]) if "Project" not in ln and "Filter" not in ln]
    assert "HashAggregate" in above[0] and "partial_count" in above[0]
    assert rep.first().ok
    pk = pk_check(fact, "fact", "code").first()
    assert (pk.duplicate_keys, pk.duplicate_rows) == (1, 20001)
