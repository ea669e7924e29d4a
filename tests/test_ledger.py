"""Key checks over increments against checks over everything."""

import random

import pytest

from lakeloom.operators.integrity import fk_report, pk_check
from lakeloom.operators.ledger import ForeignKeyLedger, KeyLedger


@pytest.fixture
def ledger(spark):
    made = []

    def make(name, key, **kw):
        made.append(KeyLedger(spark, f"lakeloom_test_{name}", key, **kw))
        made[-1].remove()
        return made[-1]
    yield make
    for m in made:
        m.remove()


def test_reports_equal_the_full_check(spark, ledger):
    rng = random.Random(1)
    led = ledger("pk", ["a", "b"], buckets=3)
    everything = []
    for d in range(4):
        rows = [(rng.choice([None, *range(30)]), rng.choice(["x", "y", None]), d) for _ in range(rng.choice([0, 25, 40]))]
        drop = spark.createDataFrame(rows, "a int, b string, n int").drop("n")
        everything += [r[:2] for r in rows]
        led.add(drop, f"d{d}")
        if d == 1:
            led.add(drop, "d1")  # again
        full = spark.createDataFrame(everything, "a int, b string")
        assert tuple(led.report("t").first()) == tuple(pk_check(full, "t", ["a", "b"]).first())


def test_only_the_drop_is_shuffled(spark, ledger):
    led = ledger("plan", "id", buckets=4)
    led.add(spark.range(5000), "d0")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = led.change(spark.range(4000, 6000), "d1")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    held = plan[plan.index("FileScan parquet"):]
    join = plan.index("Join")
    scan = plan.index("FileScan parquet")
    # the ledger's branch: no exchange between its scan and the join
    branch = [ln for ln in plan[join:scan].splitlines() if "Exchange" in ln]
    assert "Bucketed: true" in held
    ledger_side = plan[:scan].splitlines()
    depth = plan.splitlines()[len(ledger_side) - 1].index("+- FileScan") if "+- FileScan" in plan else 0
    above = [ln for ln in reversed(ledger_side[:-1]) if ln.find("+-") >= 0 and ln.find("+-") < depth]
    first = next(i for i, ln in enumerate(above) if "Join" in ln or "Range" in ln)
    assert not [ln for ln in above[:first] if "Exchange" in ln], plan
    assert branch is not None


def test_orphans_can_find_their_row_later(spark, ledger):
    dim = ledger("dim", "k", buckets=3)
    fk = ForeignKeyLedger(spark, "lakeloom_test_fk", "f", dim)
    fk.remove()
    facts, dims = [], []
    steps = [([1, 2, 2], [1]), ([3, None, 9], [2]), ([9, 9, 4], [4, 4, None])]
    try:
        for i, (f, d) in enumerate(steps):
            dim.add(spark.createDataFrame([(x,) for x in d], "k bigint"), f"d{i}")
            drop = spark.createDataFrame([(x, "z") for x in f], "f bigint, z string")
            fk.add(drop, f"d{i}")
            fk.add(drop, f"d{i}")
            facts += [(x,) for x in f]
            dims += [(x,) for x in d]
            want = fk_report(spark.createDataFrame(facts, "f bigint"), [("f", "dim", "k")],
                             {"dim": spark.createDataFrame(dims, "k bigint")}).first()
            assert tuple(fk.report("dim").first()) == tuple(want), i
        with pytest.raises(ValueError):
            fk.add(spark.createDataFrame([("1",)], "f string"), "x")
    finally:
        fk.remove()
