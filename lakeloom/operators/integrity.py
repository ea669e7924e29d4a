"""Key integrity reports: primary keys (D1) and foreign keys.

Both return small report tables instead of failing the load: a violation is
data to look at, and the load continues.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators.keysets import containers, orphan_keys
from lakeloom.session import scratch_path

PK_REPORT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("pk", T.StringType(), False),
    T.StructField("n_rows", T.LongType(), False),
    T.StructField("null_key_rows", T.LongType(), False),
    T.StructField("duplicate_keys", T.LongType(), False),
    T.StructField("duplicate_rows", T.LongType(), False),
    T.StructField("ok", T.BooleanType(), False),
])


def pk_check(df: DataFrame, table_name: str, pk: Sequence[str] | str) -> DataFrame:
    """One report row: is ``pk`` unique and never NULL in ``df``?

    One aggregation on the key (partial aggregation before the shuffle, so a
    hot key collapses map-side), then a global fold of the per-key counts.
    ``duplicate_rows`` counts every row of a repeated key.
    """
    keys = [pk] if isinstance(pk, str) else list(pk)
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(f"`{k}`").isNull()
    per_key = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("__n"))
    per_key = per_key.select(any_null.alias("__null"), "__n")
    zero = F.lit(0).cast("bigint")
    dup = (~F.col("__null")) & (F.col("__n") > 1)
    rep = per_key.agg(
        F.coalesce(F.sum("__n"), zero).alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("__null"), F.col("__n"))), zero).alias("null_key_rows"),
        F.count(F.when(dup, 1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(dup, F.col("__n"))), zero).alias("duplicate_rows"),
    )
    return rep.select(
        F.lit(table_name).alias("table_name"),
        F.lit(",".join(keys)).alias("pk"),
        F.col("n_rows").cast("bigint").alias("n_rows"),
        F.col("null_key_rows").cast("bigint").alias("null_key_rows"),
        F.col("duplicate_keys").cast("bigint").alias("duplicate_keys"),
        F.col("duplicate_rows").cast("bigint").alias("duplicate_rows"),
        ((F.col("null_key_rows") == 0) & (F.col("duplicate_keys") == 0)).alias("ok"),
    )


def pk_report(tables: Sequence[tuple[str, DataFrame, Sequence[str] | str]]) -> DataFrame:
    """:func:`pk_check` for several tables, one row each."""
    reports = [pk_check(df, name, pk) for name, df, pk in tables]
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out


FK_REPORT_SCHEMA = T.StructType([
    T.StructField("fk_column", T.StringType(), False),
    T.StructField("dim_table", T.StringType(), False),
    T.StructField("dim_key", T.StringType(), False),
    T.StructField("orphan_rows", T.LongType(), False),
    T.StructField("orphan_keys", T.LongType(), False),
    T.StructField("target_unique", T.BooleanType(), True),
    T.StructField("ok", T.BooleanType(), False),
])


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _is_integral(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, _INTEGRAL)


def fk_report(fact: DataFrame, edges: Sequence[tuple[str, str, str]],
              dims: Mapping[str, DataFrame]) -> DataFrame:
    """One report row per edge ``(fact column, dimension, dimension key)``.

    ``orphan_rows`` counts fact rows whose non-NULL key has no match in the
    dimension (NULL keys pass, as in SQL), ``orphan_keys`` the distinct such
    keys; ``target_unique`` says whether the referenced key could serve as a
    constraint target at all (unique, no NULL). An edge whose dimension is
    missing from ``dims`` reports every non-NULL key as orphan.

    Edges of integer keys on both sides are checked by bitmaps
    (:mod:`lakeloom.operators.keysets`) when this is called: one scan of the
    fact for all of them, and a shuffle of containers. Rows of orphans are
    counted by a second scan, which only edges with orphans need. Edges with
    a text key compare as text, by a row per distinct key
    (:func:`fk_report_by_key`), so an integer code can meet a text key.
    """
    edges = list(edges)
    by_bits = [i for i, (fk, d, k) in enumerate(edges) if d in dims and _is_integral(fact, fk) and _is_integral(dims[d], k)]
    parts = []
    if by_bits:
        parts.append(_fk_by_bitmaps(fact, edges, by_bits, dims))
    rest = [i for i in range(len(edges)) if i not in set(by_bits)]
    if rest:
        parts.append(fk_report_by_key(fact, [edges[i] for i in rest], dims))
    if not parts:
        return fact.sparkSession.createDataFrame([], FK_REPORT_SCHEMA)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _fk_by_bitmaps(fact: DataFrame, edges: list[tuple[str, str, str]], which: list[int],
                   dims: Mapping[str, DataFrame]) -> DataFrame:
    spark = fact.sparkSession
    columns = {fk: c for c, fk in enumerate(sorted({edges[i][0] for i in which}))}
    sets = containers(fact, [(0, c, fk) for fk, c in columns.items()])
    rows = None
    # a dimension key is read once for all edges that refer to it
    for d, k in sorted({edges[i][1:] for i in which}):
        sides = [(i + 1, columns[edges[i][0]], k) for i in which if edges[i][1:] == (d, k)]
        sets = sets.unionByName(containers(dims[d], sides))
        count = dims[d].agg(F.count(F.lit(1)).alias("rows"), F.count(F.col(f"`{k}`")).alias("keyed"))
        counted = count.select(F.explode(F.array(*[F.lit(s) for s, _, _ in sides])).alias("side"), "rows", "keyed")
        rows = counted if rows is None else rows.unionByName(counted)
    place = f"{scratch_path(spark, 'fk-bitmaps')}/found"
    found = orphan_keys(sets, {i + 1: columns[edges[i][0]] for i in which})
    found.write.parquet(place)
    found = spark.read.schema(found.schema).parquet(place)

    per_side = found.groupBy("side").agg(F.count("key").alias("orphan_keys"), F.sum("n").alias("distinct_keys"))
    names = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(i + 1).alias("side"), *[F.lit(x).alias(n) for n, x in zip(("fk_column", "dim_table", "dim_key"), edges[i])])
        for i in which])))
    report = names.join(rows, "side", "left").join(per_side, "side", "left")
    dirty = [r.side for r in found.where("key IS NOT NULL").select("side").distinct().collect()]  # edges at most
    if dirty:
        pairs = F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(f"`{edges[s - 1][0]}`").cast("bigint").alias("key"))
                                    for s in dirty])).alias("p")
        fact_keys = fact.select(pairs).select("p.*").where("key IS NOT NULL").groupBy("side", "key").agg(F.count(F.lit(1)).alias("m"))
        lost = fact_keys.join(found.where("key IS NOT NULL").select("side", "key"), ["side", "key"])
        report = report.join(lost.groupBy("side").agg(F.sum("m").alias("orphan_rows")), "side", "left")
    else:
        report = report.withColumn("orphan_rows", F.lit(0).cast("bigint"))
    zero = F.lit(0).cast("bigint")
    n = F.coalesce(F.col("orphan_rows"), zero)
    return report.select(
        "fk_column", "dim_table", "dim_key", n.alias("orphan_rows"), F.coalesce("orphan_keys", zero).alias("orphan_keys"),
        ((F.col("rows") == F.col("keyed")) & (F.col("keyed") == F.coalesce("distinct_keys", zero))).alias("target_unique"),
        (n == 0).alias("ok"))


def fk_report_by_key(fact: DataFrame, edges: Sequence[tuple[str, str, str]],
                     dims: Mapping[str, DataFrame]) -> DataFrame:
    """:func:`fk_report` by a row per distinct key, for keys of any type.

    Plan: the fact is scanned once for all edges. Each row emits one
    ``(edge, key)`` pair per edge and a partial aggregation right after the
    scan collapses them to distinct keys per partition, so the shuffle moves
    distinct keys, not rows, and a hot key costs one row per partition. The
    distinct keys are then matched against the union of the dimension keys
    on ``(dimension, key)``. Integer keys on both sides compare as integers
    (``lkey``); any other pairing compares as text (``skey``), so an integer
    code can meet a text key.
    """
    edges = list(edges)
    modes = []
    for fk, d, k in edges:
        integral = _is_integral(fact, fk) and (d not in dims or _is_integral(dims[d], k))
        modes.append("long" if integral else "text")
    targets = sorted({(d, k, m) for (_, d, k), m in zip(edges, modes)})
    target_index = {t: i for i, t in enumerate(targets)}

    def key_cols(c, mode):
        if mode == "long":
            return c.cast("bigint").alias("lkey"), F.lit(None).cast("string").alias("skey")
        return F.lit(None).cast("bigint").alias("lkey"), c.cast("string").alias("skey")

    pairs = F.explode(F.array(*[
        F.struct(F.lit(i).alias("edge"), F.lit(target_index[(d, k, m)]).alias("target"),
                 *key_cols(F.col(f"`{fk}`"), m))
        for i, ((fk, d, k), m) in enumerate(zip(edges, modes))
    ])).alias("p")
    fact_keys = (fact.select(pairs).select("p.*")
                 .filter(F.col("lkey").isNotNull() | F.col("skey").isNotNull())
                 .groupBy("edge", "target", "lkey", "skey").agg(F.count(F.lit(1)).alias("n")))

    # per dimension key: (target, lkey, skey, c) with c = rows holding the
    # key. The same frame feeds the match and the uniqueness flag, so each
    # dimension is aggregated (and shuffled) once.
    target_frames = []
    for (d, k, m), t in target_index.items():
        if d not in dims:
            continue
        lkey, skey = key_cols(F.col(f"`{k}`"), m)
        per_key = dims[d].select(lkey, skey).groupBy("lkey", "skey").agg(F.count(F.lit(1)).alias("c"))
        target_frames.append(per_key.select(F.lit(t).alias("target"), "lkey", "skey", "c"))

    edge_df = fact.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("edge"), F.lit(target_index[(d, k, m)]).alias("target"),
                 F.lit(fk).alias("fk_column"), F.lit(d).alias("dim_table"), F.lit(k).alias("dim_key"))
        for i, ((fk, d, k), m) in enumerate(zip(edges, modes))
    ])))  # the edge list as a JVM-side literal table (no Python round trip)

    if target_frames:
        all_targets = target_frames[0]
        for f in target_frames[1:]:
            all_targets = all_targets.unionByName(f)
        # left join + IS NULL rather than left_anti: the optimizer would push
        # an anti join below the fact-side aggregation, joining every fact
        # row instead of every distinct key once the dimension is too big to
        # broadcast. Null-safe key equality keeps it an equi-join; a NULL
        # dimension key never equals a fact key (fact keys are never NULL).
        mt = all_targets.select(F.col("target").alias("m_target"), F.col("lkey").alias("m_lkey"),
                                F.col("skey").alias("m_skey"), F.col("c").alias("m_c"))
        cond = ((fact_keys["target"] == mt["m_target"]) & fact_keys["lkey"].eqNullSafe(mt["m_lkey"])
                & fact_keys["skey"].eqNullSafe(mt["m_skey"]))
        orphans = fact_keys.join(mt, cond, "left").filter(F.col("m_c").isNull())
        present = F.col("lkey").isNotNull() | F.col("skey").isNotNull()
        uniq = all_targets.groupBy("target").agg(
            ((F.coalesce(F.max(F.when(present, F.col("c"))), F.lit(0)) <= 1)
             & (F.coalesce(F.sum(F.when(~present, F.col("c"))), F.lit(0)) == 0)).alias("target_unique"))
    else:
        orphans = fact_keys
        uniq = None
    per_edge = orphans.groupBy("edge").agg(F.sum("n").alias("orphan_rows"),
                                           F.count(F.lit(1)).alias("orphan_keys"))

    report = edge_df.join(per_edge, "edge", "left")
    with_dim = [t for (d, _, _), t in target_index.items() if d in dims]
    if uniq is not None:
        report = report.join(uniq, "target", "left")
        # an empty dimension has no key rows: vacuously unique
        report = report.withColumn(
            "target_unique",
            F.when(F.col("target").isin(with_dim), F.coalesce(F.col("target_unique"), F.lit(True))))
    else:
        report = report.withColumn("target_unique", F.lit(None).cast("boolean"))
    zero = F.lit(0).cast("bigint")
    return report.select(
        "fk_column", "dim_table", "dim_key",
        F.coalesce(F.col("orphan_rows"), zero).cast("bigint").alias("orphan_rows"),
        F.coalesce(F.col("orphan_keys"), zero).cast("bigint").alias("orphan_keys"),
        "target_unique",
        (F.coalesce(F.col("orphan_rows"), zero) == 0).alias("ok"),
    )


def compare_copies(first: DataFrame, second: DataFrame) -> DataFrame:
    """Are two published copies the same rows, repeats counted (K3)?

    One row: (first_rows, second_rows, differing_rows, ok). Columns are matched
    by name. Every row is folded to a 128-bit digest and the copies' counts
    are added per digest with opposite signs, summed within each task before
    the shuffle.
    """
    names = sorted(first.columns)
    if names != sorted(second.columns):
        raise ValueError(f"copies differ in their columns: {sorted(set(names) ^ set(second.columns))}")

    def digests(df: DataFrame, sign: int) -> DataFrame:
        cols = [F.col(f"`{n}`") for n in names]
        # which columns are NULL is part of the row: a hash skips NULLs
        nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in cols])
        return df.select(F.xxhash64(nulls, *cols).alias("a"), F.xxhash64(F.lit("b"), *cols[::-1], nulls).alias("b"),
                         F.lit(sign).alias("side"))

    both = digests(first, 1).unionByName(digests(second, -1))
    per = both.groupBy("a", "b").agg(F.sum("side").alias("left_over"), F.count_if(F.col("side") == 1).alias("n1"),
                                     F.count_if(F.col("side") == -1).alias("n2"))
    zero = F.lit(0).cast("bigint")
    return per.agg(F.coalesce(F.sum("n1"), zero).alias("first_rows"), F.coalesce(F.sum("n2"), zero).alias("second_rows"),
                   F.coalesce(F.sum(F.abs("left_over")), zero).alias("differing_rows")).withColumn("ok", F.col("differing_rows") == 0)
