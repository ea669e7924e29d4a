"""Mixing sources to target weights (Sainte-Lague block quotas), DataFrame only.

Words are the token unit. Every source gets a target (its weight's share of
the wanted total, capped at a number of repeats, the excess reshared); the
total is cut into equal blocks, blocks go to sources and then to the shards of
each source by highest quotients ``votes / (2 seats + 1)``, and inside a shard
a seeded systematic draw picks exactly its quota of blocks from the shard's
repeated word stream. Blocks are never materialised: the draw has a closed
form, so a document's words are the difference of two prefix counts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lakeloom.llm.common import Scratch

WORD = r"[^\x20\x09-\x0D]+"
DEFAULT_WEIGHTS = (3, 1, 2)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def cyclic_weights(sources: DataFrame, weights=DEFAULT_WEIGHTS) -> DataFrame:
    """(source, weight): sources by code point, null last, weights repeating.
    The input has one row per source."""
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    picks = F.array(*[F.lit(float(w)) for w in weights])
    return sources.select("source", F.element_at(picks, ((rank - 1) % len(weights) + 1).cast("int"))
                          .alias("weight"))


def capped_targets(sources: DataFrame, share: float, repeats: int) -> tuple[DataFrame, float]:
    """``sources(source, source_size, weight)`` with its target.

    A source's target is ``min(repeats * size, level * weight)``; the level is
    found by repeating "saturate, reshare the rest by weight" with one small
    aggregate per step, until no source is newly above its cap.
    """
    cap = F.col("source_size") * float(repeats)
    sums = sources.agg(F.sum("source_size").alias("s"), F.sum("weight").alias("w")).first()
    total = share * float(sums["s"] or 0)
    if total <= 0 or not sums["w"]:
        return sources.withColumn("target", F.lit(0.0)), 0.0
    level = total / sums["w"]
    while True:
        over = cap < F.lit(level) * F.col("weight")
        r = sources.agg(F.sum(F.when(over, cap).otherwise(0.0)).alias("full"),
                        F.sum(F.when(~over, F.col("weight")).otherwise(0.0)).alias("w")).first()
        if not r["w"]:
            break
        new = (total - r["full"]) / r["w"]
        if new <= level * (1 + 1e-12):
            break
        level = new
    return sources.withColumn("target", F.least(cap, F.lit(level) * F.col("weight"))), total


def _span(votes: Column, total: Column, seats: Column, n: Column) -> tuple[Column, Column]:
    """Seats every apportionment gives at least, and a bound on what it may
    give: rounding by a divisor too large and by one too small by half a seat
    per party brackets the Sainte-Lague divisor."""
    big = (votes * (seats - n / 2) / total)
    low = F.greatest(F.lit(0), F.floor(F.when(total > 0, big).otherwise(0.0) + 0.5) - 1)
    high = F.floor(F.when(total > 0, votes * (seats + n / 2) / total).otherwise(-1.0) + 0.5) + 1
    return low.cast("bigint"), F.greatest(high.cast("bigint"), low.cast("bigint"))


def sainte_lague(parties: DataFrame, group: list[str], key: list[str]) -> DataFrame:
    """Seats per party by highest quotients, ties to the smaller key.

    ``parties(group..., key..., votes double, pool bigint)``: ``pool`` seats
    are shared within each group. Only quotients between the bracketing
    divisors become rows: about two or three per party, whatever the pool.
    """
    same = W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    tot, n = F.sum("votes").over(same), F.count(F.lit(1)).over(same)
    low, high = _span(F.col("votes"), tot, F.col("pool").cast("double"), n.cast("double"))
    p = parties.withColumn("_low", low).withColumn("_high", high)
    p = p.withColumn("_open", F.col("pool") - F.sum("_low").over(same))
    q = p.withColumn("_seat", F.explode_outer(F.when(
        F.col("_high") > F.col("_low"), F.sequence(F.col("_low"), F.col("_high") - 1))))
    order = W.partitionBy(*(group or [F.lit(0)])).orderBy(
        (F.col("votes") / (2 * F.col("_seat") + 1)).desc_nulls_last(), *[F.col(k) for k in key])
    q = q.withColumn("_rank", F.row_number().over(order))
    won = F.col("_seat").isNotNull() & (F.col("_rank") <= F.col("_open")) & (F.col("votes") > 0)
    ids = group + [k for k in key if k not in group]
    return q.groupBy(*ids).agg((F.first("_low") + F.sum(won.cast("bigint"))).alias("seats"))


def mix_sources(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source",
                text_col: str = "text", weights: DataFrame | None = None, share: float = 1.5,
                repeats: int = 2, block_words: int = 16, least_blocks: int = 16, shard_docs: int = 4096,
                max_shards: int = 100_000, shard_words: int = 4096, seed: int = 7) -> DataFrame:
    """One row per input row: id, source, size, source_size, target, taken.

    ``weights(source, weight)`` defaults to 3, 1, 2 repeating over the sources
    by code point. Sources are compared null-safe. Null text has size 0; an
    empty table gives no rows; repeated rows are separate documents; other
    columns are ignored. Within a shard documents stand in a seeded hash
    order, equal ids by size, so reruns agree.

    Scale: the text is scanned once (sizes are written out); after that only
    (id, source, size) rows move, in one shuffle on (source, shard). Shards
    are hash slices of the whole table, so a source with a third of all rows
    is spread over all of them. Their number is at most ``max_shards``, which
    bounds the quota windows. A source with less than ``shard_words`` words a
    shard has fewer of them: a shard's last block may be short, and in shards
    of few words that would be much of the source.

    Blocks have ``block_words`` words, or fewer where the smallest target
    above zero would get less than ``least_blocks`` of them: a source counts
    in whole blocks, and no target may vanish in the rounding. Blocks are not
    rows, so small ones cost nothing.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    sized = scratch.write(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                                      word_count(F.col(text_col)).alias("size")), "sized")
    shards_n = max(1, min(max_shards, math.ceil(sized.count() / shard_docs)))
    sized = _keyed(sized).withColumn(
        "slice", (_number(f"{seed + 1}", F.col("doc_id")) % shards_n).cast("int"))
    key, shard_key = ["_nul", "_src"], ["_nul", "_src", "shard"]

    slices = scratch.write(sized.groupBy("source", *key, "slice").agg(F.sum("size").alias("words")), "slices")
    sources = scratch.write(slices.groupBy("source", *key).agg(F.sum("words").alias("source_size")),
                            "sources")
    own = F.greatest(F.lit(1), F.least(F.lit(shards_n), F.floor(F.col("source_size") / shard_words)))
    slices = scratch.write(slices.join(sources.drop("source"), key).withColumn(
        "shard", (F.col("slice") % own).cast("int")).drop("source_size"), "merged")
    shards = scratch.write(slices.groupBy("source", *shard_key).agg(F.sum("words").alias("words")), "shards")
    # by slice, so that a source with many rows meets in no one task
    sized = sized.join(slices.select(*key, "slice", "shard"), [*key, "slice"])
    w = _keyed(weights if weights is not None else cyclic_weights(sources)).drop("source")
    weighted = scratch.write(sources.join(w, key, "left").withColumn(
        "weight", F.coalesce(F.col("weight").cast("double"), F.lit(0.0))), "weighted")
    targets, total = capped_targets(weighted, share, repeats)
    smallest = targets.where("target > 0").agg(F.min("target")).first()[0]
    block_words = max(1, min(block_words, math.floor((smallest or 0.0) / least_blocks)))
    blocks = math.floor(total / block_words + 0.5)
    quota = sainte_lague(targets.select(*key, F.col("target").alias("votes"),
                                        F.lit(blocks).cast("bigint").alias("pool")), [], key)
    plan = scratch.write(targets.join(quota, key).select(*key, "source_size", "target", "seats"), "plan")

    per_shard = shards.join(plan, key)
    seats = sainte_lague(per_shard.select(*shard_key, F.col("words").cast("double").alias("votes"),
                                          F.col("seats").alias("pool")), key, ["shard"])
    quotas = scratch.write(per_shard.drop("seats", "source").join(
        seats.withColumnRenamed("seats", "quota"), shard_key), "quotas")

    # documents without words take none, wherever they stand: however many a
    # source has, they stay apart by slice
    stream = (W.partitionBy(*shard_key, "_idle").orderBy("_order", "doc_id", "size")
              .rowsBetween(W.unboundedPreceding, 0))
    placed = (sized.withColumn("_order", _digest(f"{seed}", F.col("doc_id")))
              .withColumn("_idle", F.when(F.col("size") == 0, F.col("slice")).otherwise(-1))
              .withColumn("_end", F.sum("size").over(stream)))
    taken = _draw(F.col("_end") - F.col("size"), F.col("_end"), F.col("words"), F.col("quota"),
                  block_words, repeats, seed)
    return placed.join(quotas, shard_key).select("doc_id", "size", "source_size", "target",
                                                 taken.alias("taken"), "source", "shard")


def _digest(seed: str, *cols: Column) -> Column:
    """A seeded hash as text, one that other engines have too."""
    return F.md5(F.concat_ws(":", F.lit(seed), *[c.cast("string") for c in cols]))


def _number(seed: str, *cols: Column) -> Column:
    return F.conv(F.substring(_digest(seed, *cols), 1, 8), 16, 10).cast("bigint")


def _keyed(df: DataFrame) -> DataFrame:
    """Null-free join keys of ``source``, so that grouping, windows and joins
    on it share one hash partitioning."""
    return (df.withColumn("_nul", F.col("source").isNull().cast("int"))
            .withColumn("_src", F.coalesce(F.col("source").cast("string"), F.lit(""))))


def _draw(start: Column, end: Column, words: Column, quota: Column, b: int, repeats: int,
          seed: int) -> Column:
    """Words of [start, end) that a systematic draw of ``quota`` blocks takes.

    The shard's words, ``repeats`` times over, form ``n`` blocks of ``b``
    words (the last may be short). Block j is drawn iff
    ``(j * quota + phase) mod n < quota``, which holds for exactly ``quota``
    of any n consecutive blocks; the phase is seeded per shard.
    """
    n = F.greatest(F.lit(1), F.ceil(words * repeats / F.lit(b))).cast("bigint")
    q = F.least(quota, n).cast("bigint")
    phase = _number(f"{seed + 2}", F.col("source"), F.col("shard")) % n

    def floor_div(x: Column) -> Column:
        return ((x - F.pmod(x, n)) / n).cast("bigint")

    def before(x: Column) -> Column:
        j = ((x - x % b) / b).cast("bigint")
        full = floor_div((j - 1) * q + phase) - floor_div(phase - q)
        part = F.when(F.pmod(j * q + phase, n) < q, x - j * b).otherwise(0)
        return full * b + part

    total = None
    for e in range(repeats):
        shift = words * e
        piece = before(shift + end) - before(shift + start)
        total = piece if total is None else total + piece
    return total.cast("bigint")
