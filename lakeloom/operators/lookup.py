"""Lookup enrichment (C1): UPDATE ... FROM as a left join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.sizing import DEFAULT_BROADCAST_MAX_ROWS, is_small


def lookup_enrich(target: DataFrame, dim: DataFrame, target_key: Column, dim_key: Column,
                  value: Column, out_col: str,
                  broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Set ``out_col`` on every target row from the dimension row whose key
    matches; unmatched rows get NULL and the target row count never changes.

    The dimension is first reduced to one value per key (the smallest, where
    an UPDATE ... FROM would pick an arbitrary match), so a duplicated
    dimension key cannot multiply target rows. By default Spark's size
    checks pick the join (AQE broadcasts the reduced dimension once its
    measured size is small); ``broadcast_max_rows`` forces a broadcast
    behind an explicit row-count check.
    """
    pairs = (dim.select(dim_key.alias("__lk_key"), value.alias("__lk_val"))
             .filter(F.col("__lk_key").isNotNull()))
    reduced = pairs.groupBy("__lk_key").agg(F.min("__lk_val").alias(out_col))
    # probe the projected scan (it stops early), not the aggregate: the
    # reduced dimension has at most as many rows
    if broadcast_max_rows is not None and is_small(pairs, broadcast_max_rows):
        reduced = F.broadcast(reduced)
    keyed = target.select(*[F.col(f"`{c}`") for c in target.columns if c != out_col],
                          target_key.alias("__lk_tkey"))
    joined = keyed.join(reduced, keyed["__lk_tkey"] == reduced["__lk_key"], "left")
    return joined.select(*[F.col(f"`{c}`") for c in target.columns]
                         if out_col in target.columns
                         else [*[F.col(f"`{c}`") for c in target.columns], F.col(out_col)])
