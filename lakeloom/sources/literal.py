"""Literal tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A small in-code table with an explicit schema (no inference).

    The rows are literals of one expression, so the planner knows the table's
    size and joins it by broadcast, without moving the other side.
    """
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    if not rows:
        return spark.createDataFrame([], schema)
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)])
               for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
