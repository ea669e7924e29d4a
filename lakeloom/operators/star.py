"""Star join (C6): the fact with its dimensions, one role per foreign key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.sizing import DEFAULT_BROADCAST_MAX_ROWS, sized_broadcast


@dataclass
class StarEdge:
    fk: str                  # fact column
    dim: DataFrame
    dim_key: str
    role: str                # prefix of the dimension's columns in the result
    columns: Sequence[str] = field(default_factory=tuple)  # empty = all but the key
    as_text: bool = False    # compare keys as text (integer code vs text key)


def star_join(fact: DataFrame, edges: Sequence[StarEdge],
              broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS,
              dedupe: bool = False, repeated: str = "all") -> DataFrame:
    """Left-join the fact to each dimension; dimension columns come out as
    ``{role}_{column}``, so one dimension can serve several roles (two
    procedure columns, two diagnosis columns).

    Each dimension is projected to the key and the wanted columns before the
    join. Proven-small dimensions are broadcast (the fact is not shuffled);
    a large dimension falls back to a shuffle join, which AQE may still turn
    into a broadcast at run time.

    ``repeated`` says what a dimension key that occurs more than once does:
    ``all`` gives a fact row per match, as a join does; ``smallest`` takes the
    match that is smallest by the wanted columns in their order, so the fact's
    rows stay as many; ``fail`` stops the job. ``dedupe`` is ``smallest``.
    """
    rule = "smallest" if dedupe else repeated
    if rule not in ("all", "smallest", "fail"):
        raise ValueError(f"repeated: {rule}")
    out = fact
    for e in edges:
        wanted = list(e.columns) or [c for c in e.dim.columns if c != e.dim_key]
        key_name = f"__k_{e.role}"
        dim_key = F.col(f"`{e.dim_key}`")
        dim = e.dim.select((dim_key.cast("string") if e.as_text else dim_key).alias(key_name),
                           *[F.col(f"`{c}`").alias(f"{e.role}_{c}") for c in wanted])
        dim = dim.filter(F.col(key_name).isNotNull())
        if rule != "all":
            dim = _one_per_key(dim, key_name, e, rule)
        dim = sized_broadcast(dim, broadcast_max_rows)
        fk = F.col(f"`{e.fk}`")
        out = out.join(dim, (fk.cast("string") if e.as_text else fk) == dim[key_name], "left").drop(key_name)
    return out


def _one_per_key(dim: DataFrame, key: str, e: StarEdge, rule: str) -> DataFrame:
    columns = [c for c in dim.columns if c != key]
    # the key among the values: a dimension may have no other column
    first = F.min(F.struct(F.col(key).alias("__key"), *[F.col(f"`{c}`") for c in columns])).alias("__row")
    one = dim.groupBy(key).agg(first, F.count(F.lit(1)).alias("__n"))
    if rule == "fail":
        told = F.raise_error(F.concat(F.lit(f"{e.role}: {e.dim_key} "), F.col(key).cast("string"), F.lit(" occurs more than once")))
        one = one.withColumn(key, F.when(F.col("__n") > 1, told.cast(dim.schema[key].dataType)).otherwise(F.col(key)))
    return one.select(key, *[F.col(f"__row.`{c}`").alias(c) for c in columns])
