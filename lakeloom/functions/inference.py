"""Types of text columns: every value has a kind, a column the least type that
holds all of its kinds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.coerce import FRACTIONAL_TEXT, INTEGRAL_TEXT

# kinds of values as bits, so that a column's kinds are one bitwise or
INT, LONG, BIG, DOUBLE, DATE, TIME, BOOL, TEXT = (1 << k for k in range(8))

# least type of a set of kinds, narrowest first. Whole numbers over 18 digits
# stay exact: with fractions beside them no number type holds both, so they
# are text.
_LATTICE = ((INT, "int"), (INT | LONG, "bigint"), (INT | LONG | BIG, "decimal(38,0)"),
            (INT | LONG | DOUBLE, "double"), (DATE, "date"), (DATE | TIME, "timestamp"), (BOOL, "boolean"))


def kind(c: Column) -> Column:
    """Bit of a text value's kind, NULL for NULL. A cast is only tried where
    the text looks like its type, as a failing one is expensive."""
    return (F.when(c.rlike(INTEGRAL_TEXT),
                   F.when(c.try_cast("int").isNotNull(), INT).when(c.try_cast("bigint").isNotNull(), LONG)
                   .when(c.try_cast("decimal(38,0)").isNotNull(), BIG).otherwise(TEXT))
            .when(c.rlike(FRACTIONAL_TEXT) & c.try_cast("double").isNotNull(), DOUBLE)
            .when(c.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.when(c.try_cast("date").isNotNull(), DATE).otherwise(TEXT))
            .when(c.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:"),
                  F.when(c.try_cast("timestamp").isNotNull(), TIME).otherwise(TEXT))
            .when(F.lower(c).isin("true", "false"), BOOL)
            .when(c.isNotNull(), TEXT))


def merged_type(kinds: int | None) -> str:
    """The least type that holds all kinds of a column; text if there are none."""
    if kinds:
        for held, name in _LATTICE:
            if not kinds & ~held:
                return name
    return "string"


def infer_types(df: DataFrame, columns: list[str], sampling_ratio: float = 1.0) -> list[tuple[str, str]]:
    """(name, type) of text columns by one aggregation over all rows (or a
    sample): a bitwise or per column, whatever the number of rows."""
    some = df if sampling_ratio >= 1 else df.sample(sampling_ratio, seed=1)
    if not columns:
        return []
    seen = some.agg(*[F.bit_or(kind(F.col(f"`{c}`"))).alias(f"k{i}") for i, c in enumerate(columns)]).first()
    return [(c, merged_type(seen[i])) for i, c in enumerate(columns)]
