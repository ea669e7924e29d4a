"""Type coercion: sink-safe projection (B3), lenient typing (B9), typed NULLs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# what a table column of a database can hold: one value per cell
_SINGLE_VALUED = (T.AtomicType, T.NullType)


def jdbc_safe(df: DataFrame) -> DataFrame:
    """The same frame with every column that is not single-valued as text."""
    as_text = {f.name: F.col(f"`{f.name}`").cast(T.StringType())
               for f in df.schema if not isinstance(f.dataType, _SINGLE_VALUED)}
    return df.withColumns(as_text) if as_text else df


# Text that can possibly parse as a number. Spark's string-to-integer cast
# takes optional control/space padding, a sign and digits. The fractional
# pattern only checks the characters: every character a double literal can
# hold (digits, sign, point, exponent, hex-float letters, the letters of NaN
# and Infinity, d/f suffix) -- a superset of what the cast takes, kept to one
# character class because it is cheaper to match than an exact grammar.
_PAD = "[\\x00-\\x20]*"
INTEGRAL_TEXT = f"^{_PAD}[+-]?[0-9]+{_PAD}$"
FRACTIONAL_TEXT = f"^{_PAD}[0-9a-fA-FxXpPnNiItTyY.+-]+{_PAD}$"
_INTEGRAL = {"tinyint", "byte", "smallint", "short", "int", "integer", "bigint", "long"}
_FRACTIONAL = {"float", "real", "double"}


def lenient_cast(c: Column | str, type_name: str) -> Column:
    """Cast text to ``type_name``; values that do not parse become NULL.

    ``try_cast`` rather than ``cast``: with ANSI mode on, a plain cast fails
    the whole job on the first dirty value. Numeric targets get a regex guard
    first: a failing ``try_cast`` costs an exception per value (about ten
    times a successful cast), so text that cannot be a number never reaches
    it. The guard only removes values the cast would reject anyway.
    """
    col = F.col(c) if isinstance(c, str) else c
    t = type_name.lower().strip()
    if t in ("string", "varchar"):
        return col.cast("string")
    if t in _INTEGRAL:
        return F.when(col.rlike(INTEGRAL_TEXT), col.try_cast(type_name))
    if t in _FRACTIONAL:
        return F.when(col.rlike(FRACTIONAL_TEXT), col.try_cast(type_name))
    return col.try_cast(type_name)


def apply_spec(df: DataFrame, columns: Iterable[tuple[str, str]],
               keep_extra: bool = False) -> DataFrame:
    """Retype a text frame by a column spec; bad values become NULL, rows stay.

    Columns are matched by name; spec columns missing from the frame come out
    as typed NULLs so the result always has the spec's shape.
    """
    present = set(df.columns)
    spec = list(columns)
    out = [
        (lenient_cast(F.col(f"`{name}`"), t) if name in present else F.lit(None).cast(t)).alias(name)
        for name, t in spec
    ]
    if keep_extra:
        named = {n for n, _ in spec}
        out += [F.col(f"`{c}`") for c in df.columns if c not in named]
    return df.select(out)


def typed_nulls(df: DataFrame, names: Iterable[str], type_name: str = "string") -> DataFrame:
    return df.select("*", *[F.lit(None).cast(type_name).alias(n) for n in names])
