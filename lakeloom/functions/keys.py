"""Key expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_prefix(c: Column | str, n: int = 2) -> Column:
    """``LEFT(CAST(c AS varchar), n)``: e.g. the state part of a municipality code."""
    col = F.col(c) if isinstance(c, str) else c
    return F.left(col.cast("string"), F.lit(n))


def normalised_key(c: Column | str) -> Column:
    """``TRIM(CAST(c AS varchar))``: text form of a key for cross-type matching."""
    col = F.col(c) if isinstance(c, str) else c
    return F.trim(col.cast("string"))
