"""Text expressions: fixed-width slicing (B7), strict integers (B8), state lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip()/rstrip() remove: derived from
# str.isspace() itself (every such character lies below U+3001).
PY_WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
INT_TEXT = "^[+-]?[0-9]+$"


def _ws() -> Column:
    return F.lit(PY_WHITESPACE)


def rstrip_ws(c: Column) -> Column:
    """Python's ``rstrip()``: drop trailing whitespace (a set trim, no regex)."""
    return F.rtrim(c, _ws())


def strip_ws(c: Column) -> Column:
    """Python's ``strip()``."""
    return F.trim(c, _ws())


def fixed_width_field(value: Column | str, start: int, size: int) -> Column:
    """Characters ``[start, start + size)`` (0-based), trailing whitespace
    removed, then every comma replaced by a space (in that order, so a
    trailing comma survives as a space). Short lines give a short or empty
    slice, never an error."""
    v = F.col(value) if isinstance(value, str) else value
    return F.replace(rstrip_ws(F.substring(v, start + 1, size)), F.lit(","), F.lit(" "))


def is_blank(c: Column) -> Column:
    return strip_ws(c) == F.lit("")


def strict_int(raw: Column) -> Column:
    """Integer value of a field, NULL when blank or not an integer.

    Only surrounding whitespace, an optional sign and ASCII digits are
    accepted; ``7.0``, ``1 000`` and ``1_0`` are rejected (``try_cast``
    alone would take some of these). Callers use :func:`is_blank` to tell
    blank from invalid.
    """
    t = strip_ws(raw)
    return F.when(t.rlike(INT_TEXT), t.try_cast("bigint"))


def parse_state_list(text: Column | str) -> Column:
    """``' sp, ,rj'`` -> ``['SP', 'RJ']``: split on commas, trim, upper-case,
    drop blanks."""
    t = F.col(text) if isinstance(text, str) else text
    parts = F.transform(F.split(F.coalesce(t, F.lit("")), ","), lambda x: F.upper(F.trim(x)))
    return F.filter(parts, lambda x: x != F.lit(""))
