"""File-name predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def extension_is(name: Column | str, ext: str, case_sensitive: bool = False) -> Column:
    """True where the file name ends with ``.ext`` (case-insensitive by default:
    ``.CSV`` and ``.csv`` are the same kind of file)."""
    c = F.col(name) if isinstance(name, str) else name
    suffix = "." + ext.lstrip(".")
    if case_sensitive:
        return c.endswith(suffix)
    return F.lower(c).endswith(suffix.lower())


def swap_extension(name: Column | str, ext: str) -> Column:
    """Replace the last extension (``RDSP2301.csv`` -> ``RDSP2301.dbc``)."""
    c = F.col(name) if isinstance(name, str) else name
    return F.regexp_replace(c, r"\.[^./]*$", "." + ext.lstrip("."))
