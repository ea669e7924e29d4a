"""Empty-input guard."""

from __future__ import annotations

from pyspark.sql import DataFrame


def has_rows(df: DataFrame) -> bool:
    """True when ``df`` has at least one row; reads at most one row."""
    return not df.isEmpty()
