"""Relational operators of the loader: lookups, integrity reports, the file
manifest and the star join."""

from lakeloom.operators.guard import has_rows
from lakeloom.operators.integrity import fk_report, pk_check, pk_report
from lakeloom.operators.lookup import lookup_enrich
from lakeloom.operators.manifest import (any_new_data, coverage_status, landed_as_raw,
                                         period_state_grid, period_state_grid_from,
                                         should_load_fact, skip_landed)
from lakeloom.operators.sizing import is_small, sized_broadcast
from lakeloom.operators.star import StarEdge, star_join

__all__ = [
    "has_rows", "fk_report", "pk_check", "pk_report", "lookup_enrich",
    "any_new_data", "coverage_status", "landed_as_raw", "period_state_grid",
    "period_state_grid_from", "should_load_fact", "skip_landed",
    "is_small", "sized_broadcast", "StarEdge", "star_join",
]
