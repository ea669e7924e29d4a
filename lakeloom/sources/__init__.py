"""Scans: CSV, fixed-width text, DBF, catalog tables, literal tables, file listings."""

from lakeloom.sources.catalog import read_table, register_external_table, table_exists
from lakeloom.sources.csv import read_declared_csv, read_inferred_csv
from lakeloom.sources.files import list_files
from lakeloom.sources.fixed_width import (MUNICIPALITY_LAYOUT, NATIONALITY_LAYOUT, STATE_LAYOUT,
                                          FixedField, fixed_width_file_report, fixed_width_rejects,
                                          nationality_layout,
                                          read_fixed_width)
from lakeloom.sources.literal import literal_table
from lakeloom.sources.static_dims import static_codes, static_dimension, static_dimensions

__all__ = [
    "read_table", "register_external_table", "table_exists",
    "read_declared_csv", "read_inferred_csv", "list_files",
    "MUNICIPALITY_LAYOUT", "NATIONALITY_LAYOUT", "STATE_LAYOUT", "FixedField",
    "fixed_width_file_report", "fixed_width_rejects", "nationality_layout", "read_fixed_width",
    "literal_table", "static_codes", "static_dimension", "static_dimensions",
]
