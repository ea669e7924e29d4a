"""Column expressions (all JVM-side, inside whole-stage codegen)."""

from lakeloom.functions.coerce import apply_spec, jdbc_safe, lenient_cast, typed_nulls
from lakeloom.functions.files import extension_is, swap_extension
from lakeloom.functions.keys import key_prefix, normalised_key
from lakeloom.functions.provenance import file_name_attrs, with_file_name_attrs, with_source_file
from lakeloom.functions.text import fixed_width_field, parse_state_list, rstrip_ws, strict_int

__all__ = [
    "apply_spec", "jdbc_safe", "lenient_cast", "typed_nulls",
    "extension_is", "swap_extension",
    "key_prefix", "normalised_key",
    "file_name_attrs", "with_file_name_attrs", "with_source_file",
    "fixed_width_field", "parse_state_list", "rstrip_ws", "strict_int",
]
