"""lakeloom: a PySpark star-schema lake loader.

Scans raw extracts (declared / inferred CSV, fixed-width text, DBF), tags rows
with their source file, coerces dirty text, enriches dimensions through lookup
joins, plans and audits the period-by-state file manifest, reports key
violations as tables and publishes staging, fact and dimension tables.
Everything is expressed with the DataFrame API so Catalyst and AQE plan it.
"""

__version__ = "0.1.0"
