"""Composite loads: dimensions (L1, L2, L4), the fact (L3) and their order.

Each load returns a small report DataFrame (what happened, key checks) so a
caller can inspect or persist it; nothing is printed and nothing fails the
whole run because one table has a key problem.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.coerce import jdbc_safe, typed_nulls
from lakeloom.functions.keys import key_prefix, normalised_key
from lakeloom.functions.provenance import file_name_attrs, with_source_file
from lakeloom.operators.guard import has_rows
from lakeloom.operators.integrity import fk_report, pk_check
from lakeloom.operators.lookup import lookup_enrich
from lakeloom.sinks.targets import Target, create_if_absent, dual_publish, exists, read
from lakeloom.sources.static_dims import STATIC_DIMENSIONS
from lakeloom.sources.literal import literal_table
from lakeloom.spec import FACT_FOREIGN_KEYS, SOURCE_FILE_COLUMN


def _status(spark: SparkSession, table: str, action: str) -> DataFrame:
    return spark.createDataFrame([(table, action)], "table_name string, action string")


def load_dimension(spark: SparkSession, build: Callable[[], DataFrame], target: Target,
                   table_name: str, pk: Sequence[str] | str) -> DataFrame:
    """Create-if-absent dimension load (L1 / K4).

    An existing target is left untouched and its source is not read. An
    empty source writes nothing. Otherwise the sink-safe projection is
    written and the primary key is checked on the written copy. Report
    columns: ``table_name, action`` plus the key-check columns.
    """
    if exists(spark, target):
        action = "exists"
    else:
        src = build()
        if not has_rows(src):
            action = "empty"
        else:
            # another loader may have been there first
            action = "written" if create_if_absent(spark, target, lambda: jdbc_safe(src)) else "exists"
    status = _status(spark, table_name, action)
    if action == "empty":
        return status
    return status.join(pk_check(read(spark, target), table_name, pk).drop("table_name")
                       .withColumn("table_name", F.lit(table_name)), "table_name")


def municipality_dimension(municipalities: DataFrame, states: DataFrame,
                           code_col: str = "cod_ibge", state_code_col: str = "cod_ibge",
                           state_name_col: str = "nome") -> DataFrame:
    """The municipality dimension (L2) as one expression.

    ``cod_ibge_uf`` is the first two characters of the municipality code
    and ``uf`` the name of the state whose trimmed code text equals it
    (NULL when none does); the row count equals the input's.
    """
    base = typed_nulls(municipalities, ["cod_ibge_uf", "uf"])
    base = base.withColumn("cod_ibge_uf", key_prefix(F.col(f"`{code_col}`")))
    return lookup_enrich(base, states, F.col("cod_ibge_uf"),
                         normalised_key(states[state_code_col]), states[state_name_col], "uf")


def static_dimension_loads(spark: SparkSession,
                           target_for: Callable[[str], Target]) -> DataFrame:
    """Load the twelve literal dimensions create-if-absent (L4)."""
    reports = [
        load_dimension(spark, lambda rows=rows, schema=schema: literal_table(spark, rows, schema),
                       target_for(table), table, pk)
        for table, schema, pk, rows in STATIC_DIMENSIONS
    ]
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    return out


def load_fact(spark: SparkSession, scan: DataFrame, staging: Target, fact: Target,
              dims: Mapping[str, DataFrame],
              edges: Sequence[tuple[str, str, str]] = FACT_FOREIGN_KEYS,
              source_col: str = SOURCE_FILE_COLUMN) -> DataFrame:
    """The fact load (L3): provenance, empty guard, sink-safe projection,
    full-refresh publish as staging and fact, then the foreign-key report.

    ``scan`` must be a file scan (the source-file column is taken before
    any shuffle). When a target is partitioned by ``uf`` / ``ano`` / ``mes``
    those columns are derived from the file name. Returns the foreign-key
    report of the published fact, or an empty report when there was nothing
    to load.
    """
    tagged = with_source_file(scan, source_col)
    # a target partitioned by state / year / month gets those columns from
    # the file name, so readers prune by period and state
    wanted = [c for c in ("uf", "ano", "mes")
              if c in set(staging.partition_by) | set(fact.partition_by) and c not in tagged.columns]
    if wanted:
        attrs = file_name_attrs(source_col)
        tagged = tagged.select("*", *[attrs[c].alias(c) for c in wanted])
    if not has_rows(tagged):
        return fk_report(tagged.limit(0), edges, dims)
    published = dual_publish(spark, jdbc_safe(tagged), staging, fact)
    return fk_report(published, edges, dims)
