"""The whole lake load in dependency order, in one Spark application.

    ingest:  lookup files (fixed width, DBF) -> CSV raw zone
    load:    static dimensions -> catalog dimensions (state first)
             -> municipality dimension -> fact (optionally gated)

Every step returns report rows instead of printing; a failing step does not
stop the others (a missing raw folder is reported as ``missing``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from lakeloom.operators.integrity import FK_REPORT_SCHEMA
from lakeloom.operators.manifest import should_load_fact
from lakeloom.plans.loads import (load_dimension, load_fact, municipality_dimension,
                                  static_dimension_loads)
from lakeloom.sinks.targets import Target, exists, read, write
from lakeloom.sources.csv import read_declared_csv, read_inferred_csv
from lakeloom.sources.dbf import read_dbf
from lakeloom.sources.fixed_width import CNV_GLOB, LOOKUP_ENCODING, FixedField, read_fixed_width
from lakeloom.spec import (CATALOG_DIMENSIONS, FACT_COLUMNS, FACT_FOREIGN_KEYS, FACT_TABLE,
                           MUNICIPALITY_TABLE, SOURCE_FILE_COLUMN, STAGING_TABLE, STATE_TABLE)

# --- fixed values: raw-zone sub-folder of each source ---
RAW_FOLDERS = {
    "sih": "sih",
    "ibge_municipios": "ibge-municipios",
    "ibge_uf": "ibge-uf",
    "sigtap": "sigtap",
    "cid10": "cid10",
    "nacional": "nacional",
}


def convert_fixed_width(spark: SparkSession, src: str, layout: tuple[FixedField, ...], dest: str,
                        encoding: str = LOOKUP_ENCODING, glob: str | None = CNV_GLOB) -> None:
    """Lookup file(s) in a fixed-width layout -> header CSV in ``dest``."""
    write(read_fixed_width(spark, src, layout, encoding, glob), Target.path(dest, "csv"))


def convert_dbf(spark: SparkSession, src: str, dest: str, encoding: str = "latin-1") -> None:
    """DBF table(s) -> header CSV in ``dest``."""
    write(read_dbf(spark, src, encoding), Target.path(dest, "csv"))


def _missing(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([(table, "missing")], "table_name string, action string")


def _guarded(spark: SparkSession, table: str, step: Callable[[], DataFrame]) -> DataFrame:
    try:
        return step()
    except AnalysisException as exc:
        if _absent(exc):
            return _missing(spark, table)
        raise


def _absent(exc: AnalysisException) -> bool:
    """Is the folder not there or without files (any other fault is one)?"""
    return exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def load_lake(spark: SparkSession, raw_root: str, target_for: Callable[[str], Target],
              status: DataFrame | None = None) -> dict[str, DataFrame]:
    """Load every dimension and the fact from a raw zone.

    ``target_for(table)`` names where each table is published (files,
    catalog or JDBC). Dimensions are create-if-absent; the staging and fact
    tables are a full refresh. When ``status`` (the manifest coverage) is
    given, the fact is only loaded if a file arrived in this batch.
    Returns report frames: ``dimensions`` (one row per dimension) and
    ``foreign_keys`` (one row per fact foreign key, empty when skipped).
    """
    root = raw_root.rstrip("/")
    reports = [static_dimension_loads(spark, target_for)]
    catalog = {table: (sub, pk) for sub, table, pk in CATALOG_DIMENSIONS}

    def catalog_load(table: str) -> DataFrame:
        sub, pk = catalog[table]
        path = f"{root}/{RAW_FOLDERS[sub]}"
        return _guarded(spark, table, lambda: load_dimension(
            spark, lambda: read_inferred_csv(spark, path), target_for(table), table, pk))

    # the state dimension first: the municipality dimension reads it
    reports.append(catalog_load(STATE_TABLE))

    def municipalities() -> DataFrame:
        mun = read_inferred_csv(spark, f"{root}/{RAW_FOLDERS['ibge_municipios']}")
        return municipality_dimension(mun, read(spark, target_for(STATE_TABLE)))

    mun_target = target_for(MUNICIPALITY_TABLE)
    if exists(spark, target_for(STATE_TABLE)) or exists(spark, mun_target):
        reports.append(_guarded(spark, MUNICIPALITY_TABLE, lambda: load_dimension(
            spark, municipalities, mun_target, MUNICIPALITY_TABLE, "id")))
    else:
        reports.append(_missing(spark, MUNICIPALITY_TABLE))
    for table in catalog:
        if table != STATE_TABLE:
            reports.append(catalog_load(table))

    dims_report = reports[0]
    for r in reports[1:]:
        dims_report = dims_report.unionByName(r, allowMissingColumns=True)

    dim_names = {d for _, d, _ in FACT_FOREIGN_KEYS}
    dims = {d: read(spark, target_for(d)) for d in dim_names if exists(spark, target_for(d))}
    fact_src = f"{root}/{RAW_FOLDERS['sih']}"
    go = status is None or should_load_fact(status)
    try:
        scan = read_declared_csv(spark, fact_src, FACT_COLUMNS, source_file=SOURCE_FILE_COLUMN) if go else None
    except AnalysisException as exc:
        if not _absent(exc):
            raise
        scan = None
    if scan is None:
        return {"dimensions": dims_report,
                "foreign_keys": spark.createDataFrame([], FK_REPORT_SCHEMA)}
    fk = load_fact(spark, scan, target_for(STAGING_TABLE), target_for(FACT_TABLE), dims)
    return {"dimensions": dims_report, "foreign_keys": fk}

