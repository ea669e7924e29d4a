"""Catalog scans (A3) and external-table registration (K7)."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakeloom.sources.csv import CSV_DIALECT


def _quote(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Scan a catalog table (``db.table``); all its files form one table."""
    return spark.table(name)


def table_exists(spark: SparkSession, name: str) -> bool:
    """Exact-name probe (no pattern matching on ``_`` or ``%``)."""
    return spark.catalog.tableExists(name)


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def _stored(spark: SparkSession, name: str):
    """The catalog's entry of a table, and its database and plain name."""
    jvm = spark._jsparkSession
    ident = jvm.sessionState().sqlParser().parseTableIdentifier(_quote(name))
    meta = jvm.sessionState().catalog().getTableMetadata(ident)
    return meta, meta.identifier().database().get(), meta.identifier().table()


def replace_columns(spark: SparkSession, name: str, columns: Iterable[tuple[str, str]]) -> DataFrame:
    """Give a registered table another column list (K7).

    Location, format, options and partition keys stay as the catalog has them
    and need not be repeated; partition keys named among ``columns`` must have
    the type that they have. The catalog swaps the columns in one update, so
    the table is never gone, and its files and partitions are not touched.
    Returns a scan of the table.
    """
    fields = [T.StructField(n, T.StructType.fromDDL(f"c {t}")[0].dataType, True) for n, t in columns]
    meta, database, plain = _stored(spark, name)
    keys = {f["name"].lower(): f["type"] for f in json.loads(meta.partitionSchema().json())["fields"]}
    data = [f for f in fields if f.name.lower() not in keys]
    for f in fields:
        held = keys.get(f.name.lower())
        if held is not None and held != json.loads(f.dataType.json()):
            raise ValueError(f"partition key {f.name} is {held}; only the other columns can be replaced")
    if not data or len({f.name.lower() for f in fields}) < len(fields):
        raise ValueError("a table needs columns of different names beside its partition keys")
    schema = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(T.StructType(data).json())
    spark._jsparkSession.sharedState().externalCatalog().alterTableDataSchema(database, plain, schema)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def register_external_table(spark: SparkSession, name: str, location: str,
                            columns: Iterable[tuple[str, str]] | None = None,
                            fmt: str = "csv", options: dict[str, str] | None = None,
                            partition_by: Iterable[str] = (), replace: bool = False) -> DataFrame:
    """Create an external table over files, or, with ``replace``, give an
    existing one these columns and this location.

    A table that is there keeps its format, options and partition keys
    (:func:`replace_columns`); asking for others is an error: drop it first,
    which leaves its files. CSV tables always consume the header line, and a
    line break ends a record there unless the option ``multiLine`` says
    otherwise, which reads each file in one task. Returns a scan of the table.
    """
    opts = dict(CSV_DIALECT) if fmt == "csv" else {}
    opts.update(options or {})
    if replace and table_exists(spark, name):
        return _replace_table(spark, name, location, columns, fmt, opts, list(partition_by))
    cols = ""
    if columns:
        cols = "(" + ", ".join(f"`{n}` {t}" for n, t in columns) + ")"
    opt_sql = ", ".join(f"{_text(k)} {_text(v)}" for k, v in opts.items())
    parts = list(partition_by)
    part_sql = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)})" if parts else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_quote(name)} {cols} USING {fmt} "
        f"OPTIONS ({opt_sql}){part_sql} LOCATION {_text(location)}"
    )
    if parts:
        spark.sql(f"MSCK REPAIR TABLE {_quote(name)}")
    return spark.table(name)


def _replace_table(spark: SparkSession, name: str, location: str, columns, fmt: str, opts: dict[str, str],
                   keys: list[str]) -> DataFrame:
    meta, _, _ = _stored(spark, name)
    if meta.provider().get().lower() != fmt.lower():
        raise ValueError(f"{name} is a {meta.provider().get()} table, not {fmt}: drop it first")
    if keys and keys != partition_columns(spark, name):
        raise ValueError(f"{name} is partitioned by {partition_columns(spark, name)}, not {keys}: drop it first")
    held = {k.lower(): v for k, v in spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
        meta.storage().properties()).items()}
    if any(held.get(k.lower()) != str(v) for k, v in opts.items()):
        raise ValueError(f"{name} has other options: drop it first")
    before = spark._jvm.org.apache.hadoop.fs.Path(meta.location()).toString().rstrip("/")
    spark.sql(f"ALTER TABLE {_quote(name)} SET LOCATION {_text(location)}")
    after = spark._jvm.org.apache.hadoop.fs.Path(_stored(spark, name)[0].location()).toString().rstrip("/")
    if after != before and partition_columns(spark, name):
        spark.sql(f"ALTER TABLE {_quote(name)} RECOVER PARTITIONS")
    return replace_columns(spark, name, columns) if columns else spark.table(name)
