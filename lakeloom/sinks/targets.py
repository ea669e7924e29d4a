"""Publishing targets: a folder of files, a catalog table or a JDBC table.

Write paths never add a shuffle of their own: the number of output files
follows the data's partitioning (optionally shrunk with ``coalesce``), and
partitioned folders (``partition_by``) give readers partition pruning.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import types as T

from lakeloom import hadoop
from lakeloom.functions.coerce import jdbc_safe
from lakeloom.sinks import versions
from lakeloom.sources.csv import CSV_DIALECT, read_declared_csv, read_inferred_csv


@dataclass(frozen=True)
class Target:
    kind: str                      # "path" | "table" | "jdbc"
    location: str                  # folder URI, catalog table name or JDBC table
    fmt: str = "parquet"           # file format for "path" / "table"
    options: dict = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    max_files: int | None = None   # rebalance to about this many output files
    versioned: bool = False        # "path": loads are versions, swapped by a pointer (sinks.versions)

    @staticmethod
    def path(location: str, fmt: str = "parquet", **kw) -> "Target":
        return Target("path", location, fmt, **kw)

    @staticmethod
    def table(name: str, fmt: str = "parquet", **kw) -> "Target":
        return Target("table", name, fmt, **kw)

    @staticmethod
    def jdbc(table: str, url: str, user: str | None = None, password: str | None = None,
             driver: str | None = None, batchsize: int = 50_000, num_partitions: int = 4,
             url_params: dict[str, str] | None = None) -> "Target":
        return Target("jdbc", table, "jdbc", options=jdbc_options(
            url, table, user, password, driver, batchsize, num_partitions, url_params))


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, batchsize: int = 50_000, num_partitions: int = 4,
                 url_params: dict[str, str] | None = None) -> dict[str, str]:
    """Options of a batched JDBC write. ``url_params`` are appended to the URL
    with ``?`` or ``&`` (e.g. ``{"reWriteBatchedInserts": "true"}`` for
    PostgreSQL). ``numPartitions`` caps concurrent connections: Spark
    coalesces to it (no shuffle) before inserting."""
    full = url
    for k, v in (url_params or {}).items():
        full += ("&" if "?" in full else "?") + f"{k}={v}"
    opts = {"url": full, "dbtable": table, "batchsize": str(batchsize),
            "numPartitions": str(num_partitions)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver:
        opts["driver"] = driver
    return opts


def _writer(df: DataFrame, t: Target, mode: str) -> DataFrameWriter:
    if t.kind == "jdbc":
        df = jdbc_safe(df)
        # Spark would coalesce to numPartitions, which also shrinks the
        # upstream scan to that many tasks; a shuffle keeps the scan wide and
        # caps only the number of concurrent database connections.
        cap = int(t.options.get("numPartitions", 0) or 0)
        if cap:
            df = df.repartition(cap)
    elif t.max_files:
        # AQE rebalances to about this many evenly sized output files
        # without collapsing the upstream stage
        df = df.hint("rebalance", t.max_files)
    w = df.write.mode(mode).format(t.fmt)
    if t.kind != "jdbc" and t.fmt == "csv":
        # blanks around a value are part of it
        w = (w.options(**CSV_DIALECT).option("encoding", "UTF-8")
             .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    w = w.options(**t.options)
    if t.partition_by:
        w = w.partitionBy(*t.partition_by)
    return w


def write(df: DataFrame, t: Target, mode: str = "overwrite") -> None:
    """Write ``df`` to the target (K1 / K2 / K5). ``overwrite`` is a full
    refresh: the old content is replaced as a whole, never appended to.

    On a plain folder or table Spark removes the old files first, so readers
    can meet a gap and a failed load leaves none; a ``versioned`` folder keeps
    the old version until the new one is complete."""
    w = _writer(df, t, mode)
    if t.kind == "path" and t.versioned:
        if mode != "overwrite":
            raise ValueError("a versioned target is refreshed as a whole: mode overwrite")
        versions.publish(w.mode("errorifexists"), df.sparkSession, t.location)
    elif t.kind == "path":
        w.save(t.location)
    elif t.kind == "table":
        w.saveAsTable(t.location)
    elif t.kind == "jdbc":
        w.save()
    else:
        raise ValueError(t.kind)


def read(spark: SparkSession, t: Target, schema: T.StructType | None = None) -> DataFrame:
    """Read a target back; ``schema`` gives the types of a CSV folder as they
    were written (inferred otherwise). Line breaks in CSV values come back;
    a partitioned CSV folder, or one with options of its own, is read file by
    file for that."""
    if t.kind == "path":
        location = versions.folder_to_read(spark, t.location) if t.versioned else t.location
        r = spark.read.format(t.fmt)
        if t.fmt == "csv":
            if not t.partition_by and not t.options:
                if schema is None:
                    return read_inferred_csv(spark, location)
                return read_declared_csv(spark, location, [(f.name, f.dataType.simpleString()) for f in schema])
            r = r.options(**CSV_DIALECT).option("multiLine", True)
            r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
        return r.options(**t.options).load(location)
    if t.kind == "table":
        return spark.table(t.location)
    return spark.read.format("jdbc").options(**t.options).load()


def exists(spark: SparkSession, t: Target) -> bool:
    """Exact-name existence probe of the target. A folder exists once its load
    has committed: its marker, or pointer, decides alone. A fault of the file
    system or database is raised, not taken for absence."""
    if t.kind == "path":
        if t.versioned:
            return versions.current_folder(spark, t.location.rstrip("/")) is not None
        return hadoop.exists(spark, f"{t.location.rstrip('/')}/_SUCCESS")
    if t.kind == "table":
        return spark.catalog.tableExists(t.location)
    return _jdbc_table_exists(spark, t)


def _jdbc_table_exists(spark: SparkSession, t: Target) -> bool:
    """Asks the database: a plain query shows that it can be reached, so that
    a failing one on the table means that there is no such table."""
    def probe(query: str) -> None:
        (spark.read.format("jdbc").options(**{k: v for k, v in t.options.items() if k != "dbtable"})
         .option("query", query).load()).schema  # noqa: B018 - resolving the schema runs the probe

    probe("SELECT 1 AS reached")
    try:
        probe(f"SELECT * FROM {t.location} WHERE 1 = 0")
        return True
    except Exception as exc:  # noqa: BLE001 - drivers differ in their exceptions
        if any(x in str(exc).lower() for x in ABSENT_TABLE):
            return False
        raise


# --- fixed values: how databases say that a table is not there (messages and SQL states) ---
ABSENT_TABLE = ("does not exist", "not found", "doesn't exist", "no such table", "invalid object name",
                "42p01", "42s02", "42x05", "ora-00942")

REPAIR_SECONDS = 60  # how long another loader may take to move an unfinished folder away


def create_if_absent(spark: SparkSession, t: Target, build: Callable[[], DataFrame]) -> bool:
    """Write ``build()`` only when the target does not exist yet (K4).

    The probe comes first, so an existing target costs no read of the source;
    existing rows are never touched. Returns True when written. Of concurrent
    loaders one wins: a folder is written beside its place and renamed into it
    in one step, and a loader that finds the place taken drops its own. A
    folder without commit marker is a load that never ended; it is moved aside
    (``<folder>.unfinished-<time>``), by one loader, before the new one comes.
    """
    if exists(spark, t):
        return False
    if t.kind == "path" and t.versioned:
        w = _writer(build(), t, "errorifexists")
        return versions.publish(w, spark, t.location, only_first=True) is not None
    if t.kind != "path":
        write(build(), t, mode="ignore")
        return True
    place = t.location.rstrip("/")
    staged = f"{place}.load-{uuid.uuid4().hex}"
    try:
        _writer(build(), t, "errorifexists").save(staged)
        upto = time.monotonic() + REPAIR_SECONDS
        while not hadoop.move_new(spark, staged, place):
            if exists(spark, t):
                return False
            if _move_aside(spark, place):
                continue
            if time.monotonic() > upto:
                raise RuntimeError(f"{place} is unfinished and another loader that set out to repair it has not: "
                                   f"remove {place}.repair-* once it is gone")
            time.sleep(0.2)
        return True
    finally:
        hadoop.delete(spark, staged)


def _move_aside(spark: SparkSession, place: str) -> bool:
    """Move an unfinished folder away. The right to do so is claimed per state
    of the folder, so that nobody moves what another loader put there since."""
    try:
        state = hadoop.modified(spark, place)
    except Exception:  # noqa: BLE001 - gone meanwhile
        return True
    if not hadoop.claim(spark, f"{place}.repair-{state}", "unfinished"):
        return False
    try:
        if not hadoop.exists(spark, f"{place}/_SUCCESS") and hadoop.modified(spark, place) == state:
            hadoop.move_new(spark, place, f"{place}.unfinished-{state}")
    finally:
        hadoop.delete(spark, f"{place}.repair-{state}")
    return True


def dual_publish(spark: SparkSession, df: DataFrame, staging: Target, fact: Target) -> DataFrame:
    """Publish one frame as staging and fact (K3) with one pass over the source.

    The staging copy is written first and the fact is written from it, so
    the (possibly expensive) source plan runs once and the second write
    reads a materialised copy; lineage is cut and an executor lost during
    the second write re-reads staging files instead of recomputing the
    source. CSV staging is read back with the types that were written. For a
    JDBC staging target the frame is checkpointed to the shared work folder
    before either write. Returns the fact as written.
    """
    if staging.kind in ("path", "table"):
        write(df, staging)
        again = read(spark, staging, df.schema)
    else:
        # materialised first, so that both tables get the same rows
        again = df.checkpoint(eager=True)
        write(again, staging)
    write(again, fact)
    return read(spark, fact, again.schema) if fact.kind in ("path", "table") else again


def publish_zone(tables: dict[str, DataFrame], root: str, fmt: str = "csv",
                 mode: str = "overwrite") -> dict[str, str]:
    """Write each table to its own sub-folder of a zone root (K6); the same
    layout serves a local folder and an object store. Returns name -> path."""
    paths = {}
    for sub, df in tables.items():
        path = f"{root.rstrip('/')}/{zone_folder(sub)}"
        write(df, Target.path(path, fmt), mode)
        paths[sub] = path
    return paths


def zone_folder(prefix: str, zone: str = "raw") -> str:
    """The folder of a prefix below its zone root; only a leading ``zone``
    segment is the root (``raw/a/`` and ``a`` are folder ``a``)."""
    segments = [x for x in prefix.split("/") if x]
    return "/".join(segments[1:] if segments[:1] == [zone] else segments)
