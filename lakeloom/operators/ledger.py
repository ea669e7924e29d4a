"""Key checks over increments (D1, C3): what earlier drops held is kept in
tables bucketed by key, so checking a drop shuffles the drop and nothing else.

A ledger is a catalog table of (key, n), a row per key and drop, partitioned by
drop and bucketed by key. Taking a drop in twice, after a failure say, replaces
what its first attempt left. Reports equal those of a check over all drops at
once.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.operators.integrity import FK_REPORT_SCHEMA, PK_REPORT_SCHEMA

BUCKETS = 64  # tasks of a check; size it so that a bucket of all keys fits a task


def _sum(name: str):
    return F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name)


def _replace_drop(spark: SparkSession, table: str, rows: DataFrame, drop: str) -> None:
    """Make ``rows`` (all columns but the last, ``drop``) the table's partition
    of a drop; its other partitions are not touched."""
    view = f"lakeloom_drop_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(view)
    value = drop.replace("\\", "\\\\").replace("'", "\\'")
    try:
        columns = ", ".join(f"`{c}`" for c in rows.columns)
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (`drop` = '{value}') SELECT {columns} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


class _Bucketed:
    """A table of (key columns, n, drop) bucketed by key."""

    def __init__(self, spark: SparkSession, name: str, keys: Sequence[str], buckets: int) -> None:
        self.spark, self.name, self.keys, self.buckets = spark, name, list(keys), buckets

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def counted(self, df: DataFrame) -> DataFrame:
        """Rows per key of a drop, laid out as the buckets are: the only
        shuffle, after a sum within each task."""
        cols = [F.col(f"`{k}`") for k in self.keys]
        part = df.groupBy(*cols).agg(F.sum("n").alias("n")) if "n" in df.columns else df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
        return part.repartition(self.buckets, *cols)

    def put(self, df: DataFrame, drop: str) -> None:
        """Make ``df`` the rows of a drop, whatever it had before."""
        out = df.select(*[F.col(f"`{k}`") for k in self.keys], F.col("n").cast("bigint").alias("n"))
        if not self.exists():
            (out.withColumn("drop", F.lit(drop)).write.format("parquet").partitionBy("drop").bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
             .saveAsTable(self.name))
        else:
            _replace_drop(self.spark, self.name, out, drop)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


class KeyLedger:
    """The keys of a table that grows by drops.

    ``add`` takes a drop in and ``report`` gives what
    :func:`lakeloom.operators.integrity.pk_check` would say of all drops
    together. NULL keys are counted, and never equal.
    """

    def __init__(self, spark: SparkSession, name: str, key: Sequence[str] | str, buckets: int = BUCKETS) -> None:
        self.keys = [key] if isinstance(key, str) else list(key)
        self.spark, self.name = spark, name
        self.table = _Bucketed(spark, name, self.keys, buckets)
        self.checks = f"{name}_checks"

    def _null(self):
        null = F.lit(False)
        for k in self.keys:
            null = null | F.col(f"`{k}`").isNull()
        return null

    def change(self, drop_rows: DataFrame, drop: str) -> DataFrame:
        """What a drop adds to every count of the report, one row. The ledger
        is read bucket by bucket beside the drop's keys, without a shuffle."""
        new = self.table.counted(drop_rows)
        if not self.table.exists():
            met = new.withColumn("held", F.lit(0).cast("bigint"))
        else:
            held = (self.table.rows().where((F.col("drop") != drop) & ~self._null())
                    .groupBy(*[F.col(f"`{k}`") for k in self.keys]).agg(F.sum("n").alias("held")))
            met = new.join(held, self.keys, "left").withColumn("held", F.coalesce("held", F.lit(0).cast("bigint")))
        null, n, held = self._null(), F.col("n"), F.col("held")
        # a key becomes a duplicate once; then rows that were single count too
        turns = ~null & (held <= 1) & (held + n > 1)
        return met.agg(
            F.coalesce(F.sum(n), F.lit(0)).alias("n_rows"),
            F.coalesce(F.sum(F.when(null, n)), F.lit(0)).alias("null_key_rows"),
            F.count_if(turns).alias("duplicate_keys"),
            F.coalesce(F.sum(F.when(turns, held + n).when(~null & (held > 1), n)), F.lit(0)).alias("duplicate_rows"))

    def add(self, drop_rows: DataFrame, drop: str) -> None:
        """Check a drop against all others, then take its keys in."""
        change = self.change(drop_rows, drop).select(
            *[F.col(c).cast("bigint").alias(c) for c in ("n_rows", "null_key_rows", "duplicate_keys", "duplicate_rows")])
        if self.spark.catalog.tableExists(self.checks):
            _replace_drop(self.spark, self.checks, change, drop)
        else:
            change.withColumn("drop", F.lit(drop)).write.format("parquet").partitionBy("drop").saveAsTable(self.checks)
        self.table.put(self.table.counted(drop_rows), drop)

    def report(self, table_name: str) -> DataFrame:
        """The report over all drops: a sum of one row per drop."""
        out = (self.spark.table(self.checks).agg(*[_sum(c) for c in ("n_rows", "null_key_rows", "duplicate_keys", "duplicate_rows")])
               .select(F.lit(table_name).alias("table_name"), F.lit(",".join(self.keys)).alias("pk"), "*"))
        return out.withColumn("ok", (F.col("null_key_rows") == 0) & (F.col("duplicate_keys") == 0)).select(*PK_REPORT_SCHEMA.names)

    def known(self) -> DataFrame:
        """Distinct non-NULL keys, laid out by bucket."""
        return self.table.rows().where(~self._null()).select(*[F.col(f"`{k}`") for k in self.keys]).distinct()

    def remove(self) -> None:
        self.table.drop()
        self.spark.sql(f"DROP TABLE IF EXISTS {self.checks}")


class ForeignKeyLedger:
    """Orphans of a fact that grows by drops, against a dimension's ledger.

    Only keys that had no match when their drop came are kept; the report asks
    again whether they have one now, both tables being bucketed alike, so
    neither is shuffled. Keys of fact and dimension must be of one type.
    """

    def __init__(self, spark: SparkSession, name: str, fact_column: str, dim: KeyLedger) -> None:
        if len(dim.keys) != 1:
            raise ValueError("a foreign key refers to one column")
        self.dim, self.column = dim, fact_column
        self.table = _Bucketed(spark, name, dim.keys, dim.table.buckets)

    def add(self, fact_rows: DataFrame, drop: str) -> None:
        """Keep the keys of a drop that the dimension lacks so far."""
        key = self.dim.keys[0]
        kind = self.dim.table.rows().schema[key].dataType
        rows = fact_rows.select(F.col(f"`{self.column}`").cast(kind).alias(key)).where(F.col(f"`{key}`").isNotNull())
        if fact_rows.schema[self.column].dataType != kind:
            raise ValueError(f"{self.column} is {fact_rows.schema[self.column].dataType}, {key} is {kind}")
        new = self.table.counted(rows)
        self.table.put(new.join(self.dim.known(), key, "left_anti"), drop)

    def report(self, dim_table: str) -> DataFrame:
        """The row that :func:`lakeloom.operators.integrity.fk_report` would
        give for all drops of fact and dimension together."""
        key = self.dim.keys[0]
        lost = (self.table.rows().groupBy(f"`{key}`").agg(F.sum("n").alias("n")).join(self.dim.known(), key, "left_anti")
                .agg(_sum("n").alias("orphan_rows"), F.count(F.lit(1)).alias("orphan_keys")))
        unique = self.dim.report(dim_table).select(F.col("ok").alias("target_unique"))
        return (lost.crossJoin(F.broadcast(unique))  # one row each
                .select(F.lit(self.column).alias("fk_column"), F.lit(dim_table).alias("dim_table"), F.lit(key).alias("dim_key"),
                        "orphan_rows", "orphan_keys", "target_unique", (F.col("orphan_rows") == 0).alias("ok"))
                .select(*FK_REPORT_SCHEMA.names))

    def remove(self) -> None:
        self.table.drop()
