"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.session import ensure_work_dir, scratch_path, ship_package

# text handed to one vectorised step inside a task
BLOCK_BYTES = 4 << 20


def prepare(spark: SparkSession) -> None:
    """Work folder and importable package; safe to call repeatedly."""
    ensure_work_dir(spark)
    ship_package(spark)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Scratch:
    """Tables written under the shared work folder by one operator run.

    ``write`` cuts lineage: later stages re-read files, so a lost executor
    never repeats what came before. ``drop`` removes a table that no later
    step reads.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = scratch_path(spark, name)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def fold(id_col: Column | str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id falls in fold 0."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % parts, F.lit(0)).cast("int")


def text_blocks(batches: Iterable[pa.RecordBatch], text_col: str = "text",
                max_bytes: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds at most ``max_bytes`` of text (one
    row at least), which bounds the memory of vectorised steps."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        col = batch.column(text_col)
        sizes = np.asarray(pc.fill_null(pc.binary_length(col), 0), dtype=np.int64)
        start, total = 0, 0
        for i in range(n):
            if i > start and total + sizes[i] > max_bytes:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(sizes[i])
        yield batch.slice(start, n - start)


def as_bytes(col: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column, null as empty."""
    return [b if b is not None else b"" for b in col.cast(pa.binary()).to_pylist()]


def packed(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes end to end and the ``len(rows) + 1`` offsets of the rows."""
    offsets = np.zeros(len(rows) + 1, dtype=np.int64)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    return np.frombuffer(b"".join(rows), dtype=np.uint8), offsets


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def bounded_sample(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """At most ``rows`` rows, the smallest by a seeded hash of ``key``:
    deterministic, spread over the table, computed with a bounded heap."""
    return (df.withColumn("_k", F.xxhash64(key, F.lit(20240229)))
            .orderBy("_k", key).limit(rows).drop("_k"))


def train_in_task(sample: DataFrame, fit: Callable[[pa.Table], bytes]) -> bytes:
    """Run ``fit`` over a bounded sample inside one task and fetch the model
    bytes, whose size is set by the model's parameters and not by the data."""
    def run(table: pa.Table) -> pa.Table:
        return pa.table({"model": pa.array([fit(table.drop_columns(["_one"]))], pa.binary())})

    spark = sample.sparkSession
    rows = (sample.withColumn("_one", F.lit(1)).groupBy("_one")
            .applyInArrow(run, "model binary").collect())
    if rows:
        return bytes(rows[0]["model"])
    empty = pa.Table.from_batches([], schema=pa.schema(
        [pa.field(f.name, pa.string() if f.dataType.simpleString() == "string" else pa.int64())
         for f in sample.schema.fields]))
    del spark
    return fit(empty)
