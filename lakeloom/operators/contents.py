"""What landed files held (C2, C5): a ledger of name, length and digest, so
that a file delivered again with other content is told from one that is there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom import hadoop
from lakeloom import fs as lfs
from lakeloom.operators.manifest import STATUS_ERROR, STATUS_EXISTS, STATUS_IGNORED, STATUS_SUCCESS

STATUS_CHANGED = "changed"  # landed before, and delivered again with other content
CHUNK = 64 << 20  # bytes of a file that one task digests at a time
READ = 4 << 20

CONTENT_SCHEMA = T.StructType([T.StructField("file_name", T.StringType()), T.StructField("length", T.LongType()),
                               T.StructField("digest", T.StringType())])


def file_contents(spark: SparkSession, path: str, glob: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """(path, file_name, length, digest) of every file below ``path``.

    A file is digested in chunks by as many tasks: its digest is the SHA-256
    of the SHA-256 of its chunks in order, so it depends on ``chunk``. A task
    holds ``READ`` bytes at a time. Files without a byte are in no listing; a
    missing folder is an error.
    """
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    files = r.load(path).select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), "length")
    pieces = files.select("path", "file_name", "length", F.explode(
        F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(chunk).cast("bigint"))).alias("first"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for p, first in zip(b.column("path").to_pylist(), b.column("first").to_pylist()):
                fs, local = lfs.resolve(p)
                h, at, end = hashlib.sha256(), first, first + chunk
                with fs.open_input_file(local) as f:
                    while at < end and (part := f.read_at(min(READ, end - at), at)):
                        h.update(part)
                        at += len(part)
                out.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], names=[*b.schema.names, "part"])

    dealt = pieces.repartition("path", "first")
    parts = dealt.mapInArrow(digest, "path string, file_name string, length bigint, first bigint, part string")
    return parts.groupBy("path", "file_name", "length").agg(
        F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("first", "part"))), lambda p: p["part"]), ""), 256)
        .alias("digest"))


def record_landed(spark: SparkSession, ledger: str, contents: DataFrame, drop: str) -> None:
    """Take what a drop landed into the ledger folder; a drop recorded again
    replaces what it recorded before. Drops are ordered by their names."""
    contents.select(*CONTENT_SCHEMA.names).write.mode("overwrite").parquet(f"{ledger.rstrip('/')}/drop={drop}")


def landed_contents(spark: SparkSession, ledger: str) -> DataFrame:
    """What each landed file held when it landed last, one row per name; empty
    before the first drop."""
    if not hadoop.exists(spark, ledger):
        return spark.createDataFrame([], CONTENT_SCHEMA)
    schema = T.StructType([*CONTENT_SCHEMA.fields, T.StructField("drop", T.StringType())])
    return (spark.read.schema(schema).parquet(ledger).groupBy("file_name")
            .agg(F.max(F.struct("drop", "length", "digest")).alias("last"))
            .select("file_name", "last.length", "last.digest"))


def coverage_status_by_content(grid: DataFrame, ignored: DataFrame, landed: DataFrame, arrived: DataFrame) -> DataFrame:
    """Status of each expected file, first that applies: ``ignored`` (in the
    skip list), ``changed`` (landed before and arrived with other content),
    ``exists`` (landed, and arrived alike or not at all), ``success`` (arrived
    and not landed), ``error`` (expected but absent).

    ``landed`` and ``arrived`` are (file_name, length, digest). A name that
    arrives twice with different contents is ``changed`` as well. The sets are
    folded to one row per name, summed within each task before the shuffle,
    and joined to the grid once.
    """
    def tagged(df: DataFrame, tag: str) -> DataFrame:
        content = F.struct("length", "digest") if tag != "ignored" else F.lit(None).cast("struct<length:bigint,digest:string>")
        return df.select("file_name", *[(content if t == tag else F.lit(None).cast("struct<length:bigint,digest:string>")).alias(t)
                                        for t in ("landed", "arrived")], F.lit(tag == "ignored").alias("ignored"))

    seen = tagged(ignored, "ignored").unionByName(tagged(landed, "landed")).unionByName(tagged(arrived, "arrived"))
    per = seen.groupBy("file_name").agg(
        F.max("ignored").alias("__ignored"), F.max("landed").alias("__landed"),
        F.min("arrived").alias("__first"), F.max("arrived").alias("__last"))
    twice = F.col("__first") != F.col("__last")
    other = F.col("__landed").isNotNull() & (F.col("__landed") != F.col("__last"))
    status = (F.when(F.col("__ignored"), STATUS_IGNORED)
              .when(twice | other, STATUS_CHANGED)
              .when(F.col("__landed").isNotNull(), STATUS_EXISTS)
              .when(F.col("__last").isNotNull(), STATUS_SUCCESS)
              .otherwise(STATUS_ERROR))
    return grid.join(per, "file_name", "left").select(*grid.columns, status.alias("status"))
