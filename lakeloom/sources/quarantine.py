"""Folders of fixed-width files where a bad file is set aside whole (A5).

A fault in the middle of a file does not show in the lines read before it. So
lines are written to the work folder with the bytes each took, and a file
counts as read only if its lines account for all of its bytes and every one of
them decodes. Rows of other files never reach the caller, and the report says
why.
"""

from __future__ import annotations

import bz2
import gzip
import io
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.session import scratch_path
from lakeloom.sources.fixed_width import LOOKUP_ENCODING, FixedField, parse_lines

# lookup files, plain or compressed
FOLDER_GLOB = "*.{cnv,CNV,cnv.gz,CNV.gz,cnv.bz2,CNV.bz2}"
PACKED = r"(?i)\.(gz|bz2)$"
UNCHECKED = r"(?i)\.(deflate|lz4|snappy|zst|zstd)$"
PACKED_BYTES = 1 << 30  # a compressed file over this is refused: it is unpacked in one task


@dataclass(frozen=True)
class FolderLoad:
    """``rows`` of all files that could be read, with ``file_name``; ``report``
    (file_name, status, lines, kept, rejected, blank, reason), a row per file:
    ``read``, ``rejected`` (read, but some lines are not valid) or ``failed``."""
    rows: DataFrame
    report: DataFrame


def _decodable(value: Column, encoding: str) -> Column:
    """Does the line hold text of this encoding?"""
    name = encoding.upper().replace("_", "-")
    if name in ("ISO-8859-1", "LATIN-1", "LATIN1"):
        return F.lit(True)
    if name in ("UTF-8", "UTF8"):
        return F.is_valid_utf8(value)
    if name in ("US-ASCII", "ASCII"):
        return F.is_valid_utf8(value) & (F.octet_length(value) == F.char_length(value))
    raise ValueError(f"unsupported encoding {encoding}: ISO-8859-1, UTF-8 or US-ASCII")


def _java_name(encoding: str) -> str:
    name = encoding.upper().replace("_", "-")
    return {"LATIN-1": "ISO-8859-1", "LATIN1": "ISO-8859-1", "UTF8": "UTF-8", "ASCII": "US-ASCII"}.get(name, name)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Length of every compressed file's content, or what is wrong with it."""
    for b in batches:
        sizes, faults = [], []
        for path, content in zip(b.column("path").to_pylist(), b.column("content")):
            packed = io.BytesIO(content.as_py())
            stream = gzip.GzipFile(fileobj=packed) if path.lower().endswith(".gz") else bz2.BZ2File(packed)
            n, fault = 0, None
            try:
                while part := stream.read(1 << 20):
                    n += len(part)
            except (OSError, EOFError, ValueError, gzip.zlib.error) as exc:
                fault = f"cannot be unpacked: {type(exc).__name__}"
            sizes.append(n)
            faults.append(fault)
        yield pa.RecordBatch.from_arrays([b.column("path"), pa.array(sizes, pa.int64()), pa.array(faults, pa.string())],
                                         names=["path", "unpacked", "fault"])


def load_fixed_width_folder(spark: SparkSession, path: str, layout: tuple[FixedField, ...],
                            encoding: str = LOOKUP_ENCODING, glob: str = FOLDER_GLOB,
                            keep_blank_rows: bool = False) -> FolderLoad:
    """Read a folder of fixed-width files of one layout, setting bad files aside.

    A file fails if it cannot be read to its end, if a line is no text of the
    encoding or if it cannot be unpacked; it then gives no rows at all, and
    the others are loaded. Lines with an invalid integer are counted as
    rejected and dropped, all-blank ones are dropped unless
    ``keep_blank_rows``. Lines end with LF, CRLF or CR.

    The raw files are read once, split like any text; compressed ones (gzip,
    bzip2) once more to be checked. The parsed lines are written to the work
    folder and read again. Files without a byte are in no listing of Spark and in
    no report. A missing folder is an error, an empty one gives an
    empty report.
    """
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path))
    files = listing.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file_name"), "length")
    packed = (listing.where(F.col("path").rlike(PACKED) & (F.col("length") <= PACKED_BYTES))
              .select(F.col("_metadata.file_path").alias("path"), "content")
              .mapInArrow(_unpacked, "path string, unpacked bigint, fault string"))
    raw = (spark.read.format("text").option("lineSep", "\n").option("pathGlobFilter", glob)
           .option("ignoreCorruptFiles", True).load(path))
    good = _decodable(F.col("value"), encoding)
    text = F.when(good, F.decode(F.col("value").cast("binary"), _java_name(encoding)))
    pieces = F.posexplode(F.split(F.regexp_replace(F.coalesce(text, F.lit("")), "\r$", ""), "\r")).alias("_n", "line")
    lines = raw.select(F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_name").alias("file_name"),
                       good.alias("_good"), (F.octet_length("value") + 1).cast("bigint").alias("_size"), pieces)
    lines = lines.withColumn("_size", F.when(F.col("_n") == 0, F.col("_size")).otherwise(0))
    parsed = parse_lines(lines, layout, carry=("_path", "_good", "_size"))
    root = scratch_path(spark, "folder")
    parsed.drop("line").write.parquet(f"{root}/lines")
    parsed = spark.read.schema(parsed.drop("line").schema).parquet(f"{root}/lines")

    valid, blank = F.col("__valid"), F.col("__blank")
    counts = parsed.groupBy(F.col("_path").alias("path")).agg(
        F.sum("_size").alias("bytes"), F.count_if(~F.col("_good")).alias("undecoded"),
        F.count(F.lit(1)).alias("lines"), F.count_if(valid & ~blank).alias("kept"),
        F.count_if(~valid).alias("rejected"), F.count_if(valid & blank).alias("blank"))
    told = files.join(packed, "path", "left").join(counts, "path", "left")
    is_packed = F.col("path").rlike(PACKED)
    whole = F.when(is_packed, F.col("unpacked")).otherwise(F.col("length"))
    got = F.coalesce("bytes", F.lit(0))
    reason = (F.when(F.col("path").rlike(UNCHECKED), F.lit("compression that cannot be checked"))
              .when(is_packed & (F.col("length") > PACKED_BYTES), F.lit("too large to be checked"))
              .when(F.col("fault").isNotNull(), F.col("fault"))
              # the last line may lack its end
              .when((whole != got) & (whole != got - 1), F.concat(F.least(got, whole).cast("string"), F.lit(" of "),
                                                                  whole.cast("string"), F.lit(" bytes could be read")))
              .when(F.col("undecoded") > 0, F.concat(F.col("undecoded").cast("string"), F.lit(" lines are not "),
                                                     F.lit(_java_name(encoding)))))
    zero = F.lit(0).cast("bigint")
    count = [F.when(F.col("reason").isNull(), F.coalesce(c, zero)).otherwise(zero).alias(c)
             for c in ("lines", "kept", "rejected", "blank")]
    report = told.withColumn("reason", reason).select(
        "path", "file_name",
        F.when(F.col("reason").isNotNull(), "failed").when(F.col("rejected") > 0, "rejected").otherwise("read").alias("status"),
        *count, "reason")
    report.write.parquet(f"{root}/report")
    report = spark.read.schema(report.schema).parquet(f"{root}/report")

    keep = valid if keep_blank_rows else valid & ~blank
    failed = report.where("status = 'failed'").select(F.col("path").alias("_path"))
    rows = parsed.where(keep).join(failed, "_path", "left_anti")
    return FolderLoad(rows.select(*[f.name for f in layout], "file_name"), report.drop("path"))
