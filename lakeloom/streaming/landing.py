"""Incremental landing of raw files (C2 as a stream).

A file stream with ``trigger(availableNow=True)`` processes every file that
arrived since the last run exactly once -- the stream's checkpoint records
which files were taken -- then stops. Rows are typed by the declared column
list and tagged with their source file on the way in.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.coerce import apply_spec
from lakeloom.sources.csv import CSV_DIALECT
from lakeloom.spec import SOURCE_FILE_COLUMN

# files are copied with times of their own; a file never taken is new,
# however old it is
NO_AGE_LIMIT = "36500d"
PROGRESS_KEPT = "spark.sql.streaming.numRecentProgressUpdates"


def land_new_files(spark: SparkSession, raw_dir: str, columns: Iterable[tuple[str, str]],
                   out_dir: str, checkpoint_dir: str, glob: str | None = None,
                   max_files_per_trigger: int | None = None,
                   source_col: str = SOURCE_FILE_COLUMN) -> int:
    """Land every not-yet-landed CSV file of ``raw_dir`` into parquet at
    ``out_dir``; returns the number of rows landed by this run.

    ``checkpoint_dir`` must live in the shared work folder: it is what makes
    a re-run skip files already landed, and what lets a run that lost an
    executor or the driver resume without duplicating output.
    """
    spec = list(columns)
    text_schema = T.StructType([T.StructField(n, T.StringType(), True) for n, _ in spec])
    reader = (spark.readStream.format("csv").schema(text_schema)
              .options(**CSV_DIALECT).option("enforceSchema", True)
              .option("maxFileAge", NO_AGE_LIMIT))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.load(raw_dir)
    typed = apply_spec(raw.withColumn(source_col, F.col("_metadata.file_name")),
                       spec + [(source_col, "string")])
    # a run keeps the progress of all its batches, so that every row counts
    kept = spark.conf.get(PROGRESS_KEPT)
    spark.conf.set(PROGRESS_KEPT, str(2**31 - 1))
    try:
        query = (typed.writeStream.format("parquet")
                 .option("path", out_dir)
                 .option("checkpointLocation", checkpoint_dir)
                 .trigger(availableNow=True)
                 .start())
        query.awaitTermination()
    finally:
        spark.conf.set(PROGRESS_KEPT, kept)
    landed = 0
    for p in query.recentProgress:
        landed += int(p.get("numInputRows", 0) if isinstance(p, dict) else p.numInputRows)
    return landed
