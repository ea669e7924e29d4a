"""File listings as DataFrames (landed-file sets for C2 / C5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EMPTY = T.StructType([T.StructField("file_name", T.StringType(), True),
                       T.StructField("path", T.StringType(), True)])


def list_files(spark: SparkSession, path: str, glob: str | None = None,
               recursive: bool = True) -> DataFrame:
    """Names and paths of the files under ``path``.

    Uses the binary-file source with only ``path`` selected, so file contents
    are never read; listing is parallelised by Spark for large trees. A
    missing folder is an empty set (nothing landed yet), not an error.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        df = reader.load(path)
    except Exception as exc:  # noqa: BLE001 - missing path means "nothing landed"
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return spark.createDataFrame([], _EMPTY)
        raise
    return df.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), "path")
