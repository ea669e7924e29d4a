"""CSV scans: declared schema (A1), inferred schema (A2), many files as one table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.coerce import apply_spec
from lakeloom.functions.inference import infer_types
from lakeloom.functions.provenance import with_source_file
from lakeloom.sources.records import FILE, NAME, fields, file_names, records, survey, union_by_name

# How this library writes and reads CSV, everywhere.
CSV_DIALECT = {"header": "true", "sep": ",", "quote": '"', "escape": '"'}

# For callers who want only files with the extension; by default every file
# of the folder is read.
CSV_GLOB = "*.{csv,CSV}"


def _reader(spark: SparkSession, sep: str, encoding: str, glob: str | None, recursive: bool):
    r = (spark.read.options(**CSV_DIALECT).option("sep", sep).option("encoding", encoding)
         .option("mode", "PERMISSIVE"))
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    return r


def _named(df: DataFrame, spark: SparkSession, path, glob: str | None, recursive: bool,
           source_file: str | None) -> DataFrame:
    """The frame with the name of every row's file instead of its number."""
    if source_file is None:
        return df.drop(FILE)
    names = file_names(spark, path, glob, recursive).withColumnRenamed(NAME, source_file)
    return df.join(names, FILE).drop(FILE)


def read_declared_csv(spark: SparkSession, path: str | list[str],
                      columns: Iterable[tuple[str, str]], sep: str = ",",
                      encoding: str = "UTF-8", glob: str | None = None,
                      recursive: bool = False, line_breaks: bool = True,
                      source_file: str | None = None) -> DataFrame:
    """Scan CSV files under a declared column list.

    Columns bind by position, never by header name (every file's header line
    is consumed). Each field is read as text and then retyped with
    ``try_cast``: a value that does not fit its type becomes NULL and the row
    is kept. Missing trailing fields are NULL, extra fields are ignored.
    Quote-aware, so separators and line breaks inside quotes stay in their
    field. Every file below ``path`` is read unless ``glob`` picks some.

    The scan is splittable, so one large file is read by many tasks. Whether
    values hold line breaks is found out by a pass of its own when this is
    called (:mod:`lakeloom.sources.records`); files without any are then read
    by Spark's reader alone. ``line_breaks=False`` saves that pass for files
    known to have none: there, a line break ends the record.

    ``source_file`` names a column for the file of every row; asking for it
    here works whichever way the files are read.
    """
    spec = list(columns)
    names = [n for n, _ in spec]
    if line_breaks:
        found = survey(spark, path, sep, encoding, glob, recursive)
        if found.line_breaks:
            recs = records(spark, found, path, sep, encoding, glob, recursive)
            positions = [f"_p{k}" for k in range(len(names))]
            values = fields(recs, positions, sep).select(FILE, *[F.col(p).alias(n) for p, n in zip(positions, names)])
            named = _named(values, spark, path, glob, recursive, source_file)
            return apply_spec(named, spec, keep_extra=True)
    text_schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
    raw = (_reader(spark, sep, encoding, glob, recursive)
           .option("enforceSchema", True)
           .schema(text_schema)
           .csv(path))
    if source_file is not None:
        return apply_spec(with_source_file(raw, source_file), spec, keep_extra=True)
    return apply_spec(raw, spec)


def read_inferred_csv(spark: SparkSession, path: str | list[str], sep: str = ",",
                      encoding: str = "UTF-8", glob: str | None = None,
                      sampling_ratio: float = 1.0, recursive: bool = False,
                      source_file: str | None = None) -> DataFrame:
    """Scan CSV files whose types are inferred from the data; names are
    lower-cased.

    Files may differ in their headers: columns bind by name, a column that a
    file lacks is NULL, and a column's type is the least that holds its values
    in all files (whole numbers widen to bigint, exact decimal, double; dates
    to timestamps; what does not go together is text). Columns come in the
    order of the layouts sorted by their names. Line breaks inside quotes stay
    in their value.

    Inference costs extra passes: one for headers and line breaks, one for the
    types of the values (``sampling_ratio`` < 1 takes a sample for that). Files
    of one header without line breaks are read by Spark's reader.
    """
    found = survey(spark, path, sep, encoding, glob, recursive)
    if found.headers <= 1 and not found.line_breaks:
        df = (_reader(spark, sep, encoding, glob, recursive)
              .option("inferSchema", True)
              .option("samplingRatio", sampling_ratio)
              .csv(path))
        if source_file is None:
            return df.toDF(*[c.lower() for c in df.columns])
        return with_source_file(df, source_file).toDF(*[c.lower() for c in df.columns], source_file)
    recs = records(spark, found, path, sep, encoding, glob, recursive)
    positions = [f"_p{k}" for k in range(max(map(len, found.layouts)))]
    text = union_by_name(fields(recs, positions, sep), found.layouts, positions)
    spec = infer_types(text, [c for c in text.columns if c != FILE], sampling_ratio)
    return apply_spec(_named(text, spark, path, glob, recursive, source_file), spec, keep_extra=True)
