"""Source-file provenance (B1) and file-name attributes (B2)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.spec import SOURCE_FILE_COLUMN

# Raw file names are RD + state + yyMM + extension; a two-digit
# year follows the POSIX %y rule (00-68 -> 20xx, 69-99 -> 19xx).
FILE_NAME_PATTERN = r"^RD([A-Z]{2})([0-9]{2})(0[1-9]|1[0-2])\.[^.]+$"
YY_PIVOT = 68


def with_source_file(df: DataFrame, name: str = SOURCE_FILE_COLUMN) -> DataFrame:
    """Add the base name of each row's input file.

    Must be applied to a file scan before any shuffle or union. Uses the
    hidden ``_metadata.file_name`` column of file sources (no per-row UDF,
    survives column pruning). A frame that has the column already, because
    its reader was asked for it, stays as it is; one that no longer knows its
    files is refused.
    """
    if name in df.columns:
        return df
    try:
        return df.withColumn(name, F.col("_metadata.file_name"))
    except AnalysisException as exc:
        raise ValueError(f"the frame does not know its files: have the reader add {name} (source_file=)") from exc


def file_name_attrs(file_name: Column | str, pattern: str = FILE_NAME_PATTERN) -> dict[str, Column]:
    """State, year and month parsed from a raw file name (``RDSP2301.csv``).

    Returns NULLs for names that do not follow ``pattern``, whose groups are
    place, year and month.
    """
    c = F.col(file_name) if isinstance(file_name, str) else file_name
    matched = c.rlike(pattern)
    uf = F.regexp_extract(c, pattern, 1)
    yy = F.regexp_extract(c, pattern, 2)
    mm = F.regexp_extract(c, pattern, 3)
    return {
        "uf": F.when(matched, uf),
        "ano": F.when(matched, (yy.cast("int") + F.when(yy.cast("int") <= YY_PIVOT, 2000)
                                .otherwise(1900)).cast("int")),
        "mes": F.when(matched, mm.cast("int")),
    }


def with_file_name_attrs(df: DataFrame, file_name: str = SOURCE_FILE_COLUMN,
                         prefix: str = "") -> DataFrame:
    attrs = file_name_attrs(file_name)
    return df.select("*", *[v.alias(prefix + k) for k, v in attrs.items()])
