"""Fixed-width text scans (A4, A5) with B7 slicing and B8 strict integers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.text import fixed_width_field, is_blank, strict_int


@dataclass(frozen=True)
class FixedField:
    start: int   # 0-based first character
    size: int
    name: str
    type: str    # "int" or "string"


# --- fixed values: layouts of the lookup files (0-based start, size) ---
MUNICIPALITY_LAYOUT = (
    FixedField(0, 7, "id", "int"),
    FixedField(9, 6, "cod_ibge", "int"),
    FixedField(16, 43, "municipio", "string"),
)
STATE_LAYOUT = (
    FixedField(0, 7, "id", "int"),
    FixedField(9, 2, "cod_ibge", "string"),
    FixedField(12, 43, "nome", "string"),
)
# The code column of the nationality file sits at characters 60-62 of its
# lines; the source system read it from 61, which cuts "286" to "86".
# ``nationality_layout(61)`` reproduces that behaviour.
NATIONALITY_COD_START = 60


def nationality_layout(cod_start: int = NATIONALITY_COD_START) -> tuple[FixedField, ...]:
    return (
        FixedField(0, 7, "id", "int"),
        FixedField(7, 43, "descricao", "string"),
        FixedField(cod_start, 3, "cod", "int"),
    )


NATIONALITY_LAYOUT = nationality_layout()

# Lookup files are Latin-1 and use the .cnv extension in either case.
LOOKUP_ENCODING = "ISO-8859-1"
CNV_GLOB = "*.{cnv,CNV}"


def decode_lines(spark: SparkSession, path: str | list[str], encoding: str,
                 glob: str | None = None, ignore_corrupt: bool = False) -> DataFrame:
    """Lines of text files as ``line`` (decoded) and ``file_name``.

    The text source splits on LF / CRLF / CR and hands back the raw bytes of
    each line, so casting to binary and decoding recovers any single-byte
    encoding exactly. Large files are split across tasks. A file that cannot
    be read to its end fails the job; ``ignore_corrupt`` keeps what could be
    read of it instead.
    """
    reader = spark.read.format("text")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if ignore_corrupt:
        reader = reader.option("ignoreCorruptFiles", True)
    raw = reader.load(path)
    return raw.select(
        F.decode(F.col("value").cast("binary"), encoding).alias("line"),
        F.col("_metadata.file_name").alias("file_name"),
    )


def parse_lines(lines: DataFrame, layout: tuple[FixedField, ...], carry: tuple[str, ...] = ()) -> DataFrame:
    """Slice every field once, then derive the typed values and two row
    flags: ``__valid`` (every int field blank or an integer) and ``__blank``
    (every field blank). ``carry`` names further columns of the lines to keep."""
    # The slices go through a one-row generator so each is computed once per
    # line: plain projections would be inlined into every use (validity,
    # blank flag, typed value and the pushed-down filter), repeating the
    # string work several times per field.
    sliced = lines.select(
        "line", "file_name", *carry,
        F.inline(F.array(F.struct(*[fixed_width_field("line", f.start, f.size).alias(f"__raw_{f.name}")
                                    for f in layout]))))
    valid = F.lit(True)
    all_blank = F.lit(True)
    typed = []
    for f in layout:
        raw = F.col(f"__raw_{f.name}")
        all_blank = all_blank & is_blank(raw)
        if f.type == "int":
            valid = valid & (is_blank(raw) | strict_int(raw).isNotNull())
            typed.append(strict_int(raw).alias(f.name))
        else:
            typed.append(raw.alias(f.name))
    return sliced.select("line", "file_name", *carry, *typed,
                         valid.alias("__valid"), all_blank.alias("__blank"))


def read_fixed_width(spark: SparkSession, path: str | list[str],
                     layout: tuple[FixedField, ...], encoding: str = "UTF-8",
                     glob: str | None = None, keep_blank_rows: bool = False,
                     with_file_name: bool = False, ignore_corrupt: bool = False) -> DataFrame:
    """Parse fixed-width files by a layout.

    String fields keep leading spaces, lose trailing whitespace and have
    commas turned into spaces. Integer fields are blank (NULL) or a whole
    integer; any other value rejects the whole line. Lines whose fields are
    all blank are dropped unless ``keep_blank_rows``. Works on one file or a
    folder (``glob`` e.g. :data:`CNV_GLOB`). An unreadable file fails the job
    unless ``ignore_corrupt``, which keeps the lines read before the fault.
    """
    parsed = parse_lines(decode_lines(spark, path, encoding, glob, ignore_corrupt), layout)
    keep = F.col("__valid") if keep_blank_rows else (F.col("__valid") & ~F.col("__blank"))
    out = [f.name for f in layout] + (["file_name"] if with_file_name else [])
    return parsed.filter(keep).select(*out)


def fixed_width_rejects(spark: SparkSession, path: str | list[str],
                        layout: tuple[FixedField, ...], encoding: str = "UTF-8",
                        glob: str | None = None) -> DataFrame:
    """Lines that failed integer validation, with their file: the audit trail
    for rows the scan drops."""
    parsed = parse_lines(decode_lines(spark, path, encoding, glob), layout)
    return parsed.filter(~F.col("__valid")).select("file_name", "line")


def fixed_width_file_report(spark: SparkSession, path: str | list[str],
                            layout: tuple[FixedField, ...], encoding: str = "UTF-8",
                            glob: str | None = None) -> DataFrame:
    """Per input file: lines read, rows kept, lines rejected for a bad
    integer and all-blank lines dropped. One aggregation (partial before the
    shuffle) over the parsed lines."""
    parsed = parse_lines(decode_lines(spark, path, encoding, glob), layout)
    valid, blank = F.col("__valid"), F.col("__blank")
    return parsed.groupBy("file_name").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count(F.when(valid & ~blank, 1)).alias("kept"),
        F.count(F.when(~valid, 1)).alias("rejected"),
        F.count(F.when(valid & blank, 1)).alias("blank"),
    )
