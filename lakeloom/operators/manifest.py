"""The file manifest: period x state grid (C4), skip what landed (C2),
coverage status (C5) and the any-new-data gate (D2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lakeloom.functions.files import extension_is, swap_extension
from lakeloom.functions.text import parse_state_list

# Raw file names are "RD" + state + yyMM + extension, and the
# four coverage states in order of precedence.
FILE_PREFIX = "RD"
RAW_EXTENSION = "dbc"
STATUS_IGNORED = "ignored"
STATUS_EXISTS = "exists"
STATUS_SUCCESS = "success"
STATUS_ERROR = "error"

GRID_SCHEMA = T.StructType([
    T.StructField("seq", T.IntegerType(), False),
    T.StructField("uf", T.StringType(), False),
    T.StructField("ano", T.IntegerType(), False),
    T.StructField("mes", T.IntegerType(), False),
    T.StructField("aamm", T.StringType(), False),
    T.StructField("file_name", T.StringType(), False),
])


def _as_int(v) -> int | None:
    try:
        return int(v)
    except (TypeError, ValueError):
        return None


def period_state_grid_from(df: DataFrame, start_month: Column, end_month: Column,
                           states: Column, prefix: str = FILE_PREFIX,
                           extension: str = RAW_EXTENSION) -> DataFrame:
    """Expected files for every row of ``df`` that describes a work set.

    Months run from ``start_month`` to ``end_month`` inclusive (an empty range
    when start is after end); each month is paired with each state in list
    order; ``seq`` numbers the pairs month-major. The grid is generated by
    two explodes inside one task per input row -- it is parameter-sized, so
    no shuffle and no join is involved.
    """
    months = F.when(start_month <= end_month,
                    F.sequence(start_month, end_month, F.expr("INTERVAL 1 MONTH")))
    base = df.select(F.posexplode(F.coalesce(months, F.array().cast("array<date>"))).alias("mi", "month"),
                     states.alias("__states"))
    base = base.select("mi", "month", F.size("__states").alias("__ns"),
                       F.posexplode("__states").alias("si", "uf"))
    aamm = F.date_format("month", "yyMM")
    return base.select(
        (F.col("mi") * F.col("__ns") + F.col("si")).cast("int").alias("seq"),
        F.col("uf"),
        F.year("month").cast("int").alias("ano"),
        F.month("month").cast("int").alias("mes"),
        aamm.alias("aamm"),
        F.concat(F.lit(prefix), F.col("uf"), aamm, F.lit("." + extension)).alias("file_name"),
    )


def period_state_grid_rows(period: DataFrame, states: DataFrame, start_month: str = "first", end_month: str = "last",
                           state: str = "uf", prefix: str = FILE_PREFIX, extension: str = RAW_EXTENSION) -> DataFrame:
    """The grid of one period (a row with its first and last month) and the
    states of a table: trimmed, upper-cased, blanks dropped, each once, in
    order of their names.

    States stay rows: they are numbered by a window and joined with the months,
    both of the size of the grid's sides and broadcast by their measured size.
    """
    name = F.upper(F.trim(F.col(state)))
    uf = states.select(name.alias("uf")).where(F.col("uf") != "").distinct()
    order = Window.partitionBy(F.lit(1)).orderBy("uf")
    numbered = uf.select("uf", F.row_number().over(order).alias("si"), F.count(F.lit(1)).over(Window.partitionBy(F.lit(1))).alias("ns"),
                         F.lit(1).alias("__one"))
    months = F.when(F.col(start_month) <= F.col(end_month),
                    F.sequence(F.col(start_month), F.col(end_month), F.expr("INTERVAL 1 MONTH")))
    months = period.select(F.posexplode(F.coalesce(months, F.array().cast("array<date>"))).alias("mi", "month"), F.lit(1).alias("__one"))
    aamm = F.date_format("month", "yyMM")
    return months.join(numbered, "__one").select(
        (F.col("mi") * F.col("ns") + F.col("si") - 1).cast("int").alias("seq"), "uf",
        F.year("month").cast("int").alias("ano"), F.month("month").cast("int").alias("mes"), aamm.alias("aamm"),
        F.concat(F.lit(prefix), F.col("uf"), aamm, F.lit("." + extension)).alias("file_name"))


def period_state_grid(spark: SparkSession, start_year, start_month, end_year, end_month,
                      states: str | Sequence[str] | None, prefix: str = FILE_PREFIX,
                      extension: str = RAW_EXTENSION) -> DataFrame:
    """Expected raw files for a work set given as plain parameters.

    Years and months may be text or numbers; any of them missing or not a
    number, or no states, gives an empty grid (not an error). ``states`` is
    a comma-separated text or a list; entries are trimmed, upper-cased and
    blanks dropped.
    """
    sy, sm, ey, em = (_as_int(v) for v in (start_year, start_month, end_year, end_month))
    if isinstance(states, (list, tuple)):
        states_text = ",".join(str(s) for s in states)
    else:
        states_text = "" if states is None else str(states)
    if None in (sy, sm, ey, em) or not (1 <= sm <= 12 and 1 <= em <= 12):
        return spark.createDataFrame([], GRID_SCHEMA)
    params = spark.createDataFrame(
        [(sy, sm, ey, em, states_text)],
        "sy int, sm int, ey int, em int, states string")
    return period_state_grid_from(
        params,
        F.make_date("sy", "sm", F.lit(1)),
        F.make_date("ey", "em", F.lit(1)),
        parse_state_list("states"),
        prefix, extension)


def landed_as_raw(names: DataFrame, name_col: str = "file_name", landed_ext: str = "csv",
                  raw_ext: str = RAW_EXTENSION) -> DataFrame:
    """Landed file names mapped to the raw names they came from: keep
    ``*.csv`` (any case), swap the extension to ``.dbc``; distinct."""
    return (names.filter(extension_is(name_col, landed_ext))
            .select(swap_extension(name_col, raw_ext).alias("file_name"))
            .distinct())


def skip_landed(expected: DataFrame, landed_raw_names: DataFrame) -> DataFrame:
    """Expected files that have not landed yet (anti-join on file name)."""
    return expected.join(landed_raw_names.select("file_name"), "file_name", "left_anti")


RANK_IGNORED, RANK_EXISTS, RANK_SUCCESS = 1, 2, 3


def coverage_status_ranked(grid: DataFrame, ranked: DataFrame) -> DataFrame:
    """Status of each expected file from ``ranked`` = ``(file_name, rank)``
    with one row per file name, rank 1 = ignored, 2 = exists, 3 = success
    (smallest wins); files without a row are ``error``. One join; the
    grid's row count is unchanged."""
    status = (F.when(F.col("__k") == RANK_IGNORED, F.lit(STATUS_IGNORED))
              .when(F.col("__k") == RANK_EXISTS, F.lit(STATUS_EXISTS))
              .when(F.col("__k") == RANK_SUCCESS, F.lit(STATUS_SUCCESS))
              .otherwise(F.lit(STATUS_ERROR)))
    return (grid.join(ranked.select("file_name", F.col("rank").alias("__k")), "file_name", "left")
            .select(*grid.columns, status.alias("status")))


def coverage_status(grid: DataFrame, ignored: DataFrame, staged: DataFrame,
                    arrived: DataFrame) -> DataFrame:
    """Status of each expected file, first that applies:
    ``ignored`` (in the skip list), ``exists`` (already staged), ``success``
    (arrived in this batch), ``error`` (expected but absent).

    Each set is a one-column frame of file names. The three sets are tagged
    with their rank, unioned and folded to the best rank per file name (one
    aggregation, partial before the shuffle), then joined to the grid once.
    """
    tagged = (ignored.select("file_name", F.lit(RANK_IGNORED).alias("rank"))
              .unionByName(staged.select("file_name", F.lit(RANK_EXISTS).alias("rank")))
              .unionByName(arrived.select("file_name", F.lit(RANK_SUCCESS).alias("rank"))))
    return coverage_status_ranked(grid, tagged.groupBy("file_name").agg(F.min("rank").alias("rank")))


def any_new_data(status: DataFrame) -> DataFrame:
    """One row: did at least one expected file arrive in this batch?"""
    return status.agg(
        F.coalesce(F.bool_or(F.col("status") == F.lit(STATUS_SUCCESS)), F.lit(False))
        .alias("any_new_data"))


def should_load_fact(status: DataFrame) -> bool:
    """Driver-side gate for the fact load; reads one aggregated row."""
    return bool(any_new_data(status).first()["any_new_data"])
