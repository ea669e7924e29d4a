"""CSV records over file splits: line breaks inside quotes without giving up
splittable scans, and files whose headers differ.

A line read on its own does not say whether it starts inside a quoted value of
an earlier line. But whichever way it starts, it ends inside or outside, so a
line, and a whole split, is a function from {outside, inside} to itself. A
first pass composes these functions split by split, where lines without a
quote change nothing; prefix sums over the splits of a file then give the side
on which every split starts. The second pass joins lines to records split by
split, each knowing where it starts. Only records that cross the edge of a
split leave it as fragments, which are stitched by file position.

The first pass also takes the header of every file, so files are known by
layout before they are parsed.
"""

from __future__ import annotations

import csv as _csv
import io
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeloom.session import scratch_path

# file (hash of its path), layout and file name beside the values of a record
FILE, LAYOUT, NAME = "__file", "__layout", "__name"
MAX_LAYOUTS = 512  # different headers of one table
BROADCAST_SPLITS = 1 << 20  # rows (24 bytes each) of the split table that go by broadcast
_WIDE = re.compile("utf-?(16|32)", re.I)


class QuoteRules:
    """Where a line ends, inside or outside of quotes, by where it starts.

    A value is quoted if it starts with a quote; a doubled quote inside is
    data; what follows the closing quote up to the separator belongs to the
    value, and quotes within an unquoted value are data."""

    def __init__(self, sep: str = ",") -> None:
        if len(sep) != 1:
            raise ValueError("line breaks inside quotes need a separator of one character")
        s = re.escape(sep)
        inside = r'[^"]*+(?:""[^"]*+)*+'
        field = rf'(?:"{inside}"[^{s}]*+|[^"{s}][^{s}]*+|)'
        opens = rf'(?:{field}{s})*+"{inside}\Z'
        self._from_out = re.compile(opens)
        self._from_in = re.compile(rf'{inside}(?:\Z|"[^{s}]*+{s}{opens})')

    def ends_inside(self, line: str, inside: bool) -> bool:
        return bool((self._from_in if inside else self._from_out).match(line))


@dataclass(frozen=True)
class Survey:
    """What the first pass found: the splits of all files and where they
    start, the layouts (lower-cased header names) in order, and whether any
    record holds a line break."""
    splits: DataFrame          # file, start, inside, layout
    layouts: list[tuple[str, ...]]
    headers: int               # different header texts
    line_breaks: bool
    crossing: bool             # a record is open at the end of its split


def _lines(spark: SparkSession, path: str | list[str], encoding: str, glob: str | None, recursive: bool) -> DataFrame:
    """Lines cut at LF only, so that line breaks within a value stay as they
    are, with the file (hash of its path) and the split they were read from."""
    if _WIDE.match(encoding):
        raise ValueError(f"{encoding} files cannot be cut at line ends; convert them to UTF-8")
    r = spark.read.format("text").option("lineSep", "\n")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    raw = r.load(path)
    value = F.col("value")
    if encoding.upper().replace("_", "-") in ("UTF-8", "UTF8"):
        value = F.make_valid_utf8(value)
    else:
        value = F.decode(value.cast("binary"), encoding)
    return raw.select(value.alias("line"), F.xxhash64("_metadata.file_path").alias("file"),
                      F.col("_metadata.file_block_start").alias("start"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], int, int]]:
    """(file, start) of every run of lines of one split, and the run."""
    file = batch.column("file").to_numpy()
    start = batch.column("start").to_numpy()
    edges = np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1
    bounds = [0, *edges.tolist(), len(file)]
    for a, z in zip(bounds[:-1], bounds[1:]):
        if z > a:
            yield (int(file[a]), int(start[a])), a, z


def _survey_splits(sep: str):
    rules = QuoteRules(sep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = None
        ends = [False, True]  # where the split ends if it starts outside, inside
        breaks = False  # a line that starts outside ends inside, or a value holds a carriage return
        header: list[str] = []
        open_header = False

        def row():
            text = "\n".join(header).removesuffix("\r").removeprefix("﻿") if header else None
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([ends[0]]),
                 pa.array([ends[1]]), pa.array([breaks]), pa.array([text], pa.string())],
                names=["file", "start", "from_out", "from_in", "breaks", "header"])

        for batch in batches:
            line = batch.column("line")
            quoted = np.flatnonzero(pc.fill_null(pc.match_substring(line, '"'), False).to_numpy(zero_copy_only=False))
            for at, a, z in _runs(batch):
                if at != key:
                    if key is not None:
                        yield row()
                    key, ends, breaks, header = at, [False, True], False, []
                    open_header = at[1] == 0
                lo, hi = np.searchsorted(quoted, [a, z])
                if open_header:
                    # the header is the first record that is not blank
                    for k in range(a, z):
                        text = line[k].as_py()
                        if not header and not text.strip("﻿ \t\r"):
                            continue
                        inside = rules.ends_inside(text, bool(header))
                        header.append(text)
                        if not inside:
                            open_header = False
                            break
                for k in quoted[lo:hi].tolist():
                    text = line[k].as_py()
                    out = rules.ends_inside(text, False)
                    after = [rules.ends_inside(text, True) if e else out for e in ends]
                    breaks = breaks or (not ends[0] and after[0]) or "\r" in text[:-1]
                    ends = after
        if key is not None:
            yield row()

    return run


def survey(spark: SparkSession, path: str | list[str], sep: str = ",", encoding: str = "UTF-8",
           glob: str | None = None, recursive: bool = False) -> Survey:
    """The first pass: one scan of all files. Only lines with a quote and
    those of a file's first split travel to Python; the rest are counted as
    unchanged. The result, a row per split, is written to the work folder."""
    lines = _lines(spark, path, encoding, glob, recursive)
    seen = lines.select(F.when(F.contains("line", F.lit('"')) | (F.col("start") == 0), F.col("line")).alias("line"),
                        "file", "start")
    found = seen.mapInArrow(_survey_splits(sep), "file bigint, start bigint, from_out boolean, from_in boolean, "
                                                 "breaks boolean, header string")
    root = scratch_path(spark, "csv-survey")
    found.write.parquet(f"{root}/found")
    found = spark.read.schema(found.schema).parquet(f"{root}/found")

    headers = [r.header for r in found.where("header IS NOT NULL").select("header").distinct().limit(MAX_LAYOUTS + 1).collect()]
    if len(headers) > MAX_LAYOUTS:
        raise ValueError(f"more than {MAX_LAYOUTS} different headers below {path}")
    names = {h: header_names(h, sep) for h in headers}
    layouts = sorted(set(names.values()))
    number = {n: i for i, n in enumerate(layouts)}

    # side on which a split starts: that of the last split which ends on one
    # side whatever came before, turned by every later split that swaps
    past = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    fixed = F.col("from_out") == F.col("from_in")
    swaps = F.sum(F.when(F.col("from_out") & ~F.col("from_in"), 1).otherwise(0)).over(
        Window.partitionBy("file").orderBy("start"))
    before = found.withColumn("swaps", swaps)
    start_in = before.withColumn("side", F.last(F.when(fixed, F.col("from_out").cast("int")), True).over(past)).withColumn(
        "at", F.last(F.when(fixed, F.col("swaps")), True).over(past)).withColumn("upto", F.last("swaps").over(past))
    turns = F.coalesce("upto", F.lit(0)) - F.coalesce("at", F.lit(0))
    inside = (F.coalesce("side", F.lit(0)) + turns) % 2 == 1
    layout = F.lit(None).cast("int")
    for h in headers:
        layout = F.when(F.col("header") == h, F.lit(number[names[h]])).otherwise(layout)
    splits = start_in.select("file", "start", inside.alias("inside"),
                             F.max(layout).over(whole).alias("layout"),
                             (F.col("breaks") | inside).alias("breaks"),
                             F.when(inside, F.col("from_in")).otherwise(F.col("from_out")).alias("open"))
    splits.write.parquet(f"{root}/splits")
    splits = spark.read.schema(splits.schema).parquet(f"{root}/splits")
    any_ = splits.agg(F.max("breaks").alias("breaks"), F.max("open").alias("open")).first()
    return Survey(splits.drop("breaks", "open"), layouts, len(headers), bool(any_.breaks), bool(any_.open))


def header_names(header: str, sep: str = ",") -> tuple[str, ...]:
    """Lower-cased names of a header record; a repeated name gets its
    position, a missing one is called by it."""
    row = next(_csv.reader(io.StringIO(header, newline=""), delimiter=sep), [])
    low = [c.strip().lower() for c in row]
    return tuple(c if c and low.count(c) == 1 else f"{c or '_c'}{k}" for k, c in enumerate(low))


def _join_lines(sep: str, fragments: bool):
    """Records of every split: the whole ones, or the fragments of those that
    cross its edges (1: from an earlier split, 2: into a later one)."""
    rules = QuoteRules(sep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = layout = None
        open_: list[str] | None = None  # lines of the record that is open
        foreign = header = False  # the open record began before the split; it is the header

        def emit(texts, part=0):
            n = len(texts)
            return pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(key[0], pa.int64()), n), pa.repeat(pa.scalar(key[1], pa.int64()), n),
                 pa.repeat(pa.scalar(layout, pa.int32()), n), pa.repeat(pa.scalar(part, pa.int32()), n),
                 texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())],
                names=["file", "start", "layout", "part", "rec"])

        def edge():
            if fragments and open_ is not None and not header:
                return emit(["\n".join(open_)], 1 if foreign else 2)
            return None

        for batch in batches:
            line = batch.column("line")
            quoted = np.flatnonzero(pc.match_substring(line, '"').to_numpy(zero_copy_only=False))
            for at, a, z in _runs(batch):
                if at != key:
                    last = edge() if key is not None else None
                    if last is not None:
                        yield last
                    key, layout = at, batch.column("layout")[a].as_py()
                    foreign = batch.column("inside")[a].as_py()
                    open_ = [] if foreign else None
                    header = at[1] == 0
                keep = np.ones(z - a, bool)
                joined: list[str] = []
                k = a
                if header and open_ is None:
                    # up to the first line of the header record
                    while k < z and not line[k].as_py().strip("﻿ \t\r"):
                        keep[k - a] = False
                        k += 1
                    if k < z:
                        keep[k - a] = False
                        if rules.ends_inside(line[k].as_py(), False):
                            open_ = []
                        else:
                            header = False
                        k += 1
                lo, hi = np.searchsorted(quoted, [k, z])
                upto = k  # lines before are dealt with
                for q in quoted[lo:hi].tolist():
                    text = line[q].as_py()
                    if open_ is None:
                        if rules.ends_inside(text, False):
                            open_, upto = [text], q + 1
                            keep[q - a] = False
                        continue
                    open_ += line.slice(upto, q - upto).to_pylist()
                    open_.append(text)
                    keep[upto - a:q + 1 - a] = False
                    upto = q + 1
                    if not rules.ends_inside(text, True):
                        if foreign:
                            if fragments:
                                yield emit(["\n".join(open_)], 1)
                        elif not header:
                            joined.append("\n".join(open_))
                        open_, foreign, header = None, False, False
                if open_ is not None:
                    open_ += line.slice(upto, z - upto).to_pylist()
                    keep[upto - a:] = False
                if not fragments:
                    whole = line.slice(a, z - a)
                    if not keep.all():
                        whole = whole.filter(pa.array(keep))
                    if len(whole):
                        yield emit(whole)
                    if joined:
                        yield emit(joined)
        last = edge() if key is not None else None
        if last is not None:
            yield last

    return run


_REC = "file bigint, start bigint, layout int, part int, rec string"


def records(spark: SparkSession, found: Survey, path: str | list[str], sep: str = ",", encoding: str = "UTF-8",
            glob: str | None = None, recursive: bool = False) -> DataFrame:
    """The second pass: file, layout and text (``rec``) of every record of
    every file, without headers and blank records.

    Lines meet the split table by broadcast (a row per split, its count is
    checked); a split that the first pass has not seen, because files came or
    Spark cuts them differently now, fails the job. Records that cross splits
    are stitched before this returns, by a scan of its own that only runs
    where there are any, and are read from the work folder.
    """
    lines = _lines(spark, path, encoding, glob, recursive)
    known = found.splits
    if known.count() <= BROADCAST_SPLITS:
        known = F.broadcast(known)
    else:
        # joined by shuffle, lines would lose their order
        raise ValueError(f"more than {BROADCAST_SPLITS} splits: raise spark.sql.files.maxPartitionBytes")
    lost = F.raise_error(F.lit("CSV files or their splits changed since they were surveyed: read them again"))
    placed = lines.join(known, ["file", "start"], "left").select(
        "line", "file", "start", F.when(F.col("inside").isNull(), lost).otherwise(F.col("inside")).cast("boolean").alias("inside"),
        "layout")
    out = placed.mapInArrow(_join_lines(sep, False), _REC).select("file", "layout", "rec")
    if found.crossing:
        parts = placed.mapInArrow(_join_lines(sep, True), _REC)
        by_file = Window.partitionBy("file").orderBy("start", "part")
        stitched = (parts.withColumn("record", F.sum(F.when(F.col("part") == 2, 1).otherwise(0)).over(by_file))
                    .groupBy("file", "layout", "record")
                    .agg(F.sort_array(F.collect_list(F.struct("start", "part", "rec"))).alias("parts"))
                    .select("file", "layout", F.array_join(F.transform("parts", lambda p: p["rec"]), "\n").alias("rec")))
        place = f"{scratch_path(spark, 'csv-stitched')}/records"
        stitched.write.parquet(place)
        out = out.unionByName(spark.read.schema(stitched.schema).parquet(place))
    ended = F.when(F.endswith("rec", F.lit("\r")), F.expr("left(rec, char_length(rec) - 1)")).otherwise(F.col("rec"))
    # a record of blanks is none; Java's blanks are all up to the space
    return out.where(F.col("rec").rlike("[^\\x00-\\x20]")).select(
        F.col("file").alias(FILE), F.col("layout").alias(LAYOUT), ended.alias("rec"))


def fields(recs: DataFrame, names: list[str], sep: str = ",") -> DataFrame:
    """The first ``len(names)`` values of every record as text columns beside
    file and layout: missing ones are NULL, further ones are dropped.
    A record is parsed once, whatever number of columns is used."""
    schema = ", ".join("`" + n.replace("`", "``") + "` string" for n in names)
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    return recs.select(FILE, LAYOUT, F.inline(F.array(F.from_csv("rec", schema, options))))


def file_names(spark: SparkSession, path: str | list[str], glob: str | None, recursive: bool) -> DataFrame:
    """Number and name of every file, by a listing."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    return r.load(path).select(F.xxhash64("_metadata.file_path").alias(FILE), F.col("_metadata.file_name").alias(NAME))


def union_by_name(values: DataFrame, layouts: list[tuple[str, ...]], positions: list[str]) -> DataFrame:
    """Text columns of all layouts by name, in the order in which the first
    layouts name them; a file without a column gives NULL."""
    order: list[str] = []
    for names in layouts:
        order += [n for n in names if n not in order]
    out = []
    for n in order:
        value: Column = F.lit(None).cast("string")
        for k, names in enumerate(layouts):
            if n in names:
                value = F.when(F.col(LAYOUT) == k, F.col(positions[names.index(n)])).otherwise(value)
        out.append(value.alias(n))
    return values.select(FILE, *out)
