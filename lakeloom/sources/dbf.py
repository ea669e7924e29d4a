"""DBF (xBase) table scan (A6) as a partitioned Python data source.

Records have a fixed length, so every file is cut into record ranges and
each range becomes one input partition: a large table is read by many tasks
with random-access reads, never streamed through one process. Fields are
decoded column-wise with numpy and handed to Spark as Arrow batches.

    read_dbf(spark, folder)                       # files, headers and ranges found by Spark tasks
    spark.read.format("dbf").load(folder)         # the same as a data source, files listed by the driver

Format (dBase III family): bytes 4-7 record count, 8-9 header length,
10-11 record length (little endian), then 32-byte field descriptors (name
0-10, type 11, length 16, decimals 17) up to a 0x0D byte. Each record starts
with a flag byte, ``*`` marking a deleted record. Byte 29 names the code page.
Memo fields hold a block number of the file beside the table (``.dbt``,
``.fpt``); the blocks that a record range points to are read with it, in the
order of the memo file.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lakeloom import fs as lfs
from lakeloom.session import scratch_path

DEFAULT_PARTITION_BYTES = 128 * 1024 * 1024
MIN_SPLIT_BYTES = 4 * 1024 * 1024


@dataclass(frozen=True)
class DbfField:
    name: str
    type: str
    length: int
    decimals: int
    offset: int  # within the record, after the flag byte


@dataclass(frozen=True)
class DbfHeader:
    n_records: int
    header_len: int
    record_len: int
    fields: tuple[DbfField, ...]
    version: int = 3
    code_page: int = 0


# --- fixed values: code pages by the language byte of the header ---
CODE_PAGES = {
    0x01: "cp437", 0x02: "cp850", 0x03: "cp1252", 0x24: "cp860", 0x25: "cp850", 0x37: "cp850",
    0x57: "cp1252", 0x58: "cp1252", 0x59: "cp1252", 0x64: "cp852", 0x65: "cp866", 0x66: "cp865",
    0x67: "cp861", 0x6A: "cp737", 0x6B: "cp857", 0x78: "cp950", 0x79: "cp949", 0x7A: "cp936",
    0x7B: "cp932", 0x7D: "cp1255", 0x7E: "cp1256", 0xC8: "cp1250", 0xC9: "cp1251", 0xCA: "cp1254", 0xCB: "cp1253",
}
DEFAULT_ENCODING = "latin-1"


def encoding_of(h: DbfHeader, asked: str | None) -> str:
    """The encoding asked for, else the header's code page, else Latin-1."""
    return asked or CODE_PAGES.get(h.code_page, DEFAULT_ENCODING)


def parse_header(head: bytes) -> DbfHeader:
    n_records, header_len, record_len = struct.unpack("<IHH", head[4:12])
    fields = []
    offset = 1
    pos = 32
    while pos + 32 <= len(head) and head[pos] != 0x0D:
        d = head[pos:pos + 32]
        name = d[:11].split(b"\x00", 1)[0].decode("ascii", "replace").strip().lower()
        ftype = chr(d[11]).upper()
        length, decimals = d[16], d[17]
        fields.append(DbfField(name, ftype, length, decimals, offset))
        offset += length
        pos += 32
    return DbfHeader(n_records, header_len, record_len, tuple(fields), head[0], head[29])


def read_header(uri: str) -> DbfHeader:
    fs, p = lfs.resolve(uri)
    with fs.open_input_file(p) as f:
        head = f.read_at(32, 0)
        header_len = struct.unpack("<H", head[8:10])[0]
        return parse_header(f.read_at(max(header_len, 32), 0))


def spark_type(f: DbfField) -> str:
    """Numbers of over 15 digits are exact decimals (bigint up to 18 digits
    without a fraction); binary doubles, currency, times and memos have types
    of their own. A type that this reader does not know is refused."""
    if f.type in ("N", "F"):
        digits = f.length - (1 if f.decimals else 0)
        if f.type == "N" and f.decimals == 0 and f.length <= 18:
            return "bigint"
        if f.type == "F" or digits <= 15:
            return "double"
        return f"decimal({digits},{f.decimals})" if digits <= 38 else "string"
    if f.type == "B" and f.length == 8:
        return "double"
    if f.type in MEMO_TYPES:
        return "string" if f.type == "M" else "binary"
    kinds = {"I": "int", "Y": "decimal(19,4)", "T": "timestamp_ntz", "D": "date", "L": "boolean", "C": "string", "V": "string"}
    if f.type not in kinds:
        raise ValueError(f"field {f.name}: type {f.type!r} is not supported")
    return kinds[f.type]


MEMO_TYPES = ("M", "G", "P", "B")  # B of 8 bytes is a double instead


def is_memo(f: DbfField) -> bool:
    return f.type in MEMO_TYPES and not (f.type == "B" and f.length == 8)


_EXACT = {"int": (10, 0), "bigint": (19, 0)}


def _scale(t: str) -> tuple[int, int] | None:
    """Digits and decimals of an exact number type."""
    if t.startswith("decimal"):
        p, d = t[8:-1].split(",")
        return int(p), int(d)
    return _EXACT.get(t)


def _wider(a: str, b: str, exact: bool) -> str:
    """The type that holds the values of two; ``exact`` says whether every
    bigint among them is exact as a double. What no number, date or flag
    holds alike is text."""
    if a == b:
        return a
    both = {a, b}
    if both <= {"int", "bigint"}:
        return "bigint"
    if both <= {"int", "bigint", "double"} and exact:
        return "double"
    x, y = _scale(a), _scale(b)
    if x and y:
        decimals = max(x[1], y[1])
        digits = max(x[0] - x[1], y[0] - y[1]) + decimals
        if digits <= 38:
            return f"decimal({digits},{decimals})"
    return "string"


def merged_columns(headers: list[DbfHeader]) -> dict[str, str]:
    """Field name -> widest type over all headers, names as they first occur."""
    types: dict[str, str] = {}
    digits: dict[str, int] = {}
    for h in headers:
        if len({f.name for f in h.fields}) < len(h.fields):
            raise ValueError(f"a field name occurs twice: {[f.name for f in h.fields]}")
        for f in h.fields:
            t = spark_type(f)
            if t == "bigint":
                digits[f.name] = max(digits.get(f.name, 0), f.length)
            types.setdefault(f.name, t)
            types[f.name] = _wider(types[f.name], t, digits.get(f.name, 0) <= 15)
    return types


def read_headers(files: list[str]) -> list[DbfHeader]:
    """Headers are tiny; they are read concurrently (object stores have high
    per-request latency)."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=min(32, max(1, len(files)))) as pool:
        return list(pool.map(read_header, files))


_ARROW = {"bigint": pa.int64(), "double": pa.float64(), "int": pa.int32(),
          "date": pa.date32(), "boolean": pa.bool_(), "string": pa.string(),
          "binary": pa.binary(), "timestamp_ntz": pa.timestamp("us")}


def arrow_type(t: str) -> pa.DataType:
    return pa.decimal128(*_scale(t)) if t.startswith("decimal") else _ARROW[t]


_DAY_ZERO = 2440588  # Julian day of 1970-01-01


def _scaled(units: np.ndarray, t: pa.Decimal128Type) -> pa.Array:
    """Whole numbers of the smallest unit as decimals."""
    wide = np.stack([units, units >> 63], axis=1).astype("<i8")  # sign-extended to 128 bits
    return pa.Array.from_buffers(t, len(units), [None, pa.py_buffer(np.ascontiguousarray(wide).tobytes())])


def _binary_field(raw: np.ndarray, f: DbfField, type_name: str) -> pa.Array:
    """Fields whose bytes are a number: whole, double, currency, date and time."""
    data = np.ascontiguousarray(raw).tobytes()
    if f.type == "I":
        own = pa.array(np.frombuffer(data, "<i4"), pa.int32())
    elif f.type == "B":
        own = pa.array(np.frombuffer(data, "<f8"), pa.float64())
    elif f.type == "Y":
        own = _scaled(np.frombuffer(data, "<i8"), pa.decimal128(19, 4))
    else:
        day, ms = np.frombuffer(data, "<i4").reshape(-1, 2).astype(np.int64).T
        own = pa.array((day - _DAY_ZERO) * 86_400_000_000 + ms * 1000, mask=day == 0).cast(pa.timestamp("us"))
    return own.cast(arrow_type(type_name))


def _cells(block: np.ndarray, f: DbfField) -> np.ndarray:
    """The field's bytes for every record as a numpy ``S{length}`` array."""
    return np.ascontiguousarray(block[:, f.offset:f.offset + f.length]).view(f"S{f.length}").ravel()


def _whole(arr) -> pa.Array:
    return arr.combine_chunks() if isinstance(arr, pa.ChunkedArray) else arr


_NULL_TEXT = pa.scalar(None, pa.string())
INT_RE = r"^[+-]?[0-9]+$"
FLOAT_RE = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
DECIMAL_RE = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$"
DATE_RE = r"^[0-9]{8}$"


def _ascii_text(cells: np.ndarray, raw_bytes: np.ndarray) -> pa.Array:
    """Trimmed ASCII cells as Arrow strings; a cell holding any other byte is
    NULL (it cannot be a number, date or flag)."""
    arr = _whole(pa.array(cells, pa.binary()))
    high = (raw_bytes >= 0x80).any(axis=1)
    if high.any():
        arr = pc.if_else(pa.array(high), pa.scalar(None, pa.binary()), arr)
    return arr.cast(pa.string())


def decode_field(block: np.ndarray, f: DbfField, type_name: str, encoding: str) -> pa.Array:
    """Decode one field of every record in ``block`` (column-wise).

    numpy cuts and trims the fixed-width cells; Arrow's vectorised kernels
    validate and convert them, so no Python code runs per value except the
    code-page decoding of text that is not plain ASCII.
    """
    raw_bytes = block[:, f.offset:f.offset + f.length]
    cells = _cells(block, f)
    if f.type in ("I", "Y", "T") or f.type == "B" and f.length == 8:
        return _binary_field(raw_bytes, f, type_name)
    if type_name == "string" and spark_type(f) != "string":
        # text because other files have another type: blank and overflow are NULL
        text = _ascii_text(np.char.strip(cells, b" \x00"), raw_bytes)
        return pc.if_else(pc.match_substring_regex(text, r"^[*]*$"), _NULL_TEXT, text)
    if type_name == "string":
        raw = np.char.rstrip(cells, b" \x00")
        if not (raw_bytes >= 0x80).any():
            # plain ASCII is valid UTF-8 in every supported code page
            return _whole(pa.array(raw, pa.binary())).cast(pa.string())
        return _whole(pa.array([c.decode(encoding, "replace") for c in raw.tolist()], pa.string()))
    text = _ascii_text(np.char.strip(cells, b" \x00"), raw_bytes)
    if type_name == "boolean":
        first = pc.utf8_slice_codeunits(text, 0, 1)
        yes = pc.is_in(first, value_set=pa.array(["T", "t", "Y", "y"]))
        no = pc.is_in(first, value_set=pa.array(["F", "f", "N", "n"]))
        return pc.if_else(yes, True, pc.if_else(no, False, pa.scalar(None, pa.bool_())))
    if type_name == "date":
        ok = pc.match_substring_regex(text, DATE_RE)
        stamp = pc.strptime(pc.if_else(ok, text, _NULL_TEXT), format="%Y%m%d", unit="s",
                            error_is_null=True)
        return stamp.cast(pa.date32())
    # numbers: overflow marks (***) are NULL; a comma is a decimal point
    text = pc.replace_substring(pc.utf8_trim(text, "*"), ",", ".")
    if type_name == "bigint":
        ok = pc.match_substring_regex(text, INT_RE)
        return pc.if_else(ok, text, _NULL_TEXT).cast(pa.int64())
    if type_name.startswith("decimal"):
        ok = pc.match_substring_regex(text, DECIMAL_RE)
        return pc.if_else(ok, text, _NULL_TEXT).cast(arrow_type(type_name))
    ok = pc.match_substring_regex(text, FLOAT_RE)
    return pc.if_else(ok, text, _NULL_TEXT).cast(pa.float64())


# ------------------------------------------------------------------- memos

MEMO_WINDOW = 4 << 20  # bytes of a memo file read at a time


def memo_pointers(block: np.ndarray, f: DbfField) -> np.ndarray:
    """Block number of every record, 0 for none: four bytes, or text."""
    raw = block[:, f.offset:f.offset + f.length]
    if f.length == 4:
        return np.frombuffer(np.ascontiguousarray(raw).tobytes(), "<u4").astype(np.int64)
    text = _ascii_text(np.char.strip(_cells(block, f), b" \x00"), raw)
    ok = pc.match_substring_regex(text, "^[0-9]+$")
    return pc.fill_null(pc.if_else(ok, text, _NULL_TEXT).cast(pa.int64()), 0).to_numpy(zero_copy_only=False)


class MemoFile:
    """The memo file beside a table: fixed-size blocks, a memo starts at one.

    ``.fpt``: block size at byte 6, then per memo its kind and length, big
    endian. ``.dbt`` of version 4 tables (0x8B): block size at byte 20, per
    memo a mark and its length. Other ``.dbt``: blocks of 512 bytes, a memo
    ends at 0x1A."""

    def __init__(self, table_uri: str, version: int) -> None:
        stem = table_uri[:-4]
        found = [u for u in (stem + e for e in (".fpt", ".FPT", ".Fpt", ".dbt", ".DBT", ".Dbt")) if lfs.exists(u)]
        if not found:
            raise FileNotFoundError(f"{table_uri} has memo fields, but no .dbt or .fpt file lies beside it")
        self.uri = found[0]
        self.kind = "fpt" if self.uri.lower().endswith("fpt") else "dbt4" if version == 0x8B else "dbt3"
        fs, p = lfs.resolve(self.uri)
        self.file = fs.open_input_file(p)
        self.size = self.file.size()
        head = self.file.read_at(min(512, self.size), 0)
        at = {"fpt": (">H", 6), "dbt4": ("<H", 20)}.get(self.kind)
        self.block = (struct.unpack_from(at[0], head, at[1])[0] if at and len(head) > at[1] + 1 else 0) or 512
        self.base, self.window = 0, b""

    def _bytes(self, at: int, n: int) -> bytes:
        """``n`` bytes from ``at``; reads come in file order, so most lie in
        the window that is held."""
        if at < self.base or at + n > self.base + len(self.window):
            self.base = at
            self.window = self.file.read_at(max(0, min(max(n, MEMO_WINDOW), self.size - at)), at) if at < self.size else b""
        return self.window[at - self.base:at - self.base + n]

    def _one(self, number: int) -> bytes | None:
        at = number * self.block
        if at >= self.size:
            return None
        if self.kind == "dbt3":
            out = b""
            while True:
                part = self._bytes(at + len(out), min(MEMO_WINDOW, self.size - at - len(out)))
                end = part.find(b"\x1a")
                out += part[:end] if end >= 0 else part
                if end >= 0 or not part:
                    return out
        head = self._bytes(at, 8)
        if len(head) < 8:
            return None
        n = struct.unpack(">I" if self.kind == "fpt" else "<I", head[4:])[0] - (8 if self.kind == "dbt4" else 0)
        data = self._bytes(at + 8, n) if 0 <= n <= self.size - at - 8 else None
        return data

    def read(self, numbers: np.ndarray) -> dict[int, bytes | None]:
        """Memos by block number, each read once, in file order."""
        return {int(k): self._one(int(k)) for k in np.unique(numbers[numbers > 0])}


def memo_field(block: np.ndarray, f: DbfField, memos: MemoFile, type_name: str, encoding: str) -> pa.Array:
    """The memo of every record; NULL where there is none. A pointer beyond
    the memo file, or a memo that ends beyond it, is an error."""
    at = memo_pointers(block, f)
    found = memos.read(at)
    lost = [k for k, v in found.items() if v is None]
    if lost:
        raise ValueError(f"{memos.uri} ends before memo block {lost[0]} of field {f.name}")
    if type_name == "binary":
        return pa.array([found.get(k) for k in at.tolist()], pa.binary())
    text = {k: v.decode(encoding, "replace") for k, v in found.items()}
    return pa.array([text.get(k) for k in at.tolist()], pa.string())


def encode_memos(texts: list[bytes | None], kind: str = "fpt", block: int = 64) -> tuple[bytes, list[int]]:
    """A memo file and the block number of every text (used to build test files)."""
    block = 512 if kind == "dbt3" else block
    out = bytearray(512)
    if kind == "fpt":
        struct.pack_into(">H", out, 6, block)
    elif kind == "dbt4":
        struct.pack_into("<H", out, 20, block)
    numbers = []
    for t in texts:
        if t is None:
            numbers.append(0)
            continue
        out += b"\x00" * (-len(out) % block)
        numbers.append(len(out) // block)
        if kind == "fpt":
            out += struct.pack(">II", 1, len(t)) + t
        elif kind == "dbt4":
            out += b"\xff\xff\x08\x00" + struct.pack("<I", len(t) + 8) + t
        else:
            out += t + b"\x1a\x1a"
    return bytes(out), numbers


def encode_records(rows: list[tuple], fields: list[DbfField], encoding: str = "latin-1",
                   deleted: list[bool] | None = None) -> bytes:
    """Render records as DBF bytes (used to build test files)."""
    out = bytearray()
    for i, row in enumerate(rows):
        out += b"*" if deleted and deleted[i] else b" "
        for f, v in zip(fields, row):
            if v is None:
                cell = (b"\x00" if f.type in "IYTB" or f.length == 4 and f.type == "M" else b" ") * f.length
            elif f.type == "I":
                cell = struct.pack("<i", v)
            elif f.type == "B" and f.length == 8:
                cell = struct.pack("<d", v)
            elif f.type == "Y":
                cell = struct.pack("<q", round(v * 10_000))
            elif f.type == "T":
                ms = ((v.hour * 60 + v.minute) * 60 + v.second) * 1000 + v.microsecond // 1000
                cell = struct.pack("<ii", v.toordinal() - 719163 + _DAY_ZERO, ms)
            elif is_memo(f):
                cell = struct.pack("<I", v) if f.length == 4 else str(v).encode("ascii").rjust(f.length)
            elif f.type in ("N", "F"):
                txt = f"{v:.{f.decimals}f}" if f.decimals else str(int(v))
                cell = txt.encode("ascii").rjust(f.length)
            elif f.type == "D":
                cell = v.strftime("%Y%m%d").encode("ascii")
            elif f.type == "L":
                cell = b"T" if v else b"F"
            else:
                cell = str(v).encode(encoding).ljust(f.length)
            out += cell[:f.length]
    return bytes(out)


def encode_header(n_records: int, fields: list[DbfField], version: int = 0x03, code_page: int = 0) -> bytes:
    record_len = 1 + sum(f.length for f in fields)
    header_len = 32 + 32 * len(fields) + 1
    head = bytearray(struct.pack("<BBBBIHH", version, 124, 1, 1, n_records, header_len, record_len))
    head += b"\x00" * 17 + bytes([code_page]) + b"\x00" * 2
    for f in fields:
        name = f.name.upper().encode("ascii")[:10].ljust(11, b"\x00")
        head += name + f.type.encode("ascii") + b"\x00" * 4 + bytes([f.length, f.decimals]) + b"\x00" * 14
    head += b"\x0d"
    return bytes(head)


def dbf_fields(spec: list[tuple[str, str, int, int]]) -> list[DbfField]:
    """``[(name, type, length, decimals)]`` -> fields with offsets."""
    out, offset = [], 1
    for name, t, length, dec in spec:
        out.append(DbfField(name, t, length, dec, offset))
        offset += length
    return out


def encode_dbf(rows: list[tuple], fields: list[DbfField], encoding: str = "latin-1",
               deleted: list[bool] | None = None, version: int = 0x03, code_page: int = 0) -> bytes:
    return encode_header(len(rows), fields, version, code_page) + encode_records(rows, fields, encoding, deleted) + b"\x1a"


@dataclass(frozen=True)
class DbfRange(InputPartition):
    path: str
    first: int
    count: int


class DbfReader(DataSourceReader):
    def __init__(self, options, schema):
        # option names are case-insensitive; look them up lower-cased
        opts = {k.lower(): v for k, v in options.items()}
        self.path = opts.get("path") or opts.get("paths")
        self.encoding = opts.get("encoding")
        self.partition_bytes = int(opts.get("partitionbytes", DEFAULT_PARTITION_BYTES))
        self.min_partitions = int(opts.get("minpartitions", 1))
        self.file_name_column = opts.get("filenamecolumn")
        self.schema = schema

    def partitions(self):
        files = lfs.list_files(self.path, (".dbf",))
        headers = read_headers(files)
        # like Spark's file sources: ranges of at most partitionBytes, but
        # small enough that every core gets work (not below MIN_SPLIT_BYTES)
        # the file's size says how many records there are; the count in a
        # header may be stale (an end-of-file mark still ends the table)
        counts = [max(0, (lfs.size(u) - h.header_len) // max(h.record_len, 1))
                  for u, h in zip(files, headers)]
        total = sum(n * h.record_len for n, h in zip(counts, headers))
        split = min(self.partition_bytes,
                    max(MIN_SPLIT_BYTES, total // max(self.min_partitions, 1)))
        parts = []
        for uri, h, n in zip(files, headers, counts):
            per = max(1, split // max(h.record_len, 1))
            for first in range(0, n, per):
                parts.append(DbfRange(uri, first, min(per, n - first)))
        return parts or [DbfRange("", 0, 0)]

    def read(self, partition: DbfRange):
        if not partition.path or partition.count == 0:
            return
        columns = [(f.name, f.dataType.simpleString()) for f in self.schema.fields]
        yield read_range(partition.path, partition.first, partition.count, columns, self.encoding, self.file_name_column)


def read_range(path: str, first: int, count: int, columns: list[tuple[str, str]], encoding: str | None,
               file_name_column: str | None = None) -> pa.RecordBatch:
    """Some records of one file under the columns of the whole table; fields
    that the file lacks are NULL, deleted records are left out."""
    h = read_header(path)
    page = encoding_of(h, encoding)
    fs, p = lfs.resolve(path)
    with fs.open_input_file(p) as fh:
        data = fh.read_at(count * h.record_len, h.header_len + first * h.record_len)
    n = len(data) // h.record_len
    block = np.frombuffer(data[: n * h.record_len], dtype=np.uint8).reshape(n, h.record_len)
    # an end-of-file mark inside the range ends the table early
    eof = np.nonzero(block[:, 0] == 0x1A)[0]
    if len(eof):
        block = block[: eof[0]]
    block = block[block[:, 0] != ord("*")]
    by_name = {f.name: f for f in h.fields}
    memos = MemoFile(path, h.version) if len(block) and any(is_memo(by_name[c]) for c, _ in columns if c in by_name) else None
    arrays = []
    for name, t in columns:
        f = by_name.get(name)
        if name == file_name_column:
            arrays.append(pa.array([path.rstrip("/").rsplit("/", 1)[-1]] * len(block), pa.string()))
        elif f is None or not len(block):
            arrays.append(pa.nulls(len(block), arrow_type(t)))
        elif is_memo(f):
            arrays.append(memo_field(block, f, memos, t, page))
        else:
            arrays.append(decode_field(block, f, t, page))
    return pa.RecordBatch.from_arrays(arrays, schema=pa.schema([(c, arrow_type(t)) for c, t in columns]))


class DbfDataSource(DataSource):
    """``format("dbf")``: one file or a folder of ``*.dbf`` (any case). The
    schema merges all headers: every field name, in its widest type (text
    where types do not go together); files bind by field name, a field that a
    file lacks is NULL. Options: ``encoding`` (default: code page of the header, else
    latin-1), ``partitionBytes``
    (largest record range, default 128 MB), ``minPartitions`` (spread small
    tables over this many tasks), ``fileNameColumn`` (adds each row's base
    file name)."""

    @classmethod
    def name(cls):
        return "dbf"

    def schema(self):
        path = self.options.get("path") or self.options.get("paths")
        files = lfs.list_files(path, (".dbf",))
        if not files:
            raise FileNotFoundError(f"no .dbf files under {path}")
        cols = [f"`{n}` {t}" for n, t in merged_columns(read_headers(files)).items()]
        if self.options.get("fileNameColumn"):
            cols.append(f"`{self.options['fileNameColumn']}` string")
        return ", ".join(cols)

    def reader(self, schema):
        return DbfReader(self.options, schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(DbfDataSource)


MAX_LAYOUTS = 512
DBF_GLOB = "*.[dD][bB][fF]"
_FILES = "path string, header binary, records bigint, record_len bigint"


def _headers(batches):
    """Field descriptors of every file and how many records its size says it
    has (the count in a header may be stale)."""
    for b in batches:
        rows = []
        for path in b.column("path").to_pylist():
            fs, p = lfs.resolve(path)
            with fs.open_input_file(p) as f:
                head_len = struct.unpack("<H", f.read_at(32, 0)[8:10])[0]
                head = f.read_at(max(head_len, 32), 0)
                h = parse_header(head)
                n = max(0, (f.size() - h.header_len) // max(h.record_len, 1))
                # the fields alone: files of one layout share them
                rows.append((path, head[32:], n, max(h.record_len, 1)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary()),
             pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int64())],
            names=["path", "header", "records", "record_len"])


def read_dbf(spark: SparkSession, path: str, encoding: str | None = None,
             partition_bytes: int = DEFAULT_PARTITION_BYTES,
             file_name_column: str | None = None, recursive: bool = False) -> DataFrame:
    """One ``.dbf`` file, or all of a folder (``recursive``: and of those
    below), as one table.

    Spark lists the files and its tasks read the headers; the driver gets only
    the different layouts, at most ``MAX_LAYOUTS``. Columns are every field
    name in the widest type over all headers, bound by name; a field that a
    file lacks is NULL. Files are cut into record ranges of at most
    ``partition_bytes`` that are spread over the tasks whatever file they are
    from. ``encoding`` overrides the code page that a header names (Latin-1 if
    it names none). Deleted records are left out.
    """
    register(spark)  # format("dbf") from here on, too
    single = path.lower().endswith(".dbf")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if not single:
        reader = reader.option("pathGlobFilter", DBF_GLOB)
    files = reader.load(path).select("path")
    place = f"{scratch_path(spark, 'dbf-headers')}/files"
    headers = files.mapInArrow(_headers, _FILES)
    headers.write.parquet(place)
    headers = spark.read.schema(headers.schema).parquet(place)
    layouts = [bytes(r.header) for r in headers.select("header").distinct().limit(MAX_LAYOUTS + 1).collect()]
    if not layouts:
        raise FileNotFoundError(f"no .dbf files under {path}")
    if len(layouts) > MAX_LAYOUTS:
        raise ValueError(f"more than {MAX_LAYOUTS} different layouts under {path}")
    # in the order of the first file of each, so that columns do not depend on chance
    first = {bytes(r.header): r.path for r in headers.groupBy("header").agg(F.min("path").alias("path")).collect()}
    parsed = [parse_header(bytes(32) + x) for x in sorted(layouts, key=first.get)]
    columns = list(merged_columns(parsed).items())
    if file_name_column:
        columns.append((file_name_column, "string"))

    try:
        cores = spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - no context under Spark Connect
        cores = 1
    total = headers.agg(F.sum(F.col("records") * F.col("record_len"))).first()[0] or 0
    split = max(1, min(partition_bytes, max(MIN_SPLIT_BYTES, total // max(cores, 1))))
    per = F.greatest(F.lit(1), F.floor(F.lit(split) / F.col("record_len"))).cast("bigint")
    ranges = (headers.where("records > 0").withColumn("per", per)
              .select("path", "records", "per", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("records") - 1, F.col("per"))).alias("first"))
              .select("path", "first", F.least("per", F.col("records") - F.col("first")).alias("count")))
    parts = int(max(1, min(ranges.count(), max(cores, -(-total // split)))))

    def run(batches):
        for b in batches:
            for p, a, n in zip(*(b.column(c).to_pylist() for c in ("path", "first", "count"))):
                yield read_range(p, a, n, columns, encoding, file_name_column)

    schema = ", ".join(f"`{n}` {t}" for n, t in columns)
    return ranges.repartition(parts, "path", "first").mapInArrow(run, schema)
