"""Exact substring deduplication over bytes by deep-shallow suffix sorting.

A byte is removed if a ``depth``-byte string covering it also starts in a
document with a smaller id. Sorting every suffix of the corpus would move the
text fifty times over; only suffixes that can be equal need to meet:

1. Every ``depth``-byte string is filed under the smallest 16-byte gram inside
   it. Neighbouring strings mostly share that gram, so each run of them is one
   piece of at most 84 bytes, and equal strings always lie in pieces of one
   gram. A task sends its distinct pieces to the bucket of their gram; a piece
   it saw in a smaller document already is settled on the spot.
2. A bucket settles equal pieces, then sorts the suffixes of the pieces that
   still share a gram (multikey quicksort, then blind tries) and marks every
   string whose class has a smaller document.
3. Marked spans go back to their documents by id.
"""

from __future__ import annotations

import hashlib
import math
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm.common import Scratch, as_bytes, text_blocks
from lakeloom.llm.suffixes import GRAM, equal_classes, window_grams

DEPTH = 50
LAST_ID = (1 << 63) - 1  # stands for a null id: no document has a larger one
CHUNK = 1 << 18  # bytes sampled at a time, so that work arrays stay in cache
MAP_BYTES = 8 << 20
LEVEL = 6  # of the compression of pieces


def pieces_of(data: np.ndarray, ends: np.ndarray, depth: int):
    """Maximal runs of string starts that share a gram: arrays start, stop
    (first and one past the last string start), gram position and gram hash.
    ``ends`` are the documents' ends in ``data``."""
    n = len(data) - depth + 1
    z = np.zeros(0, np.int64)
    if n <= 0:
        return z, z, z, z.astype(np.uint64)
    ok = np.ones(n + 1, bool)
    for e in ends.tolist():  # strings that cross a document's end
        ok[max(0, e - depth + 1):min(e, n)] = False
    starts, grams, values = [z], [z], [z.astype(np.uint64)]
    last = -1
    for a in range(0, n, CHUNK):
        z = min(n, a + CHUNK)
        p, v = window_grams(data[a:z + depth - 1], depth)
        p += a
        edge = np.empty(z - a, bool)
        edge[0] = p[0] != last or a == 0 or ok[a] != ok[a - 1]
        edge[1:] = (p[1:] != p[:-1]) | (ok[a + 1:z] != ok[a:z - 1])
        at = np.flatnonzero(edge)
        starts.append(at + a)
        grams.append(p[at])
        values.append(v[at])
        last = int(p[-1])
    start, gram, value = (np.concatenate(x) for x in (starts, grams, values))
    stop = np.r_[start[1:], n]
    m = ok[start]
    return start[m], stop[m], gram[m], value[m]


def merge_spans(doc: np.ndarray, a: np.ndarray, z: np.ndarray):
    """Union of [a, z) per document, sorted; touching spans become one."""
    if len(doc) == 0:
        return doc, a, z
    o = np.lexsort((a, doc))
    doc, a, z = doc[o], a[o], z[o]
    # running maximum of ends, restarted per document
    base = (np.cumsum(np.r_[0, doc[1:] != doc[:-1]])) * (1 << 40)
    top = np.maximum.accumulate(z + base) - base
    new = np.r_[True, (doc[1:] != doc[:-1]) | (a[1:] > top[:-1])]
    first = np.flatnonzero(new)
    return doc[first], a[first], top[np.r_[first[1:], len(doc)] - 1]


def _pack(parts: list[np.ndarray], types: list) -> bytes:
    """Columns end to end, compressed. Wide integers are stored as differences
    to the value before, byte plane by byte plane, which leaves mostly zeros."""
    out = [np.array([len(p) for p in parts], np.int64).tobytes()]
    for p, t in zip(parts, types):
        p = np.ascontiguousarray(p, t)
        if p.itemsize > 1 and len(p):
            p = np.diff(p, prepend=p.dtype.type(0)).view(np.uint8).reshape(len(p), -1).T
        out.append(p.tobytes())
    return zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(out))


def _unpack(blob: bytes, types: list) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    sizes = np.frombuffer(raw, np.int64, len(types))
    out, at = [], 8 * len(types)
    for n, t in zip(sizes.tolist(), types):
        width = np.dtype(t).itemsize
        p = np.frombuffer(raw, np.uint8, n * width, at)
        if width > 1:
            p = np.cumsum(np.ascontiguousarray(p.reshape(width, n).T).view(t).ravel(), dtype=t)
        out.append(p)
        at += n * width
    return out


# entries: piece length, gram offset, text; references: entry, start;
# an entry's document (all its references lie in it); documents: id, check
_TYPES = [np.uint8, np.uint8, np.uint8, np.int32, np.int64, np.int32, np.int64, np.uint32]
# spans settled in the task: document, start, end
_SPAN_TYPES = [np.int64, np.uint32, np.int64, np.int64]


def _rows(*cols: np.ndarray) -> Iterator[tuple]:
    """Rows of equally long arrays as Python numbers, some at a time."""
    for i in range(0, len(cols[0]), 1 << 14):
        yield from zip(*[c[i:i + (1 << 14)].tolist() for c in cols])


def _map_block(rows: list[tuple[int, int, bytes]], depth: int, buckets: int):
    """(bucket, pieces blob, spans blob) rows of one block of documents."""
    rows.sort(key=lambda r: r[0])
    sizes = np.array([len(r[2]) for r in rows], np.int64)
    ends = np.cumsum(sizes)
    raw = b"".join(r[2] for r in rows)
    start, stop, gram, value = pieces_of(np.frombuffer(raw, np.uint8), ends, depth)
    doc = np.searchsorted(ends, start, side="right")
    ids = np.array([r[0] for r in rows], np.int64)
    checks = np.array([r[1] for r in rows], np.uint32)
    begins = ends - sizes

    seen: dict[bytes, int] = {}
    entry, entries, entry_doc = np.full(len(start), -1, np.int64), array("q"), array("q")
    texts: list[bytes] = []
    settled = np.zeros(len(start), bool)
    id_list = ids.tolist()
    for i, (a, z, d) in enumerate(_rows(start, stop + depth - 1, doc)):
        s = raw[a:z]
        e = seen.setdefault(s, len(entries))
        if e == len(entries):
            entries.append(i)
            entry_doc.append(d)
            texts.append(s)
        elif entry_doc[e] != d:
            if id_list[entry_doc[e]] < id_list[d]:
                settled[i] = True
                continue
            # another row of the same id: an entry of its own
            e = len(entries)
            entries.append(i)
            entry_doc.append(d)
            texts.append(s)
        entry[i] = e
    del seen
    entries, entry_doc = (np.array(x, np.int64) for x in (entries, entry_doc))
    sd, sa, sz = merge_spans(doc[settled], start[settled], stop[settled] + depth - 1)
    spans = _pack([ids[sd], checks[sd], sa - begins[sd], sz - begins[sd]], _SPAN_TYPES) if len(sd) else None

    first = entries
    bucket = (value[first] % np.uint64(buckets)).astype(np.int64) if len(first) else np.zeros(0, np.int64)
    refs = np.flatnonzero(entry >= 0)
    by_bucket = np.argsort(bucket, kind="stable")
    ref_order = refs[np.argsort(entry[refs], kind="stable")]
    ref_entry = entry[ref_order]
    cut = np.searchsorted(bucket[by_bucket], np.arange(buckets + 1)) if buckets < len(first) else None
    present = range(buckets) if cut is not None else np.unique(bucket).tolist()
    e_doc = entry_doc
    r_lo = np.searchsorted(ref_entry, np.arange(len(first)))
    r_hi = np.searchsorted(ref_entry, np.arange(len(first)), side="right")
    for b in present:
        es = by_bucket[cut[b]:cut[b + 1]] if cut is not None else by_bucket[bucket[by_bucket] == b]
        if len(es) == 0:
            continue
        at = first[es]
        n = (stop[at] + depth - 1 - start[at])
        text = np.frombuffer(b"".join([texts[e] for e in es.tolist()]), np.uint8)
        counts = r_hi[es] - r_lo[es]
        ridx = np.repeat(r_lo[es] - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(counts.sum())
        used, local = np.unique(e_doc[es], return_inverse=True)
        ref_at = start[ref_order[ridx]] - np.repeat(begins[e_doc[es]], counts)
        yield b, _pack([n.astype(np.uint8), (gram[at] - start[at]).astype(np.uint8), text,
                        np.repeat(np.arange(len(es)), counts).astype(np.int32), ref_at,
                        local.astype(np.int32), ids[used], checks[used]], _TYPES), spans
        spans = None
    if spans is not None:
        yield 0, None, spans


def _settle_bucket(blobs: list[bytes], depth: int):
    """Marked spans (id, check, start, end) of one bucket of pieces."""
    cols: list[list[np.ndarray]] = [[] for _ in _TYPES]
    n_entry = n_doc = 0
    for blob in blobs:
        part = _unpack(blob, _TYPES)
        part[3] = part[3] + np.int32(n_entry)
        part[5] = part[5] + np.int32(n_doc)
        n_entry += len(part[0])
        n_doc += len(part[6])
        for c, p in zip(cols, part):
            c.append(p)
    length, rel, text, ref_entry, ref_at, e_doc, ids, checks = (np.concatenate(c) for c in cols)
    del cols, blobs
    length = length.astype(np.int64)
    off = np.cumsum(length) - length
    # pieces of one gram, met by two or more ids
    g = off + rel
    key = np.zeros(len(g), np.uint64)
    for k in range(0, GRAM, 8):
        w = np.zeros(len(g), np.uint64)
        for i in range(k, min(GRAM, k + 8)):
            w = (w << np.uint64(8)) | text[g + i]
        key = (key ^ w) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(31)
    owner = ids[e_doc]
    o = np.argsort(key, kind="stable")
    heads = np.flatnonzero(np.r_[True, key[o][1:] != key[o][:-1]])
    lo, hi = np.minimum.reduceat(owner[o], heads), np.maximum.reduceat(owner[o], heads)
    size = np.diff(np.r_[heads, len(o)])
    shared = np.repeat(lo != hi, size)
    cand, group = o[shared], np.repeat(np.arange(len(heads)), size)[shared]
    if len(cand) == 0:
        return None
    # equal pieces: all but those of the smallest id are settled whole
    raw = text.tobytes()
    del text
    best: dict[bytes, int] = {}
    label = np.empty(len(cand), np.int64)
    for i, (a, n) in enumerate(_rows(off[cand], length[cand])):
        label[i] = best.setdefault(raw[a:a + n], len(best))
    del raw
    distinct = list(best)
    del best
    low = np.full(len(distinct), LAST_ID)
    np.minimum.at(low, label, owner[cand])
    whole = owner[cand] > low[label]
    marks = [(cand[whole], np.zeros(int(whole.sum()), np.int64), length[cand[whole]])]
    # one piece per string goes on, standing for all pieces equal to it
    stay = np.flatnonzero(~whole)
    _, pick = np.unique(label[stay], return_index=True)
    rep = cand[stay[pick]]
    rep_group = group[stay[pick]]
    # the other pieces equal to it, by label
    other = np.setdiff1d(stay, stay[pick])
    other = other[np.argsort(label[other], kind="stable")]
    twin_label, twin = label[other], cand[other]
    o = np.argsort(rep_group, kind="stable")
    rg, ro = rep_group[o], owner[rep][o]
    heads = np.flatnonzero(np.r_[True, rg[1:] != rg[:-1]])
    lo, hi = np.minimum.reduceat(ro, heads), np.maximum.reduceat(ro, heads)
    keep = np.repeat(lo != hi, np.diff(np.r_[heads, len(o)]))
    sel = o[keep]
    rep, rep_group, rep_label = rep[sel], rep_group[sel], label[stay[pick]][sel]
    if len(rep):
        text = np.frombuffer(b"".join([distinct[i] for i in rep_label.tolist()]), np.uint8)
        del distinct
        at = np.cumsum(length[rep]) - length[rep]
        n = length[rep] - depth + 1
        piece = np.repeat(np.arange(len(rep)), n)
        shift = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        c, sizes = equal_classes(text, at[piece] + shift, rep_group[piece], owner[rep][piece], depth)
        if len(c):
            own = owner[rep[piece[c]]]
            low = np.minimum.reduceat(own, np.cumsum(sizes) - sizes)
            late = c[own > np.repeat(low, sizes)]
            e, i = piece[late], shift[late]
            marks.append((rep[e], i, i + depth))
            lo = np.searchsorted(twin_label, rep_label[e])
            n = np.searchsorted(twin_label, rep_label[e], side="right") - lo
            at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
            i = np.repeat(i, n)
            marks.append((twin[at], i, i + depth))
    m_entry, m_a, m_z = (np.concatenate(x) for x in zip(*marks))
    if len(m_entry) == 0:
        return None
    # every reference of a marked entry
    r_lo = np.searchsorted(ref_entry, m_entry)
    counts = np.searchsorted(ref_entry, m_entry, side="right") - r_lo
    ridx = np.repeat(r_lo - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    doc = np.repeat(e_doc[m_entry], counts)
    a = ref_at[ridx] + np.repeat(m_a, counts)
    z = ref_at[ridx] + np.repeat(m_z, counts)
    doc, a, z = merge_spans(doc.astype(np.int64), a, z)
    return ids[doc], checks[doc], a, z


def _shard_of(ids: np.ndarray, checks: np.ndarray, shards: int) -> np.ndarray:
    """Spark's ``pmod(xxhash64(id, check), shards)``."""
    out = np.empty(len(ids), np.int64)
    for k, (i, c) in enumerate(zip(ids.tolist(), checks.tolist())):
        h = xxhash.xxh64_intdigest(struct.pack("<q", c), xxhash.xxh64_intdigest(struct.pack("<q", i), 42))
        out[k] = (h - (1 << 64) if h >> 63 else h) % shards
    return out


def _by_shard(ids, checks, a, z, shards: int) -> pa.Table:
    """Spans packed per shard of documents."""
    names, doc = np.unique(np.stack([ids, checks.astype(np.int64)]), axis=1, return_inverse=True)
    doc = doc.ravel()
    doc, a, z = merge_spans(doc.astype(np.int64), a, z)
    shard = _shard_of(names[0], names[1], shards)[doc]
    o = np.argsort(shard, kind="stable")
    heads = np.flatnonzero(np.r_[True, shard[o][1:] != shard[o][:-1]]) if len(o) else np.zeros(0, np.int64)
    blobs = [_pack([names[0][doc[p]], names[1][doc[p]], a[p], z[p]], _SPAN_TYPES)
             for p in np.split(o, heads[1:])] if len(o) else []
    return pa.table({"shard": pa.array(shard[o][heads], pa.int64()), "blob": pa.array(blobs, pa.binary())})


def _span_rows(ids, checks, a, z) -> pa.Table:
    """One row per document: its spans as packed pairs."""
    names, doc = np.unique(np.stack([ids, checks.astype(np.int64)]), axis=1, return_inverse=True)
    doc, a, z = merge_spans(doc.ravel().astype(np.int64), a, z)
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, np.int64)
    pair = np.stack([a, z], axis=1)
    blobs = [pair[s:e].tobytes() for s, e in zip(first.tolist(), np.r_[first[1:], len(doc)].tolist())]
    at = doc[first]
    return pa.table({"_id": pa.array(names[0][at]), "_check": pa.array(names[1][at]),
                     "_spans": pa.array(blobs, pa.binary())})


_SPANS = T.StructType([T.StructField("_id", T.LongType()), T.StructField("_check", T.LongType()),
                       T.StructField("_spans", T.BinaryType())])


def repeated_spans(docs: DataFrame, id_col: str, text_col: str, depth: int = DEPTH,
                   bucket_bytes: int = 8 << 20, shard_bytes: int = 16 << 20) -> DataFrame:
    """(_id, _check, _spans): the byte spans to remove from each document that
    has any, as packed int64 pairs. ``_check`` is the crc32 of the text, which tells
    apart rows that share an id."""
    d = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST_ID)).alias("_id"),
                    F.col(text_col).cast("binary").alias("text"))
    total = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets, shards = (max(1, math.ceil(total / x)) for x in (bucket_bytes, shard_bytes))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, int, bytes]] = []
        size = 0
        for b in text_blocks(batches):
            for i, t in zip(b.column("_id").to_pylist(), as_bytes(b.column("text"))):
                if len(t) >= depth:
                    rows.append((i, zlib.crc32(t), t))
                    size += len(t)
            if size >= MAP_BYTES:
                yield from send(rows)
                rows, size = [], 0
        yield from send(rows)

    def send(rows: list) -> Iterator[pa.RecordBatch]:
        for b, blob, spans in _map_block(rows, depth, buckets) if rows else ():
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([blob], pa.binary()),
                                              pa.array([spans], pa.binary())],
                                             names=["bucket", "pieces", "spans"])

    def settle(t: pa.Table) -> pa.Table:
        parts = []
        for s in t.column("spans").to_pylist():
            if s is not None:
                parts.append(_unpack(s, _SPAN_TYPES))
        blobs = [p for p in t.column("pieces").to_pylist() if p is not None]
        del t
        found = _settle_bucket(blobs, depth) if blobs else None
        if found is not None:
            parts.append(found)
        if not parts:
            return _by_shard(*[np.zeros(0, x) for x in _SPAN_TYPES], shards)
        return _by_shard(*[np.concatenate(x) for x in zip(*parts)], shards)

    def gather(t: pa.Table) -> pa.Table:
        parts = [_unpack(s, _SPAN_TYPES) for s in t.column("blob").to_pylist()]
        return _span_rows(*[np.concatenate(x) for x in zip(*parts)])

    marked = (d.mapInArrow(scan, "bucket int, pieces binary, spans binary")
              .groupBy("bucket").applyInArrow(settle, "shard bigint, blob binary"))
    return marked.groupBy("shard").applyInArrow(gather, _SPANS)


def cut_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                depth: int = DEPTH, digests: bool = False) -> DataFrame:
    """``docs`` with repeated byte strings removed from the text.

    A byte goes if a ``depth``-byte string that covers it also starts in a
    document with a smaller id; strings are judged on the input and never
    cross documents. With ``digests`` the result is doc_id, n_bytes,
    n_removed, n_spans and kept_sha256 instead; otherwise all columns stay and
    the text is what is left (a character cut in two goes whole). Null text
    is empty (and stays null); texts below ``depth`` bytes stay; a null id
    counts as larger than any other; rows that share an id do not remove from
    one another; an empty table gives no rows.

    Scale: one shuffle of compressed distinct pieces (about the size of the
    compressed corpus times two), one of spans, and one of the compressed text
    to its spans. A passage that many documents share is one entry per map
    block, however many documents hold it.
    """
    scratch = Scratch(docs.sparkSession, "suffixes")
    spans = scratch.write(repeated_spans(docs, id_col, text_col, depth), "spans")

    cols = [id_col] if digests else docs.columns
    keep = [c for c in cols if c != text_col]
    d = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST_ID)).alias("_id"),
                    F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("_check"),
                    F.struct(*keep).alias("_row"), F.col(text_col).cast("binary").alias("text"))

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=3)
        for b in text_blocks(batches):
            small = [None if t is None else z.compress(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in ("_id", "_check", "_row")] + [pa.array(small, pa.binary())],
                names=["_id", "_check", "_row", "_z"])

    row_type = d.schema["_row"].dataType
    z_schema = T.StructType([d.schema["_id"], d.schema["_check"], T.StructField("_row", row_type),
                             T.StructField("_z", T.BinaryType())])
    joined = (d.mapInArrow(squeeze, z_schema).join(spans, ["_id", "_check"], "left")
              .select("_row", "_z", "_spans"))
    out = T.StructType([T.StructField("_row", row_type), T.StructField("_text", T.StringType())]
                       + ([T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")]
                          + [T.StructField("kept_sha256", T.StringType())] if digests else []))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unz = zstandard.ZstdDecompressor()
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                texts, stats = [], []
                for z, spans in zip(b.column("_z").to_pylist(), b.column("_spans").to_pylist()):
                    t = None if z is None else unz.decompress(z)
                    kept, n, runs = _cut(t or b"", spans)
                    stats.append((len(t or b""), n, runs, hashlib.sha256(kept).hexdigest()))
                    texts.append(None if t is None or digests else kept.decode("utf-8", "ignore"))
                arrays = [b.column("_row"), pa.array(texts, pa.string())]
                if digests:
                    arrays += [pa.array(x, y) for x, y in zip(zip(*stats), [pa.int64()] * 3 + [pa.string()])]
                yield pa.RecordBatch.from_arrays(arrays, names=out.names)

    done = joined.mapInArrow(apply, out)
    if digests:
        return done.select(F.col(f"_row.`{id_col}`").alias("doc_id"), "n_bytes", "n_removed", "n_spans",
                           "kept_sha256")
    return done.select(*[F.col("_text").alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c)
                         for c in cols])


def _cut(text: bytes, spans: bytes | None) -> tuple[bytes, int, int]:
    """(kept bytes, bytes removed, maximal removed runs)."""
    if not spans:
        return text, 0, 0
    pairs = np.frombuffer(spans, np.int64).reshape(-1, 2)
    _, a, z = merge_spans(np.zeros(len(pairs), np.int64), pairs[:, 0], pairs[:, 1])
    kept, at = [], 0
    for s, e in zip(a.tolist(), z.tolist()):
        kept.append(text[at:s])
        at = e
    kept.append(text[at:])
    return b"".join(kept), int((z - a).sum()), len(a)
