"""Sets of integer keys as bitmaps, for comparing columns by their distinct keys.

A key is a bucket (all but its low 15 bits) and a position in it. A task folds
the keys that it sees to one container per column and bucket: a bitmap of
4 KB where a bucket is well filled, else two bytes a key. So a shuffle moves
containers instead of a row per key; a code that every row holds is two bytes
per task, and keys that share no bucket cost no more than before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 15
DENSE = 2048  # positions from which a bitmap is smaller than a list of them
HELD_KEYS = 1 << 21  # distinct keys (8 bytes) a task holds before it lets go of its containers
MERGED_KEYS = 1 << 21  # keys unfolded at a time when containers meet

_CONTAINERS = "side int, col int, bucket bigint, dense boolean, keys binary"


def _folded(side: int, col: int, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sorted distinct keys as containers."""
    if not len(keys):
        return
    bucket = keys >> BITS
    pos = (keys & ((1 << BITS) - 1)).astype("<u2")
    head = np.r_[0, np.flatnonzero(np.diff(bucket)) + 1]
    n = np.diff(np.r_[head, len(keys)])
    data, dense = [], n >= DENSE
    for k in np.flatnonzero(dense).tolist():
        bits = np.zeros(1 << BITS, np.uint8)
        bits[pos[head[k]:head[k] + n[k]]] = 1
        data.append(np.packbits(bits, bitorder="little").tobytes())
    few = ~np.repeat(dense, n)
    offsets = np.r_[0, np.cumsum(2 * n[~dense])].astype(np.int32)
    lists = pa.Array.from_buffers(pa.binary(), int((~dense).sum()),
                                  [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(pos[few].tobytes())])
    for which, values in ((~dense, lists), (dense, pa.array(data, pa.binary()))):
        m = int(which.sum())
        if m:
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(side, pa.int32()), m), pa.repeat(pa.scalar(col, pa.int32()), m),
                 pa.array(bucket[head[which]], pa.int64()), pa.repeat(pa.scalar(values is not lists), m), values],
                names=["side", "col", "bucket", "dense", "keys"])


def containers(df: DataFrame, columns: list[tuple[int, int, str]]) -> DataFrame:
    """Containers of the non-NULL values of integer columns, given as (side,
    col, name); a pass over the rows, no shuffle."""
    marks = [(side, col) for side, col, _ in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64) for _ in marks]
        fresh: list[list[np.ndarray]] = [[] for _ in marks]
        waiting = 0

        def fold():
            for k, parts in enumerate(fresh):
                if parts:
                    held[k] = np.unique(np.concatenate([held[k], *parts]))
                    parts.clear()

        for b in batches:
            for k in range(len(marks)):
                v = b.column(k).drop_null().to_numpy()
                # a short pass first: most columns repeat few codes
                fresh[k].append(np.unique(v))
                waiting += len(fresh[k][-1])
            if waiting > HELD_KEYS // 2:
                fold()
                waiting = 0
                if sum(map(len, held)) > HELD_KEYS:
                    for (side, col), keys in zip(marks, held):
                        yield from _folded(side, col, keys)
                    held = [np.zeros(0, np.int64) for _ in marks]
        fold()
        for (side, col), keys in zip(marks, held):
            yield from _folded(side, col, keys)

    return df.select(*[F.col(f"`{n}`").cast("bigint").alias(f"k{i}") for i, (_, _, n) in enumerate(columns)]).mapInArrow(run, _CONTAINERS)


def _unfolded(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Side, column and key of every key in some containers."""
    side, col = b.column("side").to_numpy(), b.column("col").to_numpy()
    bucket = b.column("bucket").to_numpy()
    sizes, parts = [], []
    for dense, keys in zip(b.column("dense").to_pylist(), b.column("keys")):
        raw = np.frombuffer(keys.as_buffer(), np.uint8)
        p = np.flatnonzero(np.unpackbits(raw, bitorder="little")) if dense else raw.view("<u2").astype(np.int64)
        sizes.append(len(p))
        parts.append(p)
    pos = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return np.repeat(side, sizes), np.repeat(col, sizes), (np.repeat(bucket, sizes) << BITS) | pos


def orphan_keys(folded: DataFrame, col_of: dict[int, int]) -> DataFrame:
    """Match containers of side 0 with those of every other side.

    ``col_of`` gives the column that a side is matched with. Rows are (side,
    key, n): with a key, a key of side 0 that the side lacks; without, the
    number ``n`` of distinct keys of the side in some buckets. Containers of a
    bucket meet in one task, which unfolds a bounded number of keys at a time.
    """
    sides = dict(col_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def match(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            """Distinct (side, col, key) of whole buckets."""
            for s, c in sides.items():
                of = rows["key"][(rows["col"] == c) & (rows["side"] == 0)]
                has = rows["key"][rows["side"] == s]
                lost = np.setdiff1d(of, has, assume_unique=True)
                n = len(lost) + (len(has) > 0)
                if n:
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(pa.scalar(s, pa.int32()), n),
                         pa.array(np.r_[lost, np.zeros(n - len(lost), np.int64)], mask=np.arange(n) >= len(lost)),
                         pa.array(np.r_[np.zeros(len(lost), np.int64), np.full(n - len(lost), len(has))])],
                        names=["side", "key", "n"])

        kind = np.dtype([("col", "<i4"), ("key", "<i8"), ("side", "<i4")])
        held = np.zeros(0, kind)
        for b in batches:
            for at in range(0, b.num_rows, MERGED_KEYS >> BITS):
                side, col, key = _unfolded(b.slice(at, MERGED_KEYS >> BITS))
                new = np.zeros(len(key), kind)
                new["col"], new["key"], new["side"] = col, key, side
                held = np.unique(np.concatenate([held, new]))
                if not len(held):
                    continue
                # all but the last bucket seen are complete
                last_col, last = int(col[-1]), int(key[-1]) >> BITS
                done = (held["col"] != last_col) | (held["key"] >> BITS != last)
                if done.any():
                    yield from match(held[done])
                    held = held[~done]
        if len(held):
            yield from match(held)

    return (folded.repartition("col", "bucket").sortWithinPartitions("col", "bucket")
            .mapInArrow(run, "side int, key bigint, n bigint"))
