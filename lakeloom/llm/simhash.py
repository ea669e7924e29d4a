"""SimHash near-duplicate groups by anchor-point covering.

Fingerprints: 64 majority bits over XXH64 (seed 42) of 4-word shingles.
Links: Hamming distance at most ``max_bits``. The 64 bits are cut into
``BLOCKS`` blocks; two linked fingerprints differ in at most
``max_bits // BLOCKS`` bits of some block. Per block the anchors are the
words of a covering code of radius 1, a [15,11] Hamming code times free bits:
every block value lies within 1 of its home anchor, so a linked pair meets at
the home anchor of one when the other is copied to every anchor within
radius + threshold of it. Pairs are compared per anchor on all 64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm.common import Scratch, as_bytes, text_blocks
from lakeloom.llm.components import connected_components

SHINGLE = 4
SEED = 42
MAX_BITS = 4
SLICE = 1 << 17  # shingles hashed at a time
PAIRS = 1 << 20  # pairs compared at a time
POINTS = 1 << 22  # midpoints sorted at a time
BUSY = 1 << 20  # pairs of one anchor above which another way is looked for
SORTED = 8  # what sorting a midpoint costs, in compared pairs

# the 64 bits as three blocks, each a 15-bit Hamming part and free bits
BLOCKS = ((0, 21), (21, 21), (42, 22))
_COLUMNS = np.arange(1, 16, dtype=np.uint32)  # parity check: column i is i + 1


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit fingerprint of one text; zero if it has no word."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    del words
    ends = np.cumsum(lens + 1) - 1
    starts, ends = (ends - lens)[:len(lens) - shingle + 1], ends[shingle - 1:]
    n, digest = len(starts), xxhash.xxh64_intdigest
    count = np.zeros(64, np.int64)
    for i in range(0, n, SLICE):
        s, e = starts[i:i + SLICE].tolist(), ends[i:i + SLICE].tolist()
        h = np.fromiter((digest(joined[a:b], seed) for a, b in zip(s, e)), np.uint64, len(s))
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(0, dtype=np.uint32)
    ones = (count * 2 > n).astype(np.uint64)
    return int((ones << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) with the fingerprint's bits in a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_blocks(batches):
            fp = np.array([fingerprint(t, shingle) for t in as_bytes(b.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp.view(np.int64))],
                                             names=["doc_id", "fp"])

    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return d.mapInArrow(run, "doc_id bigint, fp bigint")


def _error_table(width: int, radius: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Per Hamming syndrome every error mask of ``width`` bits and weight at
    most ``radius`` that leads to a code word; and the syndrome's own single
    correction, which leads to the home anchor."""
    masks: list[list[int]] = [[] for _ in range(16)]
    for w in range(radius + 1):
        for bits in combinations(range(width), w):
            syndrome = 0
            for i in bits:
                if i < 15:
                    syndrome ^= int(_COLUMNS[i])
            masks[syndrome].append(sum(1 << i for i in bits))
    home = np.array([0] + [1 << (s - 1) for s in range(1, 16)], np.int64)
    return [np.array(m, np.int64) for m in masks], home


def _syndromes(v: np.ndarray) -> np.ndarray:
    s = np.zeros(len(v), np.int64)
    for i in range(15):
        s ^= ((v >> i) & 1) * int(_COLUMNS[i])
    return s


def anchors_of(fp: np.ndarray, max_bits: int = MAX_BITS):
    """(row, key, home) for every copy of ``fp``: key names block and anchor."""
    rows, keys, homes = [], [], []
    radius = 1 + max_bits // len(BLOCKS)
    for k, (shift, width) in enumerate(BLOCKS):
        masks, fix = _error_table(width, radius)
        v = ((fp >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64)
        syn = _syndromes(v)
        for s in range(16):
            at = np.flatnonzero(syn == s)
            if len(at) == 0:
                continue
            word = v[at][:, None] ^ masks[s][None, :]
            rows.append(np.repeat(at, len(masks[s])))
            keys.append((word + (k << 32)).ravel())
            homes.append(np.tile(masks[s] == fix[s], len(at)))
    if not rows:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, bool)
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(homes)


class Forest:
    """Union of links among n items that keeps a spanning forest only."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)
        self.links: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.root[a], self.root[b]
            m = ra != rb
            if not m.any():
                return
            a, b, ra, rb = a[m], b[m], ra[m], rb[m]
            hi, first = np.unique(np.maximum(ra, rb), return_index=True)
            lo = np.minimum(ra, rb)[first]
            self.links.append((hi, lo))
            self.root[hi] = lo
            while True:
                r = self.root[self.root]
                if (r == self.root).all():
                    break
                self.root = r


def _ball(width: int, radius: int) -> list[int]:
    """All masks of ``width`` bits and weight at most ``radius``."""
    return [sum(1 << i for i in bits) for w in range(radius + 1) for bits in combinations(range(width), w)]


def link_by_midpoints(fp: np.ndarray, forest: Forest, item: np.ndarray, max_bits: int,
                      points: int = POINTS) -> None:
    """Link all fingerprints within ``max_bits`` (even) of each other in time
    linear in their number: two differ in at most ``2 * r`` bits exactly if some
    value lies within ``r`` bits of both. Every fingerprint is a member of the
    values in its ball, and members of one value are linked in a chain. Values
    go by their leading bits, about ``points`` of them at a time."""
    spread = int(np.bitwise_or.reduce(fp ^ fp[0])) if len(fp) else 0
    at = [i for i in range(64) if spread >> i & 1]
    v = np.zeros(len(fp), np.uint64)  # the bits that differ at all, close together
    for j, i in enumerate(at):
        v |= ((fp >> np.uint64(i)) & np.uint64(1)) << np.uint64(j)
    masks = _ball(len(at), max_bits // 2)
    lead = min(len(at), max(0, math.ceil(math.log2(max(1, len(fp) * len(masks) / points)))))
    low = len(at) - lead
    by_lead: dict[int, list[int]] = {}
    for m in masks:
        by_lead.setdefault(m >> low, []).append(m)
    head = (v >> np.uint64(low)).astype(np.int64) if lead else np.zeros(len(v), np.int64)
    order = np.argsort(head, kind="stable")
    bounds = np.searchsorted(head[order], np.arange((1 << lead) + 1))
    for part in range(1 << lead):
        values, members = [], []
        for flip, some in by_lead.items():
            mine = order[bounds[part ^ flip]:bounds[(part ^ flip) + 1]]
            if len(mine):
                values.append((v[mine][:, None] ^ np.array(some, np.uint64)[None, :]).ravel())
                members.append(np.repeat(mine, len(some)))
        if not values:
            continue
        value, member = np.concatenate(values), np.concatenate(members)
        o = np.argsort(value, kind="stable")
        value, member = value[o], member[o]
        same = value[1:] == value[:-1]
        a, b = item[member[1:][same]], item[member[:-1][same]]
        forest.add(a, b)


def link_within(keys, fp, home, forest: Forest, item, max_bits: int, big: int = 1 << 22) -> None:
    """Link home with copied fingerprints under each key. Members of a key are
    compared pair by pair; where that would cost more than the midpoints of its
    members, these link them. A key with many pairs between the two is first cut
    by bands of the bits its members differ in, one more than ``max_bits``: a
    linked pair shares one whole band."""
    o = np.lexsort((home, keys))
    keys, fp, home, item = keys[o], fp[o], home[o], item[o]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    if len(keys) == 0:
        return
    size = np.diff(np.r_[first, len(keys)])
    homes = np.add.reduceat(home.astype(np.int64), first)
    done = np.zeros(len(first), bool)
    for r in np.flatnonzero(homes * size > BUSY):
        mine = slice(first[r], first[r] + size[r])
        spread = int(np.bitwise_or.reduce(fp[mine] ^ fp[first[r]]))
        width = spread.bit_count()
        if max_bits % 2 == 0 and homes[r] > SORTED * sum(math.comb(width, k) for k in range(max_bits // 2 + 1)):
            link_by_midpoints(fp[mine], forest, item[mine], max_bits)
            done[r] = True
        elif big and homes[r] * size[r] > big and width > 2 * max_bits:
            at = [i for i in range(64) if spread >> i & 1]
            for k in range(max_bits + 1):
                band = np.uint64(sum(1 << i for i in at[k::max_bits + 1]))
                link_within((fp[mine] & band).view(np.int64), fp[mine], home[mine], forest, item[mine],
                            max_bits, big=0)
            done[r] = True
    # every home element meets all members of its run, in bounded pieces
    hs = np.flatnonzero(home & ~np.repeat(done, size))
    if len(hs) == 0:
        return
    run = np.repeat(np.arange(len(first)), size)[hs]
    start, n = first[run], size[run]
    total = np.cumsum(n)
    a = 0
    while a < len(hs):
        base = total[a - 1] if a else 0
        z = max(a + 1, int(np.searchsorted(total, base + PAIRS, side="right")))
        left = np.repeat(hs[a:z], n[a:z])
        step = np.arange(len(left)) - np.repeat(total[a:z] - n[a:z] - base, n[a:z])
        right = np.repeat(start[a:z], n[a:z]) + step
        near = np.bitwise_count(fp[left] ^ fp[right]) <= max_bits
        left, right = left[near], right[near]
        m = fp[left] != fp[right]
        forest.add(item[left[m]], item[right[m]])
        a = z


def _grouped(docs: DataFrame, scratch: Scratch, id_col: str, text_col: str, shingle: int, max_bits: int,
             group_rows: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of every row, and (fp, comp, component_id) of every
    distinct fingerprint: its group, named by the group's smallest fingerprint,
    and the smallest id of the group, NULL if no row of it has one."""
    fps = scratch.write(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = scratch.write(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "nodes")
    groups = max(1, math.ceil(nodes.count() * 44 / group_rows))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.asarray(b.column("fp"), dtype=np.int64)
            for i in range(0, len(fp), 20_000):
                f = fp[i:i + 20_000]
                row, key, home = anchors_of(f.view(np.uint64), max_bits)
                mixed = (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
                grp = (mixed % np.uint64(groups)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (grp, key, f[row], home)],
                                                 names=["grp", "key", "fp", "home"])

    def compare(t: pa.Table) -> pa.Table:
        key, fp = (np.asarray(t.column(c).combine_chunks(), dtype=np.int64) for c in ("key", "fp"))
        home = np.asarray(t.column("home").combine_chunks()).astype(bool)
        names, item = np.unique(fp, return_inverse=True)
        forest = Forest(len(names))
        link_within(key, fp.view(np.uint64), home, forest, item, max_bits)
        hi = np.concatenate([x for x, _ in forest.links] or [np.zeros(0, np.int64)])
        lo = np.concatenate([x for _, x in forest.links] or [np.zeros(0, np.int64)])
        return pa.table({"a": names[hi], "b": names[lo]})

    edges = (nodes.select("fp").mapInArrow(spread, "grp int, key bigint, fp bigint, home boolean").groupBy("grp")
             .applyInArrow(compare, T.StructType([T.StructField("a", T.LongType()),
                                                  T.StructField("b", T.LongType())])))
    comp = connected_components(edges, scratch).withColumnRenamed("node", "fp")
    # only linked fingerprints have a group beside themselves
    linked = comp.join(nodes, "fp")
    lows = linked.groupBy("component").agg(F.min("low").alias("lowest"))
    named = nodes.join(comp.join(lows, "component"), "fp", "left").select(
        "fp", F.coalesce("component", "fp").alias("comp"),
        F.when(F.col("component").isNotNull(), F.col("lowest")).otherwise(F.col("low")).alias("component_id"))
    return fps, scratch.write(named, "named")


def near_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                shingle: int = SHINGLE, max_bits: int = MAX_BITS, group_rows: int = 100_000) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    Null text and text without words have fingerprint zero and link like any
    other. Rows with a null id link and bridge like any other and have the
    component of their group, NULL if no row of it has an id. Repeated rows and
    copies share a fingerprint and are one member in the search; other columns
    are ignored; an empty table gives no rows.

    Scale: text is read once and only fingerprints move. Copies collapse
    before the search, each distinct fingerprint is copied to about 44
    anchors, and an anchor task returns a spanning forest of its links, never
    all pairs. Components and the join back are plain shuffles on small rows.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    fps, named = _grouped(docs, scratch, id_col, text_col, shingle, max_bits, group_rows)
    return fps.join(named.select("fp", "component_id"), "fp", "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _free(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             max_bits: int = MAX_BITS, group_rows: int = 100_000) -> DataFrame:
    """One row of every group of near duplicates, all columns as they are.

    It is the row with the smallest id, rows without an id last; among rows of
    that id the one with the smallest fingerprint (as a signed number), and
    among those the one whose values hash lowest. Every row is judged by its
    own text: an id with several texts keeps those that are in groups of their
    own. An empty table gives no rows.

    Scale: ids that occur once, as they should, go by an anti-join on the id.
    Only rows that share their id with others, or have none, are fingerprinted
    again to tell them apart.
    """
    scratch = Scratch(docs.sparkSession, "keep-one")
    fps, named = _grouped(docs, scratch, id_col, text_col, shingle, max_bits, group_rows)
    rows = fps.join(named.select("fp", "comp"), "fp")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp")).alias("w")
    winners = scratch.write(rows.groupBy("comp").agg(first).select("comp", "w.doc_id", "w.fp"), "winners")
    per_id = rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.min("comp").alias("comp"))
    won = winners.select("comp", F.col("doc_id").alias("winner"))
    out = scratch.write(per_id.join(won, "comp").where("n > 1 OR winner IS NULL OR winner <> doc_id")
                        .select("doc_id", (F.col("n") > 1).alias("many")), "out")
    mark = _free(docs, "_id")
    ids = out.select(F.col("doc_id").alias(mark))
    kept = docs.where(F.col(f"`{id_col}`").isNotNull()).join(ids, F.col(f"`{id_col}`") == F.col(mark), "left_anti")
    many = out.where("many").select(F.col("doc_id").alias(mark))
    nameless = fps.where("doc_id IS NULL")
    if many.isEmpty() and nameless.isEmpty():
        return kept
    special = (docs.join(many, F.col(f"`{id_col}`") == F.col(mark), "left_semi")
               .unionByName(docs.where(F.col(f"`{id_col}`").isNull())))
    return kept.unionByName(_winning_rows(special, winners, id_col, text_col, shingle))


def _winning_rows(docs: DataFrame, winners: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """Of rows that an id does not tell apart, those that win their group."""
    fp, order, w_id, w_fp, row = (_free(docs, n) for n in ("_fp", "_order", "_w_id", "_w_fp", "_row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_blocks(batches, text_col):
            prints = np.array([fingerprint(t, shingle) for t in as_bytes(b.column(text_col))], np.uint64)
            yield b.append_column(fp, pa.array(prints.view(np.int64)))

    marked = docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(fp, T.LongType())]))
    wins = winners.select(F.col("doc_id").alias(w_id), F.col("fp").alias(w_fp))
    same = F.col(f"`{id_col}`").cast("bigint").eqNullSafe(F.col(w_id)) & (F.col(fp) == F.col(w_fp))
    plain = [c.name for c in docs.schema.fields if "map<" not in c.dataType.simpleString()]
    # copies of the winning row fold to one within each task
    one = (marked.join(wins, same, "left_semi")
           .select(F.col(f"`{id_col}`").cast("bigint").alias(w_id), F.col(fp).alias(w_fp),
                   F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row),
                   F.xxhash64(*[F.col(f"`{c}`") for c in plain]).alias(order))
           .groupBy(w_id, w_fp).agg(F.min_by(row, order).alias(row)))
    return one.select(f"{row}.*")
