"""Alignment of two tokenizers over whole texts by merge-path partitioning.

Both tokenizers cut the same bytes, so a text's token ends are two sorted
lists, and aligning is merging them. The merge of n_a + n_b ends is a path
through the n_a x n_b grid; a binary search on each of its equally spaced
diagonals finds where the path crosses, which divides the merge into
independent pieces of equal work, however the tokens of both sides are spread.
All pieces of a block are walked side by side. A piece emits the overlaps of
its tokens and the places where both sides end together; the group that a
piece leaves open is stitched to the first end of a later piece.

Counts of linked id pairs are summed over all documents by Spark and joined
back: by broadcast while the table of pairs is proven small, else by a salted
shuffle.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeloom.llm.common import Scratch, as_bytes, text_blocks
from lakeloom.operators.sizing import is_small

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
VOCABULARY_BYTES = 32 << 20  # vocabulary files over this are refused: they travel to every task
PIECE = 512  # merge steps of one piece
PIECES = 1024  # pieces walked side by side
BLOCK = 1 << 20  # text tokenized and merged at a time
BROADCAST_PAIRS = 1 << 19  # id pairs (24 bytes each) joined by broadcast, at most
SALT = 32

# --- fixed values: the splitting pattern of byte-level BPE vocabularies ---
PRE_TOKENS = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def _file(spark: SparkSession, path: str) -> bytes:
    """A vocabulary file, from the driver's disk or any path Spark reads."""
    if os.path.exists(path):
        with open(path, "rb") as f:
            data = f.read(VOCABULARY_BYTES + 1)
    else:
        rows = spark.read.format("binaryFile").load(path).where(F.col("length") <= VOCABULARY_BYTES)
        data = bytes(rows.select("content").first()[0])
    if len(data) > VOCABULARY_BYTES:
        raise ValueError(f"vocabulary {path} is larger than {VOCABULARY_BYTES} bytes")
    return data


def _byte_alphabet() -> dict[str, int]:
    """Character of a byte-level vocabulary -> byte: printable Latin-1 stands
    for itself, the other bytes follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteTokenizer:
    """Byte-level BPE from a tokenizer file: its vocabulary as merge ranks.

    Ids of such a file follow the order of its merges; a file where they do
    not is refused, as ranks alone would not describe it. Text that spells a
    special token is ordinary text."""

    def __init__(self, data: bytes) -> None:
        import tiktoken

        model = json.loads(data)["model"]
        vocab, alphabet = model["vocab"], _byte_alphabet()
        merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if merged != sorted(merged) or (merged and len(vocab) - len(merged) != merged[0]):
            raise ValueError("ids of the vocabulary do not follow its merges")
        ranks = {bytes(alphabet[c] for c in token): i for token, i in vocab.items()}
        self.encoding = tiktoken.Encoding("byte-level", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.sizes[i] = len(token)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of ``" " + text``."""
        return [np.array(self.encoding.encode_ordinary(" " + t), np.int64) for t in texts]

    def joins_to(self, ids: np.ndarray, raw: bytes) -> bool:
        return self.encoding.decode_bytes(ids.tolist()) == raw


class PieceTokenizer:
    """Pieces of a sentence-piece model, which puts a space before the text."""

    def __init__(self, data: bytes) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=data)
        n = self.model.get_piece_size()
        self.bytes = [bytes([int(p[1:-1], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode("utf-8")
                      for i, p in ((i, self.model.id_to_piece(i)) for i in range(n))]
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self.model.encode(texts, num_threads=1)]

    def joins_to(self, ids: np.ndarray, raw: bytes) -> bool:
        return b"".join(map(self.bytes.__getitem__, ids.tolist())) == raw


def merge_path(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many ends of ``a`` come before each diagonal of the merge of two
    sorted lists; equal ends take ``a`` first."""
    lo, hi = np.maximum(diagonals - len(b), 0), np.minimum(diagonals, len(a))
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) // 2
        first = np.zeros(len(mid), bool)
        first[open_] = a[mid[open_]] <= b[diagonals[open_] - 1 - mid[open_]]
        lo, hi = np.where(open_ & first, mid + 1, lo), np.where(open_ & ~first, mid, hi)


@dataclass
class Merge:
    """Overlapping token index pairs in order, and the index pairs of tokens
    that end together, which close the groups."""
    over_a: np.ndarray
    over_b: np.ndarray
    end_a: np.ndarray
    end_b: np.ndarray


def merge_ends(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> Merge:
    """Merge two sorted lists of token ends in independent pieces of ``piece``
    steps. Both lists must be strictly increasing and end at the same place."""
    total = len(a) + len(b)
    if not total:
        none = np.zeros(0, np.int64)
        return Merge(none, none, none, none)
    starts = np.arange(0, total, piece, dtype=np.int64)
    crossings = merge_path(a, b, starts)
    far = max(int(a[-1]), int(b[-1])) + 1
    a_, b_ = np.r_[a, far], np.r_[b, far]
    before = np.r_[-1, a]  # end of the token of a before token i
    parts = [_walk(a_, b_, before, crossings[k:k + PIECES], starts[k:k + PIECES], piece, total)
             for k in range(0, len(starts), PIECES)]
    return Merge(*(np.concatenate(x) for x in zip(*parts)))


def _walk(a: np.ndarray, b: np.ndarray, before: np.ndarray, i: np.ndarray, starts: np.ndarray,
          piece: int, total: int) -> tuple[np.ndarray, ...]:
    """Walk some pieces side by side, each from where the path crosses its
    diagonal, and put what they emit in the order of the text."""
    j = starts - i
    at_a = np.empty((piece, len(starts)), np.int64)
    at_b = np.empty_like(at_a)
    kind = np.zeros((piece, len(starts)), np.int8)  # 1: overlap, 2: the overlap where both end
    left = total - starts
    for step in range(min(piece, int(left[0]))):
        end_a, end_b = a[i], b[j]
        take_a = end_a <= end_b
        at_a[step], at_b[step] = i, j
        live = left > step
        # past a common end the step that takes b covers no byte
        kind[step] = np.where(take_a, 1 + (end_a == end_b), before[i] != end_b) * live
        i = i + (take_a & live)
        j = j + (~take_a & live)
    kind, at_a, at_b = kind.T.ravel(), at_a.T.ravel(), at_b.T.ravel()  # piece after piece
    over, both = kind > 0, kind == 2
    return at_a[over], at_b[over], at_a[both], at_b[both]


def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0..n-1, left aligned with room for one separator."""
    text = np.array([str(i) for i in range(max(n, 1))], dtype="S")
    width = text.dtype.itemsize
    table = np.zeros((len(text), width + 1), np.uint8)
    table[:, :width] = text.view(np.uint8).reshape(len(text), width)
    return table, (table != 0).sum(1)


class Aligner:
    """Both tokenizers and the alignment of blocks of texts."""

    def __init__(self, a: bytes, b: bytes) -> None:
        self.a, self.b = ByteTokenizer(a), PieceTokenizer(b)
        self.table, self.width = _digits(max(len(self.a.sizes), len(self.b.sizes)))

    def tokens(self, rows: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both sides; none where a side does not give back the bytes,
        or where the bytes are no text."""
        none = np.zeros(0, np.int64)
        out = [(none, none)] * len(rows)
        at, texts = [], []
        for k, raw in enumerate(rows):
            try:
                text = raw.decode("utf-8")
            except UnicodeDecodeError:
                continue
            if text:
                at.append(k)
                texts.append(text)
        for k, x, y in zip(at, self.a.encode(texts), self.b.encode(texts)):
            raw = b" " + rows[k]
            if self.b.joins_to(y, raw) and self.a.joins_to(x, raw):
                out[k] = (x, y)
        return out

    def align(self, rows: list[bytes]):
        """Ids of both sides end to end, tokens per row of both, and the merge
        of all rows of the block: every row ends on both sides together, so
        rows never share a group."""
        ids = self.tokens(rows)
        a = np.concatenate([x for x, _ in ids] or [np.zeros(0, np.int64)])
        b = np.concatenate([y for _, y in ids] or [np.zeros(0, np.int64)])
        n_a = np.array([len(x) for x, _ in ids], np.int64)
        n_b = np.array([len(y) for _, y in ids], np.int64)
        return a, b, n_a, n_b, merge_ends(np.cumsum(self.a.sizes[a]), np.cumsum(self.b.sizes[b]))

    def spelled(self, a: np.ndarray, b: np.ndarray, m: Merge) -> tuple[np.ndarray, np.ndarray]:
        """All groups as ``a1,a2|b1;...;`` bytes, and where each group ends in them."""
        size_a, size_b = np.diff(m.end_a, prepend=-1), np.diff(m.end_b, prepend=-1)
        token = np.empty(len(a) + len(b), np.int64)
        sep = np.full(len(token), ord(","), np.uint8)
        # tokens of a group: its a side, then its b side
        token[np.arange(len(a)) + np.repeat(m.end_b + 1 - size_b, size_a)] = a
        token[np.arange(len(b)) + np.repeat(m.end_a + 1, size_b)] = b
        sep[m.end_a + m.end_b + 1 - size_b] = ord("|")
        last = m.end_a + m.end_b + 1
        sep[last] = ord(";")
        out = self.table[token]
        width = self.width[token]
        out[np.arange(len(token)), width] = sep
        flat = out[np.arange(out.shape[1]) <= width[:, None]]
        return flat, np.cumsum(width + 1)[last]


_ALIGNERS: dict[bytes, Aligner] = {}


def _aligner(a: bytes, b: bytes) -> Aligner:
    """The aligner of this Python worker, kept from task to task."""
    key = hashlib.sha256(a).digest() + hashlib.sha256(b).digest()
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = Aligner(a, b)
    return _ALIGNERS[key]


_FACTS = "n_a bigint, n_b bigint, n_overlaps bigint, n_groups bigint, n_links bigint, groups_sha256 string"


def aligned(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
            byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE) -> DataFrame:
    """One row per document: its id, token, overlap, group and link counts,
    the digest of its groups, and its distinct linked id pairs
    (``a << 32 | b``) with how often each occurs in it.

    Texts that are null or empty, or that a tokenizer does not give back byte
    for byte, have no tokens. Rows repeat as often as the input; other columns
    are ignored; an empty table gives no rows. No shuffle.
    """
    spark = docs.sparkSession
    a_file, b_file = _file(spark, byte_bpe), _file(spark, piece_bpe)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = _aligner(a_file, b_file)
        for batch in text_blocks(batches, max_bytes=BLOCK):
            a, b, n_a, n_b, m = al.align(as_bytes(batch.column("text")))
            n = len(n_a)
            last_a = np.cumsum(n_a)
            row = np.searchsorted(last_a, m.end_a, side="right")  # of every group
            groups = np.bincount(row, minlength=n)
            overlaps = np.bincount(np.searchsorted(last_a, m.over_a, side="right"), minlength=n)
            flat, ends = al.spelled(a, b, m)
            digest, upto, start = [], np.cumsum(groups), 0
            for k in range(n):
                if groups[k]:
                    end = int(ends[upto[k] - 1])
                    digest.append(hashlib.sha256(flat[start:end - 1].tobytes()).hexdigest())
                    start = end
                else:
                    digest.append("")
            pair = (a[m.end_a] << 32) | b[m.end_b]
            order = np.lexsort((pair, row))
            row_, pair_ = row[order], pair[order]
            head = np.flatnonzero(np.r_[True, (row_[1:] != row_[:-1]) | (pair_[1:] != pair_[:-1])]) \
                if len(pair_) else np.zeros(0, np.int64)
            times = np.diff(np.r_[head, len(pair_)])
            offsets = pa.array(np.r_[0, np.cumsum(np.bincount(row_[head], minlength=n))], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_a), pa.array(n_b), pa.array(overlaps.astype(np.int64)),
                 pa.array(groups.astype(np.int64)), pa.array(groups.astype(np.int64)), pa.array(digest, pa.string()),
                 pa.ListArray.from_arrays(offsets, pa.array(pair_[head])),
                 pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64()))],
                names=["doc_id", "n_a", "n_b", "n_overlaps", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, {_FACTS}, "
                             "pairs array<bigint>, times array<bigint>")


def groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
           byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE) -> DataFrame:
    """One row per group of every document: (doc_id, group, start, end, a_ids,
    b_ids); start and end are bytes of space + text. Documents without tokens
    have no rows; null ids are kept."""
    spark = docs.sparkSession
    a_file, b_file = _file(spark, byte_bpe), _file(spark, piece_bpe)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = _aligner(a_file, b_file)
        for batch in text_blocks(batches, max_bytes=BLOCK):
            a, b, n_a, n_b, m = al.align(as_bytes(batch.column("text")))
            row = np.searchsorted(np.cumsum(n_a), m.end_a, side="right")
            per_row = np.bincount(row, minlength=len(n_a))
            end = np.cumsum(al.a.sizes[a])[m.end_a]
            first = np.repeat(np.cumsum(per_row) - per_row, per_row)  # first group of the same row
            before = np.r_[0, end[:-1]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row)), pa.array(np.arange(len(row)) - first),
                 pa.array(before - before[first]), pa.array(end - before[first]),
                 pa.ListArray.from_arrays(pa.array(np.r_[0, m.end_a + 1], pa.int32()), pa.array(a)),
                 pa.ListArray.from_arrays(pa.array(np.r_[0, m.end_b + 1], pa.int32()), pa.array(b))],
                names=["doc_id", "group", "start", "end", "a_ids", "b_ids"])

    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, group bigint, start bigint, "
                             "end bigint, a_ids array<bigint>, b_ids array<bigint>")


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, n, best) of (pair, times): how often ids are linked over all
    documents, and whether no other a id is linked more often to that b id. A
    b id has no more rows than the other vocabulary has ids."""
    n = links.groupBy("pair").agg(F.sum("times").alias("n"))
    b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    return n.select("pair", "n", (F.col("n") == F.max("n").over(Window.partitionBy(b))).alias("best"))


def align_tokenizers(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                     byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE,
                     broadcast_pairs: int = BROADCAST_PAIRS, salt: int = SALT) -> DataFrame:
    """:func:`aligned` with the corpus-wide counts of its links: ``n_best``
    (links whose count is the highest of their b id, ties included) and
    ``count_sum`` (counts summed over links).

    Every document is tokenized once and written with its distinct pairs. The
    pair table is broadcast only while it has at most ``broadcast_pairs``
    rows; a larger one is copied ``salt`` times and joined by shuffle, so that
    a pair which every document holds is spread over as many tasks.
    """
    scratch = Scratch(docs.sparkSession, "alignment")
    rows = scratch.write(
        aligned(docs, id_col=id_col, text_col=text_col, byte_bpe=byte_bpe, piece_bpe=piece_bpe)
        .withColumn("row", F.monotonically_increasing_id()), "aligned")
    links = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    counts = scratch.write(pair_counts(links), "counts")
    if is_small(counts, broadcast_pairs):
        met = links.join(F.broadcast(counts), "pair")
    else:
        spread = counts.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        met = links.withColumn("s", (F.xxhash64("row") % salt + salt) % salt).join(spread, ["pair", "s"])
    sums = met.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    zero = F.lit(0).cast("bigint")
    return rows.drop("pairs", "times").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256", "n_overlaps")
