"""Document quality from a linear-chain CRF over lines.

Every line is labelled good or bad from its own features and those of the
lines beside it; forward-backward marginals, weighted by line length, give the
document's score. Training lines carry their document's label.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import as_bytes, fold, packed, text_blocks, train_in_task
from lakeloom.llm.crf import Adam, Chains, forward_backward, observed

SAMPLE_ROWS = 6000  # labelled documents the model is fitted on, at most
SAMPLE_BYTES = 1 << 16  # longest document in that sample
SAMPLE_LINES = 1 << 18  # lines of it that the model is fitted on, at most
_CUTS = (0.01, 0.05, 0.15, 0.4)

_rng = np.random.Generator(np.random.PCG64(77))
_MIX = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


def _class_table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


_UPPER = _class_table(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_CLASSES = [_UPPER, _class_table(b"0123456789"), _class_table(b"#$%&*@^~=+<>\\/_{}[]"),
            _class_table(b"!?"), _class_table(b"|"), _class_table(b".,;:'\"()-"),
            np.arange(256) >= 128]
_SPACE = _class_table(b" \t\r\n\x0b\x0c")


WINDOW_LINES = 1 << 14  # lines whose features are held at a time
WINDOW_BYTES = 1 << 20
LONG_CHAIN = 1 << 15  # lines from which a document is walked by itself
TWIN = 5  # column of a line that repeats in its document


class Lines:
    """Lines of some texts end to end; an empty text is one empty line.
    Features are made window by window, so memory follows the bytes and a few
    numbers per line, whatever the lines are like."""

    def __init__(self, rows: list[bytes]) -> None:
        self.data, offsets = packed([r + b"\n" for r in rows])
        self.ends = np.flatnonzero(self.data == 10) + 1
        self.starts = np.r_[0, self.ends[:-1]]
        self.per_doc = np.diff(np.searchsorted(self.ends, offsets, side="right"))
        self.length = (self.ends - self.starts - 1).astype(np.float64)
        self.heads = np.cumsum(self.per_doc) - self.per_doc

    def windows(self) -> Iterator[tuple[int, int]]:
        at, n = 0, len(self.ends)
        while at < n:
            to = int(np.searchsorted(self.ends, self.starts[at] + WINDOW_BYTES, side="right"))
            to = max(at + 1, min(to, at + WINDOW_LINES, n))
            yield at, to
            at = to

    def own(self, a: int, z: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Features of lines a..z but for repetition in the document, and the
        key of their words with whether there are two or more of them."""
        base = self.starts[a]
        data = self.data[base:self.ends[z - 1]]
        starts, ends, length = self.starts[a:z] - base, self.ends[a:z] - base, self.length[a:z]
        n = z - a
        size = np.maximum(length, 1.0)
        ratios = [np.add.reduceat(t[data].view(np.uint8), starts, dtype=np.int64) / size for t in _CLASSES]
        space = _SPACE[data]
        begin = np.flatnonzero(~space & np.r_[True, space[:-1]])
        line_of = np.searchsorted(ends, begin, side="right")
        n_words = np.bincount(line_of, minlength=n).astype(np.float64)
        rep1 = rep2 = np.zeros(n)
        key = np.zeros(n, np.uint64)
        if len(begin):
            sig = np.add.reduceat(np.where(space, np.uint64(0), _MIX[data]), begin)
            same1 = np.r_[False, (sig[1:] == sig[:-1]) & (line_of[1:] == line_of[:-1])]
            same2 = np.r_[False, False, (sig[2:] == sig[:-2]) & (line_of[2:] == line_of[:-2])][:len(sig)]
            rep1 = np.bincount(line_of, weights=same1, minlength=n) / np.maximum(n_words, 1)
            rep2 = np.bincount(line_of, weights=same2, minlength=n) / np.maximum(n_words, 1)
            pos = np.arange(len(sig)) - np.searchsorted(line_of, line_of)
            np.add.at(key, line_of, sig * (2 * pos + 1).astype(np.uint64))
        mean_word = (length - n_words + 1) / np.maximum(n_words, 1)
        cols = ratios + [rep1, rep2]
        plain = [np.ones(n), np.log1p(length) / 6, np.minimum(mean_word, 30) / 10,
                 (n_words <= 2).astype(float), (length == 0).astype(float), np.zeros(n)]
        steps = [(c > cut).astype(float) for c in cols for cut in _CUTS]
        return np.stack(plain + cols + steps, axis=1).astype(np.float32), key, n_words > 1

    def twins(self, key: np.ndarray, several: np.ndarray) -> np.ndarray:
        """Lines of two or more words that occur again in their document."""
        at = np.flatnonzero(several)
        doc = np.searchsorted(self.heads, at, side="right") - 1
        # documents without a line do not exist: heads are distinct
        full = key[at] ^ (doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, inv, count = np.unique(full, return_inverse=True, return_counts=True)
        out = np.zeros(len(key))
        out[at[count[inv] > 1]] = 1.0
        return out

    def beside(self, x: np.ndarray, step: int) -> np.ndarray:
        """Values of the line before (1) or after (-1), zero beyond the
        document."""
        out = np.zeros_like(x)
        if step > 0:
            out[1:] = x[:-1]
            out[self.heads] = 0
        else:
            out[:-1] = x[1:]
            out[np.r_[self.heads[1:] - 1, len(x) - 1]] = 0
        return out


def line_features(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, line lengths, lines per document) of texts that fit memory
    with all features of every line: own, of the line before and after."""
    t = Lines(rows)
    parts = [t.own(a, z) for a, z in t.windows()]
    own = np.concatenate([x for x, _, _ in parts])
    own[:, TWIN] = t.twins(np.concatenate([k for _, k, _ in parts]), np.concatenate([s for _, _, s in parts]))
    return np.concatenate([own, t.beside(own, 1), t.beside(own, -1)], axis=1), t.length, t.per_doc


def line_emissions(t: Lines, w: np.ndarray) -> np.ndarray:
    """Log odds of a good line from its features, as :func:`line_features`
    has them, without holding them."""
    parts = w.reshape(3, -1).T  # own, before, after
    n = len(t.ends)
    dots, key, several = np.empty((n, 3)), np.empty(n, np.uint64), np.empty(n, bool)
    for a, z in t.windows():
        own, key[a:z], several[a:z] = t.own(a, z)
        dots[a:z] = own @ parts
    dots += t.twins(key, several)[:, None] * parts[TWIN]
    return dots[:, 0] + t.beside(dots[:, 1], 1) + t.beside(dots[:, 2], -1)


def long_chain(emit: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Marginals of label 1 along one chain of two labels, in memory of two
    numbers a line."""
    (t00, t01), (t10, t11) = np.exp(trans).tolist()
    s0, s1 = np.exp(start).tolist()
    odds = np.exp(np.clip(emit, -60, 60))
    good = np.empty(len(emit))  # forward share of label 1, then the marginal
    a0, a1, first = s0, s1, True
    for at in range(0, len(emit), WINDOW_LINES):
        out = []
        for r in odds[at:at + WINDOW_LINES].tolist():
            if not first:
                a0, a1 = a0 * t00 + a1 * t10, a0 * t01 + a1 * t11
            first = False
            a1 *= r
            total = a0 + a1
            a0, a1 = a0 / total, a1 / total
            out.append(a1)
        good[at:at + len(out)] = out
    b0 = b1 = 1.0
    for at in range((len(emit) - 1) // WINDOW_LINES * WINDOW_LINES, -1, -WINDOW_LINES):
        out = []
        for r, f in zip(odds[at:at + WINDOW_LINES][::-1].tolist(), good[at:at + WINDOW_LINES][::-1].tolist()):
            x = f * b1
            out.append(x / (x + (1 - f) * b0))
            y = r * b1
            b0, b1 = t00 * b0 + t01 * y, t10 * b0 + t11 * y
            total = b0 + b1
            b0, b1 = b0 / total, b1 / total
        good[at:at + len(out)] = out[::-1]
    return good


def line_marginals(t: Lines, m: dict[str, np.ndarray]) -> np.ndarray:
    """Probability of a good line, by forward-backward over every document:
    many short ones side by side, a long one by itself."""
    score = line_emissions(t, m["w"])
    out = np.empty(len(score))
    long = t.per_doc >= LONG_CHAIN
    for k in np.flatnonzero(long).tolist():
        a = int(t.heads[k])
        z = a + int(t.per_doc[k])
        out[a:z] = long_chain(score[a:z], m["trans"], m["start"])
    if not long.all():
        rest = np.repeat(~long, t.per_doc)
        emit = np.zeros((int(rest.sum()), 2))
        emit[:, 1] = score[rest]
        out[rest] = forward_backward(emit, Chains(t.per_doc[~long]), m["trans"], m["start"])[:, 1]
    return out


def fit(table: pa.Table, steps: int = 200, rate: float = 0.05, l2: float = 1e-3) -> bytes:
    """CRF weights from (text, label) rows; label 1 is good. Labels that are
    all equal or absent give a constant model with that share."""
    labels = np.array([-1 if x is None else int(x) for x in table.column("label").to_pylist()], np.int64)
    known = np.isin(labels, (0, 1))
    share = float(labels[known].mean()) if known.any() else 0.5
    out = {"share": np.array(share)}
    if known.any() and 0 < share < 1:
        texts = as_bytes(table.column("text").combine_chunks())
        # rows come in any order; the same ones stay
        order = sorted(np.flatnonzero(known).tolist(), key=lambda i: (zlib.crc32(texts[i]), texts[i]))
        lines = np.cumsum([texts[i].count(b"\n") + 1 for i in order])
        order = order[:max(1, int(np.searchsorted(lines, SAMPLE_LINES, side="right")))]
        known = np.array(order)
        share = float(labels[known].mean())
        if not 0 < share < 1:
            return _saved({"share": np.array(share)})
        x, _, per_doc = line_features([texts[i] for i in order])
        y = np.repeat(labels[known], per_doc)
        chains = Chains(per_doc)
        p = {"w": np.zeros(x.shape[1]), "trans": np.zeros((2, 2)), "start": np.zeros(2)}
        moves, first = observed(y, chains, 2)
        n = float(len(y))
        opt = Adam(rate)
        for _ in range(steps):
            emit = np.zeros((len(x), 2))
            emit[:, 1] = x @ p["w"]
            m, em, ef, _z = forward_backward(emit, chains, p["trans"], p["start"], pairs=True)
            opt.step(p, {"w": x.T @ (m[:, 1] - (y == 1)) / n + l2 * p["w"],
                         "trans": (em - moves) / n + l2 * p["trans"],
                         "start": (ef - first) / n + l2 * p["start"]})
        out = {"share": np.array(share)} | p
    return _saved(out)


def _saved(arrays: dict[str, np.ndarray]) -> bytes:
    buf = io.BytesIO()
    np.savez(buf, **arrays)
    return buf.getvalue()


def load(model: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(model)) as z:
        return {k: z[k] for k in z.files}


def score_texts(rows: list[bytes], m: dict[str, np.ndarray]) -> np.ndarray:
    """Length-weighted share of good lines per text."""
    if not rows:
        return np.zeros(0)
    if "w" not in m:
        return np.full(len(rows), float(m["share"]))
    t = Lines(rows)
    good = line_marginals(t, m)
    weight = t.length + 1
    s = np.add.reduceat(good * weight, t.heads) / np.add.reduceat(weight, t.heads)
    return np.clip(s, 0.0, 1.0)


def train(docs: DataFrame, labels: DataFrame, *, folds: int = 3, held: int = 1,
          sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> bytes:
    """Fit on at most ``sample_rows`` labelled documents outside the held-out
    fold, the smallest by a seeded hash of their id, of which the fit takes
    ``SAMPLE_LINES`` lines at most; documents over ``sample_bytes`` take no
    part. Of rows that share an id the smallest text is taken."""
    picked = (labels.select(F.col("doc_id"), F.col("quality").cast("int").alias("label"))
              .where((fold("doc_id", folds) != held) & F.col("label").isin(0, 1))
              .groupBy("doc_id").agg(F.max("label").alias("label"))
              .orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").limit(sample_rows))
    sample = (docs.select("doc_id", "text").where(F.coalesce(F.octet_length("text"), F.lit(0)) <= sample_bytes)
              .join(F.broadcast(picked), "doc_id").groupBy("doc_id")
              .agg(F.min("text").alias("text"), F.max("label").alias("label")).select("text", "label"))
    return train_in_task(sample, fit)


def score_documents(docs: DataFrame, model: bytes, *, folds: int = 3, held: int = 1,
                    threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Whole texts are scored; null and empty texts are one empty line. Rows
    repeat as often as the input; a null id falls in fold 0; other columns are
    ignored; an empty table gives no rows. No shuffle.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load(model)
        for b in text_blocks(batches):
            s = score_texts(as_bytes(b.column("text")), m)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(s)],
                                             names=["doc_id", "held_out", "score"])

    d = docs.select("doc_id", (fold("doc_id", folds) == held).alias("held_out"), "text")
    return (d.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, "
                              "held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def keep_good(docs: DataFrame, model: bytes, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``; all
    columns pass through one scan, without a join."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load(model)
        for b in text_blocks(batches):
            s = score_texts(as_bytes(b.column("text")), m)
            yield b.filter(pa.array(s >= threshold))

    return docs.mapInArrow(run, docs.schema)
