"""Language of every word, and of every document, by a linear-chain CRF.

Words are scored from affixes, letter trigrams and a lexicon of the training
sample; learned transitions join neighbouring words, so code-switched text is
labelled word by word with forward-backward. A document's language is the
label with the largest expected share of its words.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lakeloom.llm.common import as_bytes, fold, packed, text_blocks, train_in_task
from lakeloom.llm.crf import Adam, Chains, forward_backward, observed

PER_LANGUAGE = 250  # training documents of each language, at most
SAMPLE_BYTES = 1 << 15  # longest document in that sample
TABLE = 1 << 16  # weights of hashed affixes, and of hashed trigrams (slots are 16 bits)
LEXICON = 1 << 14  # most frequent words of the sample
SPAN = 24  # words of one language in a training chain
CHAIN_BYTES = 8 << 20  # text whose chains are walked together
FEATURE_BYTES = 1 << 20

_AFFIXES = [("pre", 1), ("pre", 2), ("pre", 3), ("suf", 1), ("suf", 2), ("suf", 3), ("suf", 4)]
_rng = np.random.Generator(np.random.PCG64(5))
_MIX = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_MUL = np.uint64(0x9E3779B97F4A7C15)

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lowered(data: np.ndarray) -> np.ndarray:
    """Lower case of A-Z and of the two-byte Latin-1 capitals."""
    out = _LOWER[data]
    after = np.zeros(len(data), bool)
    after[1:] = data[:-1] == 0xC3
    capital = after & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
    out[capital] += 0x20
    return out


def word_spans(data: np.ndarray, offsets: np.ndarray):
    """Starts and ends of words (runs of letters within one row), and words
    per row."""
    letter = _LETTER[data]
    begin = letter.copy()
    begin[1:] &= ~letter[:-1]
    row_start = offsets[:-1][offsets[:-1] < offsets[1:]]
    begin[row_start] = letter[row_start]
    stop = letter.copy()
    stop[:-1] &= ~letter[1:]
    stop[offsets[1:][offsets[:-1] < offsets[1:]] - 1] |= letter[offsets[1:][offsets[:-1] < offsets[1:]] - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    row = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, np.bincount(row, minlength=len(offsets) - 1)


def _slot(h: np.ndarray) -> np.ndarray:
    return ((h * _MUL) >> np.uint64(48)).astype(np.int32)


def word_heads(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """The first 16 and the last 8 bytes of every word as numbers (zero where
    the word is shorter), and its length."""
    pad = np.concatenate([np.zeros(8, np.uint8), data, np.zeros(16, np.uint8)])
    window = np.ndarray((len(pad) - 7,), "<u8", pad, strides=(1,))
    n = ends - starts
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    keep = np.array([0] + [(1 << (8 * i)) - 1 for i in range(1, 8)] + [int(full)], np.uint64)
    first = window[starts + 8] & keep[np.minimum(n, 8)]
    second = window[starts + 16] & keep[np.clip(n - 8, 0, 8)]
    last = window[ends]
    return first, second, last, n


_KEEP = np.array([(1 << (8 * i)) - 1 for i in range(5)], np.uint64)


def affix_slots(heads) -> list[np.ndarray]:
    """Per affix kind its weight slot for every word; an affix longer than
    the word is the whole word."""
    first, _, last, n = heads
    out = []
    for j, (kind, size) in enumerate(_AFFIXES):
        m = np.minimum(n, size)
        part = first & _KEEP[m] if kind == "pre" else last >> (np.uint64(64) - np.uint64(8) * m.astype(np.uint64))
        out.append(_slot((part << np.uint64(8)) + np.uint64(j + 1)))
    return out


def trigram_slots(data: np.ndarray) -> np.ndarray:
    """Weight slot of the three bytes around every position."""
    pad = np.r_[np.uint8(32), data, np.uint8(32)].astype(np.uint64)
    h = (pad[:-2] << np.uint64(16)) | (pad[1:-1] << np.uint64(8)) | pad[2:]
    return _slot(h + np.uint64(0x51ED27))


def word_keys(data: np.ndarray, starts: np.ndarray, heads) -> np.ndarray:
    """64-bit key of every word; words over 16 bytes are hashed whole."""
    first, second, last, n = heads
    key = (first * _MUL) ^ (second * np.uint64(0xC2B2AE3D27D4EB4F))
    key ^= key >> np.uint64(32)
    key = key * np.uint64(0x165667B19E3779F9) + n.astype(np.uint64)
    for i in np.flatnonzero(n > 16).tolist():
        word = data[starts[i]:starts[i] + n[i]]
        pos = np.arange(len(word), dtype=np.uint64)
        total = int((_MIX[word] * (np.uint64(2) * pos + np.uint64(1))).sum(dtype=np.uint64))
        key[i] ^= np.uint64((total * int(_MUL)) & 0xFFFFFFFFFFFFFFFF)
    return key


def fit(table: pa.Table, steps: int = 60, rate: float = 0.15, l2: float = 1e-6, seed: int = 3) -> bytes:
    """Model bytes from rows (text, lang). Training chains join spans of
    random documents, so the transitions learn to stay and to switch."""
    lang = table.column("lang").to_pylist()
    langs = sorted({x for x in lang if x is not None})
    if len(langs) < 2:
        return pickle.dumps({"langs": langs})
    rows = as_bytes(table.column("text").combine_chunks())
    raw, offsets = packed(rows)
    data = lowered(raw)
    starts, ends, per_row = word_spans(data, offsets)
    label = np.repeat([langs.index(x) for x in lang], per_row)
    # spans of one document, shuffled into chains of three
    row = np.repeat(np.arange(len(rows)), per_row)
    nth = np.arange(len(starts)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    span = np.unique(np.stack([row, nth // SPAN]), axis=1, return_inverse=True)[1].ravel()
    shuffled = np.random.default_rng(seed).permutation(int(span.max()) + 1 if len(span) else 0)
    place = shuffled[span]
    order = np.lexsort((nth, row, place))
    starts, ends, label = starts[order], ends[order], label[order]
    chains = Chains(np.bincount(place // 3))

    heads = word_heads(data, starts, ends)
    keys = word_keys(data, starts, heads)
    uniq, inv, count = np.unique(keys, return_inverse=True, return_counts=True)
    kept = np.sort(uniq[np.argsort(-count, kind="stable")[:LEXICON]][
        np.sort(-count, kind="stable")[:LEXICON] <= -5])
    lex = np.searchsorted(kept, keys)
    lex[(lex >= len(kept)) | (kept[np.minimum(lex, max(len(kept) - 1, 0))] != keys)
        if len(kept) else slice(None)] = len(kept)
    k = len(langs)
    affix = affix_slots(heads)
    tri = trigram_slots(data)
    n_len = ends - starts
    tri_word = np.repeat(np.arange(len(starts)), n_len)
    tri_at = np.repeat(starts, n_len) + np.arange(n_len.sum()) - np.repeat(np.cumsum(n_len) - n_len, n_len)
    tri_slot = tri[tri_at]
    tri_head = np.cumsum(n_len) - n_len

    p = {"lex": np.zeros((len(kept) + 1, k)), "affix": np.zeros((len(_AFFIXES), TABLE, k)),
         "tri": np.zeros((TABLE, k)), "trans": np.zeros((k, k)), "start": np.zeros(k),
         "bias": np.zeros(k)}
    moves, first = observed(label, chains, k)
    hot = np.zeros((len(label), k))
    hot[np.arange(len(label)), label] = 1
    n = float(max(len(label), 1))
    opt = Adam(rate)
    for _ in range(steps):
        emit = p["bias"] + p["lex"][lex]
        for a, s in zip(p["affix"], affix):
            emit = emit + a[s]
        emit += np.add.reduceat(p["tri"][tri_slot], tri_head, axis=0)
        m, em, ef, _z = forward_backward(emit, chains, p["trans"], p["start"], pairs=True)
        d = (m - hot) / n
        g = {"trans": (em - moves) / n, "start": (ef - first) / n, "bias": d.sum(0)}
        g["lex"] = np.stack([np.bincount(lex, d[:, j], len(kept) + 1) for j in range(k)], 1)
        g["lex"][-1] = 0  # words outside the lexicon have no weight of their own
        g["affix"] = np.stack([np.stack([np.bincount(s, d[:, j], TABLE) for j in range(k)], 1) for s in affix])
        g["tri"] = np.stack([np.bincount(tri_slot, d[tri_word, j], TABLE) for j in range(k)], 1)
        opt.step(p, {name: x + l2 * p[name] for name, x in g.items()})
    small = {name: x.astype(np.float32) if x.ndim > 1 and name != "trans" else x for name, x in p.items()}
    return pickle.dumps({"langs": langs, "words": kept, **small})


class Tagger:
    """Word and document labels of texts under a fitted model."""

    def __init__(self, model: bytes) -> None:
        self.m = pickle.loads(model)
        self.langs = self.m["langs"]
        if len(self.langs) > 1:
            self.affix = [[np.ascontiguousarray(a[:, j]) for j in range(len(self.langs))]
                          for a in self.m["affix"]]
            # one more slot, of weight zero, for bytes between words
            self.tri = [np.append(self.m["tri"][:, j], np.float32(0)) for j in range(len(self.langs))]

    def emissions(self, rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Label scores of every word of ``rows``, and words per row."""
        m, k = self.m, len(self.langs)
        raw, offsets = packed(rows)
        if len(raw) == 0:
            return np.zeros((0, k)), np.zeros(len(rows), np.int64)
        data = lowered(raw)
        starts, ends, per_row = word_spans(data, offsets)
        if len(starts) == 0:
            return np.zeros((0, k)), per_row
        heads = word_heads(data, starts, ends)
        keys = word_keys(data, starts, heads)
        words = m["words"]
        lex = np.searchsorted(words, keys)
        if len(words):
            lex[(lex >= len(words)) | (words[np.minimum(lex, len(words) - 1)] != keys)] = len(words)
        emit = m["bias"] + m["lex"][lex]
        slots = affix_slots(heads)
        tri = trigram_slots(data)
        inside = np.zeros(len(data) + 1, np.int8)
        inside[starts] += 1
        inside[ends] -= 1
        tri[np.cumsum(inside[:-1], dtype=np.int8) == 0] = TABLE
        for j in range(k):
            for a, s in zip(self.affix, slots):
                emit[:, j] += a[j][s]
            emit[:, j] += np.add.reduceat(self.tri[j][tri], starts)
        return emit, per_row

    def shares(self, rows: list[bytes]) -> np.ndarray:
        """Expected share of each label among the words of every row; zeros
        for a row without words."""
        k = len(self.langs)
        parts, counts, at = [], [], 0
        while at < len(rows):
            z, size = at, 0
            while z < len(rows) and (z == at or size + len(rows[z]) <= FEATURE_BYTES):
                size += len(rows[z])
                z += 1
            emit, per_row = self.emissions(rows[at:z])
            parts.append(emit)
            counts.append(per_row)
            at = z
        if not parts:
            return np.zeros((0, k))
        emit, per_row = np.concatenate(parts), np.concatenate(counts)
        marg = forward_backward(emit, Chains(per_row), self.m["trans"], self.m["start"])
        row = np.repeat(np.arange(len(rows)), per_row)
        total = np.stack([np.bincount(row, marg[:, j], len(rows)) for j in range(k)], 1)
        return total / np.maximum(per_row, 1)[:, None]

    def predict(self, rows: list[bytes]) -> list[tuple[str, float]]:
        """(language, score) per text; ``und`` and 0 without a letter."""
        if not self.langs:
            return [("und", 0.0)] * len(rows)
        real = [has_letter(r) for r in rows]
        if len(self.langs) == 1:
            return [(self.langs[0], 1.0) if x else ("und", 0.0) for x in real]
        out = []
        for s, x in zip(self.shares(rows), real):
            j = int(s.argmax())
            out.append((self.langs[j], float(min(max(s[j], 0.0), 1.0))) if x else ("und", 0.0))
        return out


_ASCII_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))


def has_letter(text: bytes) -> bool:
    if len(text.translate(None, _ASCII_LETTERS)) < len(text):
        return True
    return any(c.isalpha() for c in text.decode("utf-8", "replace")) if not text.isascii() else False


def train(docs: DataFrame, *, folds: int = 4, held: int = 2, per_language: int = PER_LANGUAGE,
          sample_bytes: int = SAMPLE_BYTES) -> bytes:
    """Fit on at most ``per_language`` documents of each language outside the
    held-out fold, the smallest by a seeded hash of their id; documents over
    ``sample_bytes`` take no part in the fit."""
    order = W.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit(31)), "doc_id")
    ids = (docs.where((fold("doc_id", folds) != held) & F.col("lang").isNotNull()
                      & (F.octet_length("text") <= sample_bytes))
           .select(F.col("doc_id"), F.col("lang"))
           .withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_language)
           .select("doc_id").distinct())
    sample = (docs.where(F.col("lang").isNotNull() & (F.octet_length("text") <= sample_bytes))
              .select("doc_id", "text", "lang").join(F.broadcast(ids), "doc_id").select("text", "lang"))
    return train_in_task(sample, fit)


def identify(docs: DataFrame, model: bytes, *, folds: int = 4, held: int = 2) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs``.

    Whole texts are labelled; null text and text without a letter is ``und``
    with score 0. Text in letters the model never saw gets its best guess.
    Rows repeat as often as the input; a null id falls in fold 0; other
    columns are ignored; an empty table gives no rows. No shuffle.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model)
        for b in text_blocks(batches, max_bytes=CHAIN_BYTES):
            found = tagger.predict(as_bytes(b.column("text")))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array([x for x, _ in found], pa.string()),
                 pa.array([s for _, s in found], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"])

    d = docs.select("doc_id", (fold("doc_id", folds) == held).alias("held_out"), "text")
    return d.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, "
                             "lang_pred string, score double")
