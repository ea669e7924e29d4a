"""Benchmark decontamination: BM25 retrieval with block-max WAND, then an
overlap check of question and answer.

The test items form a small inverted index whose impacts are divided by the
least score an item can have in a passage that still passes the overlap
check, so 1 is the threshold of every item and retrieval loses nothing that
the check would accept. Every training passage is a query: documents are cut
into windows that overlap by at least the longest item.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import Scratch, text_blocks

SHINGLE = 5
OVERLAP = 0.8  # share of an item's shingles a passage must hold
ANSWER = 0.5  # share of the answer's words
K1, B = 1.2, 0.75
BLOCK = 16  # postings per block
LIGHT = 0.75  # part of an item's threshold its widespread terms may make up
INDEX_BYTES = 16 << 20  # item text in one index; more items are searched in several passes
_SEPARATE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(_SEPARATE).split()


def shingles(words: list, n: int = SHINGLE) -> set:
    """The n-word shingles; the whole sequence if it is shorter."""
    if not words:
        return set()
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))}


def split_item(text: str) -> tuple[str, str]:
    """(question, answer): the last sentence is the answer; an item of one
    sentence has none."""
    parts = _SENTENCE.split(text.strip())
    return (" ".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (text, "")


class Statistics:
    """What BM25 needs of all test items: their number, mean length and the
    items that hold each term."""

    def __init__(self, n: int, mean: float, df: dict[bytes, int]) -> None:
        self.n, self.mean, self.df = n, mean, df

    @classmethod
    def of(cls, texts: list[list[bytes]]) -> Statistics:
        n = len(texts)
        return cls(n, sum(map(len, texts)) / n if n else 1.0, Counter(t for w in texts for t in set(w)))


class Index:
    """Inverted index of test items with normalised BM25 impacts. Of a part of
    the items it needs the statistics of all of them."""

    def __init__(self, items: list[tuple[int, str, str]], stats: Statistics | None = None) -> None:
        self.ids, texts, self.answers = [], [], []
        for i, question, answer in items:
            q, a = words_of(question), words_of(answer)
            if q or a:
                self.ids.append(i)
                texts.append(q + a)
                self.answers.append(Counter(a))
        n = len(texts)
        stats = stats or Statistics.of(texts)
        mean = stats.mean
        idf = {t: math.log(1 + (stats.n - stats.df[t] + 0.5) / (stats.df[t] + 0.5))
               for t in {t for w in texts for t in w}}
        self.shingles = [shingles(w) for w in texts]
        self.longest = max(map(len, texts), default=1)
        posting = defaultdict(list)
        for k, w in enumerate(texts):
            tf = Counter(w)
            norm = K1 * (1 - B + B * len(w) / mean)
            impact = {t: idf[t] * c * (K1 + 1) / (c + norm) for t, c in tf.items()}
            # a passage that misses no more shingles than allowed misses at
            # most as many words; the heaviest are assumed missing
            lost = math.floor((1 - OVERLAP) * max(1, len(w) - SHINGLE + 1) + 1e-9)
            rank = sorted(impact, key=lambda t: (-impact[t], t))
            least = sum(impact[t] for t in rank[lost:])
            if least <= 0:  # every word may be missing: any shared word will do
                least = min(impact.values())
            for t, x in impact.items():
                posting[t].append((k, x / least))
        self.terms = {t: j for j, t in enumerate(sorted(posting))}
        self.lists = []
        for t in sorted(posting):
            items_, imp = zip(*posting[t])
            blocks = [(items_[s:s + BLOCK][-1], max(imp[s:s + BLOCK])) for s in range(0, len(imp), BLOCK)]
            self.lists.append((items_, imp, max(imp), blocks))
        # an item's most widespread terms cannot make it a candidate alone:
        # the others must still add up to ``need``
        per_item = defaultdict(list)
        for j, (items_, imp, _, _) in enumerate(self.lists):
            for k, x in zip(items_, imp):
                per_item[k].append((x, j))
        self.need = np.ones(n)
        rare: dict[int, list[tuple[int, float]]] = defaultdict(list)
        for k, rows in per_item.items():
            rows.sort(key=lambda r: (-len(self.lists[r[1]][0]), r[0]))
            light, i = 0.0, 0
            while i < len(rows) and light + rows[i][0] < LIGHT:
                light += rows[i][0]
                i += 1
            self.need[k] = 1 - light
            for x, j in rows[i:]:
                rare[j].append((k, x))
        # rare postings of every term, end to end
        sizes = np.array([len(rare[j]) for j in range(len(self.lists))], np.int64)
        self.rare_at = np.r_[0, np.cumsum(sizes)]
        flat = [x for j in range(len(self.lists)) for x in rare[j]]
        self.rare_item = np.array([k for k, _ in flat], np.int64)
        self.rare_weight = np.array([x for _, x in flat], np.float64)

    def wand(self, terms: list[int]) -> list[tuple[int, float]]:
        """Items with score at least 1 for a query of distinct terms."""
        cursors = [[0, self.lists[j]] for j in terms]
        found = []
        while cursors:
            cursors.sort(key=lambda c: c[1][0][c[0]])
            # pivot: the first item whose lists could reach the threshold
            bound, p = 0.0, -1
            for i, c in enumerate(cursors):
                bound += c[1][2]
                if bound >= 1 - 1e-9:
                    p = i
                    break
            if p < 0:
                break
            pivot = cursors[p][1][0][cursors[p][0]]
            while p + 1 < len(cursors) and cursors[p + 1][1][0][cursors[p + 1][0]] == pivot:
                p += 1
            # the blocks that hold the pivot give a closer bound
            shallow, jump = 0.0, None
            for c in cursors[:p + 1]:
                for last, top in c[1][3]:
                    if last >= pivot:
                        shallow += top
                        jump = last if jump is None else min(jump, last)
                        break
            if shallow >= 1 - 1e-9:
                score = 0.0
                for c in cursors[:p + 1]:
                    self._seek(c, pivot)
                    if c[0] < len(c[1][0]) and c[1][0][c[0]] == pivot:
                        score += c[1][1][c[0]]
                        c[0] += 1
                if score >= 1 - 1e-9:
                    found.append((pivot, score))
            else:
                to = jump + 1 if jump is not None else pivot + 1
                if p + 1 < len(cursors):
                    to = min(to, cursors[p + 1][1][0][cursors[p + 1][0]])
                for c in cursors[:p + 1]:
                    self._seek(c, max(to, pivot + 1))
            cursors = [c for c in cursors if c[0] < len(c[1][0])]
        return found

    @staticmethod
    def _seek(c: list, item: int) -> None:
        items, at = c[1][0], c[0]
        while at < len(items) and items[at] < item:
            at += 1
        c[0] = at

    def verify(self, item: int, window: list[bytes]) -> float | None:
        """The share of the item's shingles in the window, if that and the
        answer's words suffice."""
        want = self.shingles[item]
        got = want & shingles(window, len(next(iter(want))) if want else SHINGLE)
        share = len(got) / len(want)
        if share < OVERLAP - 1e-9:
            return None
        answer = self.answers[item]
        if answer:
            have = Counter(window)
            if sum(min(n, have[t]) for t, n in answer.items()) < ANSWER * sum(answer.values()):
                return None
        return share

    def candidates(self, rows: list[list[bytes]]) -> list[tuple[int, int]]:
        """(row, first word) of every window in which the rare terms of some
        item reach what they must, counted once per half window."""
        get, step = self.terms.get, self.longest
        ids, half, row_of, begin = [], [], [], []
        for r, words in enumerate(rows):
            found = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
            # one empty half before each row keeps rows apart
            base = len(row_of) + 1
            halves = -(-len(words) // step)
            row_of += [-1] + [r] * halves
            begin += [0] + [h * step for h in range(halves)]
            at = np.flatnonzero(found >= 0)
            ids.append(found[at])
            half.append(at // step + base)
        term, cell = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (ids, half))
        if len(term) == 0:
            return []
        pair = np.unique(cell * len(self.lists) + term)
        cell, term = pair // len(self.lists), pair % len(self.lists)
        n = self.rare_at[term + 1] - self.rare_at[term]
        at = np.repeat(self.rare_at[term] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        if len(at) == 0:
            return []
        item, weight = self.rare_item[at], self.rare_weight[at]
        cell = np.repeat(cell, n)
        # a window is a half and the one after it
        key = np.concatenate([cell, cell - 1]) * len(self.ids) + np.tile(item, 2)
        key, inv = np.unique(key, return_inverse=True)
        total = np.bincount(inv, np.tile(weight, 2))
        windows = np.unique(key[total >= self.need[key % len(self.ids)] - 1e-9] // len(self.ids))
        out = []
        for w in windows.tolist():
            if row_of[w] >= 0:
                out.append((row_of[w], begin[w]))
        return out

    def search(self, texts: list[str]) -> list[dict[int, tuple[float, float, int]]]:
        """Per text: item id -> (score, overlap, first word of the window)."""
        rows = [words_of(t) for t in texts]
        out: list[dict[int, tuple[float, float, int]]] = [{} for _ in rows]
        if not self.lists:
            return out
        for r, s in self.candidates(rows):
            window = rows[r][s:s + 2 * self.longest]
            terms = sorted({self.terms[w] for w in window if w in self.terms})
            for item, score in self.wand(terms):
                share = self.verify(item, window)
                if share is not None:
                    key, old = self.ids[item], out[r].get(self.ids[item])
                    if old is None or (share, score, -s) > (old[1], old[0], -old[2]):
                        out[r][key] = (score, share, s)
        return out


def _statistics(items: DataFrame) -> Statistics:
    """Statistics of all items (q, a), counted by tasks; what comes back is as
    large as the items' vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, length = Counter(), 0, 0
        for b in batches:
            for q, a in zip(b.column("q").to_pylist(), b.column("a").to_pylist()):
                w = words_of(q) + words_of(a)
                if w:
                    n, length = n + 1, length + len(w)
                    df.update(set(w))
        terms = list(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *terms], pa.binary()), pa.array([n, *[df[t] for t in terms]], pa.int64()),
             pa.array([length] + [0] * len(terms), pa.int64())], names=["term", "n", "length"])

    rows = (items.select("q", "a").mapInArrow(run, "term binary, n bigint, length bigint")
            .groupBy("term").agg(F.sum("n").alias("n"), F.sum("length").alias("length")).collect())
    whole = next((r for r in rows if r["term"] is None), None)
    n = whole["n"] if whole else 0
    return Statistics(n, whole["length"] / n if n else 1.0,
                      {bytes(r["term"]): r["n"] for r in rows if r["term"] is not None})


def index_parts(benchmark: DataFrame, item_col: str, text_col: str, answer_col: str | None,
                index_bytes: int) -> list[bytes]:
    """Packed indexes of parts of at most about ``index_bytes`` of item text,
    one part at least. Tasks build them with the statistics of all items; the
    driver only hands the packed bytes on."""
    raw = (benchmark.select(F.col(item_col).cast("bigint").alias("i"),
                            F.coalesce(F.col(text_col), F.lit("")).alias("q"),
                            (F.coalesce(F.col(answer_col), F.lit("")) if answer_col else F.lit(None)
                             .cast("string")).alias("a"))
           .where(F.col("i").isNotNull()).distinct())
    if not answer_col:
        split = F.udf(split_item, "struct<q:string,a:string>", useArrow=True)
        raw = raw.select("i", split("q").alias("s")).select("i", "s.q", "s.a")
    scratch = Scratch(benchmark.sparkSession, "decontam")
    items = scratch.write(raw, "items")
    stats = _statistics(items)
    size = items.agg(F.sum(F.octet_length("q") + F.octet_length("a"))).first()[0] or 0
    parts = max(1, math.ceil(size / index_bytes))

    def build(t: pa.Table) -> pa.Table:
        rows = sorted(zip(*(t.column(c).to_pylist() for c in ("i", "q", "a"))))
        return pa.table({"index": pa.array([pack(Index(rows, stats))], pa.binary())})

    built = (items.withColumn("part", F.pmod(F.xxhash64("i"), F.lit(parts))).groupBy("part")
             .applyInArrow(build, "index binary"))
    out = [bytes(r["index"]) for r in built.toLocalIterator()]
    scratch.drop("items")
    return out or [pack(Index([]))]


def pack(index: Index) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(index, protocol=5))


def unpack(blob: bytes) -> Index:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


def contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", answer_col: str | None = None,
                 index_bytes: int = INDEX_BYTES) -> DataFrame:
    """(doc_id, item_id, score, overlap, word_at): every test item found in
    every document, once per pair and row.

    A passage holds an item if at least 0.8 of the item's five-word shingles
    and half the words of its answer lie in one window; without ``answer_col``
    the item's last sentence is its answer. Case and punctuation do not count.
    Null and empty texts and items match nothing; repeated rows repeat their
    pairs; rows of one item id are separate texts under one id; other columns
    are ignored; empty tables give no rows.

    Scale: documents are not shuffled. A part of the index holds about
    ``index_bytes`` of item text, is built in a task and sent to the tasks that
    search; a larger benchmark is searched part by part, each in one scan, with
    the statistics of all items, so scores do not depend on the parts. The
    driver holds the packed parts, about as large as the item text.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = (f"doc_id {d.schema['doc_id'].dataType.simpleString()}, item_id bigint, score double, "
              "overlap double, word_at bigint")
    out = None
    for part in index_parts(benchmark, item_col, item_text_col, answer_col, index_bytes):
        found = d.mapInArrow(_finder(part), schema)
        out = found if out is None else out.unionByName(found)
    return out


def _finder(packed: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = unpack(packed)
        for b in text_blocks(batches):
            rows, keep = [], []
            texts = [t or "" for t in b.column("text").to_pylist()]
            for r, hits in enumerate(index.search(texts)):
                for item, (score, share, at) in sorted(hits.items()):
                    rows.append((item, score, share, at))
                    keep.append(r)
            if rows:
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(pa.array(keep)), pa.array(cols[0], pa.int64()),
                     pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.float64()),
                     pa.array(cols[3], pa.int64())],
                    names=["doc_id", "item_id", "score", "overlap", "word_at"])
    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text",
                      **kw) -> DataFrame:
    """The rows of ``docs`` that hold no test item; all columns pass through
    one scan per index part, without a join."""
    parts = index_parts(benchmark, kw.get("item_col", "item_id"), kw.get("item_text_col", "text"),
                        kw.get("answer_col"), kw.get("index_bytes", INDEX_BYTES))
    for part in parts:
        docs = docs.mapInArrow(_keeper(part, text_col), docs.schema)
    return docs


def _keeper(packed: bytes, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = unpack(packed)
        for b in text_blocks(batches, text_col):
            texts = [t or "" for t in b.column(text_col).to_pylist()]
            yield b.filter(pa.array([not hits for hits in index.search(texts)], pa.bool_()))
    return run
