"""Toxicity by non-negative positive-unlabelled learning.

A logistic model is trained from confirmed toxic texts and unlabelled texts
only. The risk is ``prior * R_pos(+) + max(0, R_unl(-) - prior * R_pos(-))``;
while the second part is negative its gradient is reversed, which keeps the
model from calling unlabelled positives negative. Features are whole words and
word beginnings with damped counts, all that tell the two samples apart, counted
exactly over the sample; a second occurrence has a weight of its own.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import Scratch, as_bytes, fold, sigmoid, text_blocks, train_in_task
from lakeloom.llm.crf import Adam

POSITIVES = 3000  # confirmed toxic documents the model is fitted on, at most
UNLABELLED = 6000  # unlabelled documents, at most
SAMPLE_BYTES = 1 << 16  # longest document in that sample
PREFIXES = (4, 5, 6)  # characters
LEAST = 8  # sample documents that hold a feature, at least
LEAST_Z = 5.0  # standard errors between its shares in the two samples
COUNTED = 1 << 18  # features a task counts before it hands them on
MEMO = 1 << 17  # words whose features a task remembers
MEMO_WORD = 64  # bytes of the longest such word

# everything but letters, digits and bytes of other scripts parts words
_SEPARATE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.decode("utf-8", "replace").lower().encode().translate(_SEPARATE).split()


def features_of(word: bytes) -> list[str]:
    w = word.decode("utf-8", "replace")
    return [w] + [w[:n] + "*" for n in PREFIXES if len(w) >= n]


def shorter(feature: str) -> list[str]:
    """The beginnings that cover a feature."""
    w = feature.rstrip("*")
    return [w[:n] + "*" for n in PREFIXES if n < len(w) or n == len(w) and feature == w]


def strength(pos: float, unl: float, n_pos: int, n_unl: int) -> float:
    """Difference of two shares in standard errors."""
    m = (pos + unl) / (n_pos + n_unl)
    return abs(pos / n_pos - unl / n_unl) / math.sqrt(m * (1 - m) * (1 / n_pos + 1 / n_unl) + 1e-12)


def count_features(texts: Iterable[bytes], positive: Iterable[bool],
                   most: int = 1 << 62) -> Iterator[dict[str, list[int]]]:
    """Documents that hold each feature, (unlabelled, positive), in parts of
    about ``most`` features."""
    seen: dict[str, list[int]] = {}
    for t, p in zip(texts, positive):
        for f in {f for w in set(words_of(t)) for f in features_of(w)}:
            seen.setdefault(f, [0, 0])[int(p)] += 1
        if len(seen) >= most:
            yield seen
            seen = {}
    yield seen


def telling(counts: Iterable[tuple[str, int, int]], n_pos: int, n_unl: int, least: int = LEAST,
            least_z: float = LEAST_Z) -> list[str]:
    """Of (feature, unlabelled, positive) those in enough documents whose share
    among positives lies far from that in the unlabelled sample; a word or
    beginning goes if a shorter beginning of it tells as much."""
    found = {f: strength(p, u, n_pos, n_unl) for f, u, p in counts if u + p >= least}
    found = {f: z for f, z in found.items() if z > least_z}
    return sorted(f for f, z in found.items() if all(found.get(s, 0.0) < z for s in shorter(f)))


class Lookup:
    """Counts the named features of texts; remembers words."""

    def __init__(self, names: dict[str, int]) -> None:
        self.names = names
        self.memo: dict[bytes, tuple[int, ...]] = {}

    def counts(self, text: bytes) -> list[tuple[int, int]]:
        """(feature, occurrences) in order of features."""
        out: dict[int, int] = {}
        memo, names = self.memo, self.names
        if len(memo) > MEMO:
            memo.clear()
        for w in words_of(text):
            ids = memo.get(w)
            if ids is None:
                ids = tuple(names[f] for f in features_of(w) if f in names)
                if len(w) <= MEMO_WORD:
                    memo[w] = ids
            for i in ids:
                out[i] = out.get(i, 0) + 1
        return sorted(out.items())


def fit(table: pa.Table, names: list[str] | None = None, steps: int = 1500, rate: float = 0.03,
        l2: float = 1e-5) -> bytes:
    """Model bytes from rows (text, positive, prior). ``names`` are the features;
    without them the telling ones of these rows."""
    positive = np.array([bool(x) for x in table.column("positive").to_pylist()], bool)
    prior = [x for x in table.column("prior").to_pylist() if x is not None]
    prior = min(max(prior[0] if prior else 0.5, 1e-3), 0.999)
    if positive.all() or not positive.any():
        return pickle.dumps({"names": {}, "w": np.zeros(0), "bias": float(np.log(prior / (1 - prior)))})
    texts = as_bytes(table.column("text").combine_chunks())
    n_pos, n_unl = int(positive.sum()), int((~positive).sum())
    if names is None:
        seen = next(count_features(texts, positive))
        names = telling(((f, u, p) for f, (u, p) in seen.items()), n_pos, n_unl)
    index = {f: i for i, f in enumerate(names)}
    look = Lookup(index)
    # the entries of the sparse matrix: few features occur in any one text
    cells = [(r, i, n) for r, t in enumerate(texts) for i, n in look.counts(t)]
    row, col, n = np.array(cells, np.int64).reshape(-1, 3).T
    twice = n > 1
    row, col = np.r_[row, row[twice]], np.r_[col, col[twice] + len(names)]
    val = np.r_[np.log2(1.0 + n), np.ones(int(twice.sum()))]
    p = {"w": np.zeros(len(names) * 2), "b": np.full(1, np.log(prior / (1 - prior)))}
    opt = Adam(rate)

    def back(weight: np.ndarray) -> np.ndarray:
        return np.bincount(col, val * weight[row], minlength=len(names) * 2)

    # steps that reverse the gradient make single models sway: the mean of the
    # second half of them is kept
    mean, late = {k: np.zeros_like(x) for k, x in p.items()}, range(steps // 2, steps)
    for i in range(steps):
        score = sigmoid(np.bincount(row, val * p["w"][col], minlength=len(texts)) + p["b"])
        gw, gb = risk_gradient(score, positive, prior, back)
        opt.step(p, {"w": gw + l2 * p["w"], "b": np.array([gb])})
        if i in late:
            for k, x in p.items():
                mean[k] += x / len(late)
    return pickle.dumps({"names": index, "w": mean["w"], "bias": float(mean["b"][0])})


def risk_gradient(score: np.ndarray, positive: np.ndarray, prior: float, back) -> tuple[np.ndarray, float]:
    """Gradient of the non-negative risk by the weights (``back`` carries a
    gradient by scores there) and by the bias."""
    zp, zu = score[positive], score[~positive]
    # logistic losses: R+ on positives, R- on both samples
    negative = (-np.log1p(-np.clip(zu, 0, 1 - 1e-9)).mean()
                + prior * np.log1p(-np.clip(zp, 0, 1 - 1e-9)).mean())
    uw = back(np.where(positive, -prior * score / len(zp), score / len(zu)))
    ub = zu.mean() - prior * zp.mean()
    if negative < 0:
        return -uw, -ub
    return (uw - back(np.where(positive, prior * (1 - score) / len(zp), 0.0)),
            ub - prior * (1 - zp).mean())


class Scorer:
    """Scores texts with a fitted model."""

    def __init__(self, model: bytes) -> None:
        m = pickle.loads(model)
        self.names, self.w, self.bias = m["names"], m["w"].tolist(), m["bias"]
        self.look = Lookup(self.names)

    def score(self, text: bytes) -> float:
        z, k = self.bias, len(self.names)
        for i, n in self.look.counts(text):
            z += self.w[i] * math.log2(1 + n) + (self.w[i + k] if n > 1 else 0.0)
        return float(sigmoid(z))


def telling_features(sample: DataFrame, least: int = LEAST, least_z: float = LEAST_Z) -> list[str]:
    """The telling features of a sample (text, positive), counted exactly: every
    feature of every document, folded in each task and again by feature. Only
    the telling ones come back; each is in ``least`` documents of the bounded
    sample at least."""
    sizes = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("positive").alias("p")).first()
    n_pos = int(sizes["p"] or 0)
    n_unl = int(sizes["n"]) - n_pos
    if not n_pos or not n_unl:
        return []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_blocks(batches):
            for seen in count_features(as_bytes(b.column("text")), b.column("positive").to_pylist(), COUNTED):
                cols = np.array(list(seen.values()), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(cols[:, 0]),
                                                  pa.array(cols[:, 1])], names=["f", "u", "p"])

    total = (sample.select("text", "positive").mapInArrow(run, "f string, u bigint, p bigint")
             .groupBy("f").agg(F.sum("u").alias("u"), F.sum("p").alias("p")).where(F.col("u") + F.col("p") >= least))
    share = (F.col("u") + F.col("p")) / F.lit(float(n_pos + n_unl))
    error = F.sqrt(share * (1 - share) * (1 / n_pos + 1 / n_unl) + 1e-12)
    # a little below the threshold, which ``telling`` decides
    far = F.abs(F.col("p") / n_pos - F.col("u") / n_unl) / error > least_z - 1e-6
    return telling(((r["f"], r["u"], r["p"]) for r in total.where(far).collect()), n_pos, n_unl, least, least_z)


def train(docs: DataFrame, labels: DataFrame, *, folds: int = 4, held: int = 2,
          positives: int = POSITIVES, unlabelled: int = UNLABELLED,
          sample_bytes: int = SAMPLE_BYTES) -> bytes:
    """Fit on bounded samples outside the held-out fold: confirmed toxic
    documents, and documents taken without regard to labels. The class prior
    is the share of toxic labels outside that fold, over all of them. Of an id's
    rows the one whose text hashes lowest is taken."""
    train_labels = labels.where((fold("doc_id", folds) != held) & F.col("toxic").isin(0, 1))
    prior = train_labels.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    pos = (train_labels.where("toxic = 1").select("doc_id").distinct()
           .orderBy(F.xxhash64("doc_id", F.lit(21)), "doc_id").limit(positives))
    unl = (docs.where((fold("doc_id", folds) != held) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
           .orderBy(F.xxhash64("doc_id", F.lit(22)), "doc_id").limit(unlabelled))
    ids = (pos.withColumn("positive", F.lit(1)).unionByName(unl.withColumn("positive", F.lit(0))))
    sample = (docs.select("doc_id", "text").where(F.coalesce(F.octet_length("text"), F.lit(0)) <= sample_bytes)
              .join(F.broadcast(ids), "doc_id")
              .groupBy("doc_id", "positive").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
              .select("text", "positive", F.lit(prior).cast("double").alias("prior")))
    scratch = Scratch(docs.sparkSession, "toxicity")
    sample = scratch.write(sample, "sample")
    names = telling_features(sample)
    model = train_in_task(sample, partial(fit, names=names))
    scratch.drop("sample")
    return model


def score_documents(docs: DataFrame, model: bytes, *, folds: int = 4, held: int = 2,
                    threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Whole texts are scored; null and empty texts get the model's base score.
    Rows repeat as often as the input; a null id falls in fold 0; other
    columns are ignored; an empty table gives no rows. No shuffle.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for b in text_blocks(batches):
            s = [scorer.score(t) for t in as_bytes(b.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(s, pa.float64())],
                names=["doc_id", "held_out", "score"])

    d = docs.select("doc_id", (fold("doc_id", folds) == held).alias("held_out"), "text")
    return (d.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, "
                              "held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
