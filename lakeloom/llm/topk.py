"""Exact top-k inner-product search with multi-resolution segment statistics.

A vector is cut into 1, then a few, then many segments. From the mean and the
deviation of each segment a lower bound on the squared distance of two vectors
follows, and with the norms an upper bound on their inner product
(``sum l * (mean_x mean_y + dev_x dev_y)``). Bounds are refined coarse to fine;
a candidate whose bound stays below the k-th best exact score found so far is
dropped, and exact scores are computed for what is left. No candidate is lost.

Queries are compared with all rows in blocks: the candidates are dealt into
``g`` slices and the queries into ``h`` slices, every pair of slices is one
group of bounded size, and the k best of each group meet in a last ranking.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

LEVELS = (1, 4, 16)
PAIRS = 1 << 17  # pairs gathered at a time


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """(vec_id, ints): ``floor(scale * x)`` per component. Vectors that are
    null or hold a null or non-finite component are left out; identical
    repeated rows count once."""
    ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    d = df.select(F.col(id_col).cast("bigint").alias("vec_id"),
                  F.transform(F.col(vec_col), lambda x: x.cast("double")).alias("v"))
    d = d.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", ok))
    ints = F.transform("v", lambda x: F.floor(x * F.lit(float(scale))))
    return d.select("vec_id", ints.alias("ints")).dropDuplicates(["vec_id", "ints"])


def top_k(df: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding",
          is_query: Column | None = None, k: int = 5, scale: float = 256.0,
          slice_rows: int = 8192, slice_queries: int = 2048) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest scores of each query.

    ``is_query`` is a condition on ``vec_id`` (default: divisible by 50). A
    query is not its own candidate; ties go to the smaller id; fewer than k
    candidates give fewer rows. Only vectors of equal length are compared.
    Scores are 64-bit integers: vectors whose squared length, scaled, reaches
    2**62 could overflow one, and floats of 2**53 have no exact floor, so a
    table that holds any is refused with an error before the search.
    Two different vectors under one id: both are candidates, and as a query
    the id gets the k best over both. Empty tables give no rows.
    """
    is_query = (F.col("vec_id") % 50 == 0) if is_query is None else is_query
    ints = integer_vectors(df, id_col, vec_col, scale).withColumn("dim", F.size("ints"))
    # no product of two vectors exceeds the longest one's square
    square = F.aggregate("ints", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n = ints.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(is_query, 1)).alias("q"),
                 F.max(square).alias("square")).first()
    if (n["square"] or 0.0) >= float(1 << 62):
        raise ValueError(f"vectors are too long for 64-bit scores: squared length {n['square']:.3g} at scale {scale}")
    g, h = max(1, math.ceil(n["n"] / slice_rows)), max(1, math.ceil(n["q"] / slice_queries))

    # dealt by the vector's own hash: rows are distinct, so slices are even
    # and a retried task deals them the same way
    deal = F.xxhash64("vec_id", "ints")
    cand = (ints.withColumn("g", F.pmod(deal, F.lit(g)).cast("int"))
            .withColumn("h", F.explode(F.sequence(F.lit(0), F.lit(h - 1)))))
    quer = (ints.where(is_query).withColumn("h", F.pmod(deal, F.lit(h)).cast("int"))
            .withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(g - 1)))))

    def search(q: pa.Table, c: pa.Table) -> pa.Table:
        qid, cid, score = best_pairs(*_matrix(q), *_matrix(c), k)
        return pa.table({"query_id": qid, "vec_id": cid, "score": score})

    schema = T.StructType([T.StructField(x, T.LongType()) for x in ("query_id", "vec_id", "score")])
    part = (quer.groupBy("g", "h", "dim").cogroup(cand.groupBy("g", "h", "dim"))
            .applyInArrow(search, schema))
    best = W.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (part.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _matrix(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    if t.num_rows == 0:
        return np.zeros(0, np.int64), np.zeros((0, 0), np.int64)
    ids = np.asarray(t.column("vec_id").combine_chunks(), dtype=np.int64)
    col = t.column("ints").combine_chunks()
    flat = np.asarray(col.flatten(), dtype=np.int64)
    return ids, flat.reshape(len(ids), -1)


def segment_features(x: np.ndarray, segments: int) -> np.ndarray:
    """Per segment sqrt(l) * mean and sqrt(l) * deviation, side by side; the
    dot product of two such rows bounds the inner product from above."""
    d = x.shape[1]
    cuts = np.unique(np.linspace(0, d, min(segments, d) + 1).astype(int))
    out = np.empty((len(x), 2 * (len(cuts) - 1)))
    for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        part = x[:, a:b].astype(np.float64)
        root = math.sqrt(b - a)
        out[:, 2 * s] = part.mean(1) * root
        out[:, 2 * s + 1] = part.std(1) * root
    return out


def best_pairs(qid, qv, cid, cv, k, tile=64):
    """The k best (query, candidate, score) of every query within one pair of
    slices, by bounds first and exact scores for the survivors."""
    none = np.zeros(0, np.int64)
    if len(qid) == 0 or len(cid) == 0:
        return none, none, none
    if cv.shape[1] == 0:
        # rows are distinct, so there is one empty vector per id
        near = np.sort(cid)[:k + 1]
        q, c = np.repeat(qid, len(near)), np.tile(near, len(qid))
        return _keep_best(q[q != c], c[q != c], np.zeros(int((q != c).sum()), np.int64), k)
    cf = [segment_features(cv, s) for s in LEVELS]
    qf = [segment_features(qv, s) for s in LEVELS]
    cn = np.sqrt((cv.astype(np.float64) ** 2).sum(1))
    qn = np.sqrt((qv.astype(np.float64) ** 2).sum(1))
    out = []
    for a in range(0, len(qid), tile):
        z = slice(a, a + tile)
        alive = qid[z][:, None] != cid[None, :]
        best = np.full(alive.shape[0], -np.inf)
        # rounding of the float bounds, far below one unit of score
        slack = 1e-6 + 1e-9 * qn[z][:, None] * cn[None, :]
        for q_feat, c_feat in zip(qf, cf):
            bound = np.full(alive.shape, -np.inf)
            if alive.mean() > 0.25:
                bound = np.where(alive, q_feat[z] @ c_feat.T + slack, -np.inf)
            else:
                qi, ci = np.nonzero(alive)
                for s in range(0, len(qi), PAIRS):
                    u, v = qi[s:s + PAIRS], ci[s:s + PAIRS]
                    bound[u, v] = (np.einsum("ij,ij->i", q_feat[a + u], c_feat[v])
                                   + slack[u, v])
            # exact scores of the most promising raise the k-th best
            m = min(k, alive.shape[1])
            top = np.argpartition(-bound, m - 1, axis=1)[:, :m]
            exact = np.einsum("ij,ikj->ik", qv[z], cv[top]).astype(np.float64)
            exact[~np.take_along_axis(alive, top, axis=1)] = -np.inf
            if m == k:
                best = np.maximum(best, exact.min(axis=1))
            alive &= bound >= best[:, None]
        qi, ci = np.nonzero(alive)
        for s in range(0, len(qi), PAIRS):
            u, v = qi[s:s + PAIRS], ci[s:s + PAIRS]
            out.append(_keep_best(qid[a + u], cid[v], np.einsum("ij,ij->i", qv[a + u], cv[v]), k))
    if not out:
        return none, none, none
    return _keep_best(*[np.concatenate(x) for x in zip(*out)], k)


def _keep_best(q, c, s, k):
    o = np.lexsort((c, -s, q))
    q, c, s = q[o], c[o], s[o]
    first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, np.int64)
    rank = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
    m = rank < k
    return q[m], c[m], s[m]
