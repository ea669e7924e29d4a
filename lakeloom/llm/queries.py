"""The registered queries of the training-data operators, one per operator,
each over its whole table with production parameters, and the SQL that DuckDB
can answer them with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import (alignment, chat, decontam, language, mixing, pii, quality, simhash, spelling,
                          substrings, tokens, topk, toxicity)
from lakeloom.llm.common import prepare, read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """Words every document gives to a mix of 150 % of all words, weights
    3, 1, 2 over the sources."""
    prepare(spark)
    return mixing.mix_sources(read_table(spark, sf, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op2_simhash(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    prepare(spark)
    return simhash.near_groups(read_table(spark, sf, "documents"))


def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity score of every document."""
    prepare(spark)
    docs, labels = read_table(spark, sf, "documents"), read_table(spark, sf, "labels")
    return toxicity.score_documents(docs, toxicity.train(docs, labels))


def op4_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes of every document that repeat 50 bytes of an earlier one."""
    prepare(spark)
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    return substrings.cut_repeats(docs, digests=True)


def op5_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    """Digests read back from the formatted conversations, with one more
    conversation whose texts imitate the template's control strings."""
    prepare(spark)
    tricky = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)],
                                 "conv_id bigint, turn bigint, role string, text string")
    turns = read_table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_conversations(turns.unionByName(more)))


def op6_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Unigram token count of every document."""
    prepare(spark)
    return tokens.token_counts(read_table(spark, sf, "documents"))


def op7_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Quality score of every document."""
    prepare(spark)
    docs, labels = read_table(spark, sf, "documents"), read_table(spark, sf, "labels")
    return quality.score_documents(docs, quality.train(docs, labels))


def op8_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Every test item found in every document."""
    prepare(spark)
    return decontam.contaminated(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))


def op9_top_k(spark: SparkSession, sf: str) -> DataFrame:
    """The 5 best inner products of every 50th vector with all others."""
    prepare(spark)
    return topk.top_k(read_table(spark, sf, "embeddings"), is_query=F.col("vec_id") % 50 == 0)


def op10_language(spark: SparkSession, sf: str) -> DataFrame:
    """Language of every document."""
    prepare(spark)
    docs = read_table(spark, sf, "documents").select("doc_id", "text", "lang")
    return language.identify(docs, language.train(docs))


def op11_spelling(spark: SparkSession, sf: str) -> DataFrame:
    """Form and root of every word of at least 7 letters that occurs twice."""
    prepare(spark)
    return spelling.spelling_variants(read_table(spark, sf, "documents"))


def op12_alignment(spark: SparkSession, sf: str) -> DataFrame:
    """Alignment of the byte-level and the piece vocabulary in every document."""
    prepare(spark)
    return alignment.align_tokenizers(read_table(spark, sf, "documents"))


def op13_pii(spark: SparkSession, sf: str) -> DataFrame:
    """Personal data of every document."""
    prepare(spark)
    docs = read_table(spark, sf, "documents")
    return pii.find(docs, pii.train(docs))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_mixing, op2_simhash, op3_toxicity, op4_suffix_dedup, op5_chat_format, op6_token_counts,
    op7_quality, op8_decontamination, op9_top_k, op10_language, op11_spelling, op12_alignment, op13_pii)}

ORACLE_SQL: dict[str, str] = {}

# The mix spelled out: targets by the sorted closed form of capped resharing,
# quotas from all quotients, the draw block by block.
ORACLE_SQL["op1_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source, (source IS NULL)::INT AS nul, coalesce(source, '') AS src,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
par AS (SELECT greatest(1, least(100000, ceil(count(*) / 4096.0)))::BIGINT AS s FROM sized),
src AS (SELECT source, nul, src, sum(size)::BIGINT AS ssize FROM sized GROUP BY ALL),
docs AS (
  SELECT sized.*, ('0x' || substr(md5(concat_ws(':', '8', doc_id::VARCHAR)), 1, 8))::BIGINT % (SELECT s FROM par)
                  % greatest(1, least((SELECT s FROM par), ssize // 4096)) AS shard,
         md5(concat_ws(':', '7', doc_id::VARCHAR)) AS ord
  FROM sized JOIN src USING (nul, src)),
wts AS (SELECT *, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY nul, src) - 1) % 3 + 1]::DOUBLE AS w,
               2.0::DOUBLE * ssize AS cap FROM src),
tot AS (SELECT 1.5::DOUBLE * sum(ssize) AS t FROM wts),
lev AS (
  SELECT *, ((SELECT t FROM tot) - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
            row_number() OVER o AS n
  FROM wts WINDOW o AS (ORDER BY cap / w, nul, src)),
cut AS (SELECT coalesce(arg_min(level, n) FILTER (WHERE level * w <= cap), 1e300) AS level FROM lev),
tgt AS (SELECT wts.*, least(cap, (SELECT level FROM cut) * w) AS target FROM wts),
bw AS (SELECT greatest(1, least(16, floor(coalesce(min(target) FILTER (WHERE target > 0), 0) / 16)))::BIGINT AS b FROM tgt),
pool AS (SELECT floor(t / b + 0.5)::BIGINT AS blocks FROM tot, bw),
quo AS (
  SELECT nul, src, target / (2 * k + 1) AS q FROM tgt, bw,
         LATERAL (SELECT unnest(range(0, (ceil(target / b) + 3)::BIGINT)) AS k) WHERE target > 0),
won AS (SELECT nul, src, count(*) AS seats FROM (
          SELECT * FROM quo ORDER BY q DESC, nul, src LIMIT (SELECT blocks FROM pool)) GROUP BY ALL),
sh AS (SELECT nul, src, shard, sum(size)::BIGINT AS words FROM docs GROUP BY ALL),
shq AS (
  SELECT nul, src, shard, row_number() OVER (PARTITION BY nul, src ORDER BY words::DOUBLE / (2 * k + 1) DESC, shard) AS r
  FROM sh, bw, LATERAL (SELECT unnest(range(0, (ceil(2.0 * words / b) + 4)::BIGINT)) AS k) WHERE words > 0),
quota AS (SELECT nul, src, shard, count(*) FILTER (WHERE r <= coalesce(seats, 0)) AS q
          FROM shq LEFT JOIN won USING (nul, src) GROUP BY ALL),
box AS (
  SELECT sh.*, b, greatest(1, ceil(words * 2.0 / b))::BIGINT AS n,
         least(coalesce(q, 0), greatest(1, ceil(words * 2.0 / b)))::BIGINT AS q,
         ('0x' || substr(md5(concat_ws(':', '9', CASE WHEN nul = 0 THEN src END, shard::VARCHAR)), 1, 8))::BIGINT AS h
  FROM (sh LEFT JOIN quota USING (nul, src, shard)), bw),
blk AS (SELECT nul, src, shard, j * b AS a, least((j + 1) * b, 2 * words) AS z
        FROM box, LATERAL (SELECT unnest(range(0, n)) AS j) WHERE (j * q + h % n) % n < q),
placed AS (
  SELECT docs.*, sum(size) OVER (PARTITION BY nul, src, shard ORDER BY ord, doc_id, size
                                 ROWS UNBOUNDED PRECEDING)::BIGINT AS z0
  FROM docs),
epoch AS (
  SELECT doc_id, nul, src, shard, ord, size, z0, z0 - size + e * words AS a, z0 + e * words AS z
  FROM placed JOIN sh USING (nul, src, shard), (VALUES (0), (1)) v(e)),
got AS (
  SELECT e.doc_id, e.nul, e.src, e.shard, e.z0, sum(least(e.z, b.z) - greatest(e.a, b.a))::BIGINT AS taken
  FROM epoch e JOIN blk b ON e.nul = b.nul AND e.src = b.src AND e.shard = b.shard AND b.a < e.z AND e.a < b.z
  GROUP BY ALL)
SELECT p.doc_id, p.size, t.ssize AS source_size, CASE WHEN (SELECT t FROM tot) > 0 THEN t.target ELSE 0 END AS target,
       CASE WHEN p.size = 0 THEN 0 ELSE coalesce(g.taken, 0) END::BIGINT AS taken
FROM placed p JOIN tgt t USING (nul, src)
LEFT JOIN got g ON p.doc_id IS NOT DISTINCT FROM g.doc_id AND p.nul = g.nul AND p.src = g.src AND p.shard = g.shard AND p.z0 = g.z0
"""

# texts as two hex digits a byte; every 50-byte string against the smallest
# document that holds it, spans joined where they overlap or touch
ORACLE_SQL["op4_suffix_dedup"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS own,
         hex(coalesce(text, '')) AS h, strlen(coalesce(text, '')) AS n
  FROM documents),
chunks AS (SELECT r, own, n, c, substr(h, 2 * c + 1, 610) AS h
           FROM d, LATERAL (SELECT unnest(range(0, n - 49, 256)) AS c) WHERE n >= 50),
s AS (SELECT r, own, c + j AS i, substr(h, 2 * j + 1, 100) AS w
      FROM chunks, LATERAL (SELECT unnest(range(0, least(256, n - 49 - c))) AS j)),
f AS (SELECT w, min(own) AS low FROM s GROUP BY w HAVING min(own) < max(own)),
m AS (SELECT r, i, coalesce(i > 50 + lag(i) OVER (PARTITION BY r ORDER BY i), true)::INT AS opens
      FROM s JOIN f USING (w) WHERE own > low),
g AS (SELECT r, i, sum(opens) OVER (PARTITION BY r ORDER BY i) AS k FROM m),
spans AS (SELECT r, min(i) AS a, max(i) + 50 AS z FROM g GROUP BY r, k),
gaps AS (SELECT *, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS after FROM spans),
cut AS (
  SELECT r, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans, max(z) AS last,
         string_agg(substr(h, 2 * after + 1, 2 * (a - after)), '' ORDER BY a) AS head
  FROM gaps JOIN d USING (r) GROUP BY r)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut USING (r)
"""

ORACLE_SQL["op5_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
s AS (
  SELECT *, lag(role) OVER w AS before, row_number() OVER w AS n, count(*) OVER (PARTITION BY conv_id) AS m,
         CASE role WHEN 'system' THEN 6 WHEN 'user' THEN 4 WHEN 'assistant' THEN 9
              ELSE 1 + length(regexp_replace(coalesce(role, ''), '(\\|###|</turn>|: )', '\\\1', 'g')) END AS label
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(4 + label + 2 + length(regexp_replace(text, '(\\|###|</turn>|: )', '\\\1', 'g')) + 9)::BIGINT AS formatted_chars,
       bool_and(coalesce(CASE WHEN n = 1 THEN role IN ('system', 'user')
                     WHEN before = 'system' THEN role = 'user'
                     WHEN before = 'user' THEN role = 'assistant'
                     WHEN before = 'assistant' THEN role = 'user' ELSE false END, false)
                AND (n < m OR coalesce(role = 'assistant', false))) AS valid
FROM s GROUP BY conv_id
"""

ORACLE_SQL["op9_top_k"] = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.c, d.c) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id AND len(q.c) = len(d.c)
  WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""

# crc32 by its table over the bytes of every run; words one edit apart share a
# word with one code point deleted, at the same place where both lose one
ORACLE_SQL["op11_spelling"] = r"""
WITH RECURSIVE tab AS (
  SELECT list(list_reduce(list_prepend(i, range(8)),
                          lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w,
         count(*) AS m
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
coded AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
              range(0, strlen(id || ':' || w)), lambda i: ('0x' || substr(hex(id || ':' || w), 2 * i + 1, 2))::BIGINT)),
            lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS h
  FROM runs, tab),
slips AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(w, (h % length(w))::BIGINT) || substr(w, (h % length(w))::BIGINT + 2) ELSE w END AS word, m
  FROM coded),
words AS (SELECT word, sum(m)::BIGINT AS n FROM slips WHERE length(word) >= 7 GROUP BY word HAVING sum(m) >= 2),
del AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS k
        FROM words, LATERAL (SELECT unnest(range(0, length(word))) AS i)),
near AS (
  SELECT x.word, y.word AS other, y.n AS other_n FROM del x JOIN del y ON x.k = y.k AND x.i = y.i AND x.word <> y.word
  UNION SELECT d.word, w.word, w.n FROM del d JOIN words w ON d.k = w.word
  UNION SELECT w.word, d.word, d.n FROM del d JOIN words w ON d.k = w.word),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM near GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN other_n >= 10 * w.n THEN other END AS form, CASE WHEN other_n >= 10 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT walk.word, f.form FROM walk JOIN forms f ON f.word = walk.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, w.root, f.n, f.n_near, f.form_n
FROM forms f JOIN walk w USING (word) JOIN forms e ON e.word = w.root WHERE e.form IS NULL
"""
