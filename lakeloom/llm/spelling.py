"""Spelling variants grouped by asymmetric q-chunks.

Two words one edit apart agree outside the place of the edit. Cut the shorter
word into two disjoint chunks: one edit leaves one of them whole, and in the
other word that chunk is a positional gram at the same place or, past an
inserted code point, one place further. So every word contributes its two
chunks, and of all its positional grams those that lie within shift one of a
chunk of a word as long as itself or one shorter; chunks meet grams in an
equi-join and candidates are verified by their edit distance.

A chunk that very many words share is cut further: the part that does not
agree yet is halved again, and one of the halves survives the edit just the
same. Groups shrink by that until they are small, without losing a pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm.common import Scratch

LETTERS = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH = 7
MIN_COUNT = 2
FORM_RATIO = 10  # a form is this many times as frequent as its variant
SLIP = 31  # one run in so many loses a code point
GROUP = 256  # members of a chunk group before it is cut further


def word_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, slip: int = SLIP) -> DataFrame:
    """(word, n): runs of Latin letters in whole texts, A-Z lower-cased.

    A run whose crc32 of ``<id>:<run>`` is divisible by ``slip`` loses one code
    point, at that number modulo its length. Runs under ``min_length`` code
    points can only become shorter and never leave the scan. Null texts have
    no words, a null id counts as the empty string. Counts are summed within
    each task before the shuffle, so a frequent word is one row per task.
    """
    run = F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"{LETTERS}{{{min_length},}}"), F.lit(0)))
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"), run.alias("_run"))
    low = runs.select("_id", F.translate("_run", UPPER, LOWER).alias("_w"))
    h = F.crc32(F.concat("_id", F.lit(":"), "_w").cast("binary"))
    marked = low.select("_w", h.alias("_h"), (h % F.char_length("_w")).cast("int").alias("_at"))
    word = F.when(F.col("_h") % slip == 0,
                  F.concat(F.substring("_w", F.lit(1), F.col("_at")),
                           F.substring("_w", F.col("_at") + 2, F.char_length("_w")))).otherwise(F.col("_w"))
    return (marked.select(word.alias("word")).where(F.char_length("word") >= min_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


def _outside(size: Column, word: Column, a: Column, z: Column, skip: Column | int) -> Column:
    """Key of what lies outside the window [a, z) of a word of ``size`` code
    points; the word itself has ``skip`` more of them inside the window."""
    before = F.substring(word, F.lit(1), a)
    after = F.substring(word, z + skip + 1, F.char_length(word))
    return F.xxhash64(size, a, z, before, after)


def _cut(members: DataFrame) -> DataFrame:
    """Both halves of every member's open window: the chunk in the other half
    joins what already agrees."""
    mid = ((F.col("a") + F.col("z")) / 2).cast("int")
    halves = members.select("word", "n", "size", "gram", F.explode(F.array(
        F.struct(mid.alias("a"), F.col("z").alias("z")),
        F.struct(F.col("a").alias("a"), mid.alias("z")))).alias("w"))
    halves = halves.select("word", "n", "size", "gram", "w.a", "w.z").where("a < z")
    shift = F.greatest(F.col("gram"), F.lit(0))
    return halves.withColumn("key", _outside(F.col("size"), F.col("word"), F.col("a"), F.col("z"), shift))


def _pairs(members: DataFrame) -> DataFrame:
    """Verified pairs of one set of groups, each pair once.

    The first place where two words differ lies in one window of every cut, so
    a pair counts only there."""
    s = members.where("gram = -1").select("key", "size", "a", "z", F.col("word").alias("s"), F.col("n").alias("s_n"))
    t = members.where("gram >= 0").select("key", F.col("gram"), F.col("word").alias("t"), F.col("n").alias("t_n"))
    left_a = F.expr("left(s, a) = left(t, a)")
    here = F.expr("z = size OR left(s, z) <> left(t, z)")
    near = F.levenshtein(F.col("s"), F.col("t"), 1) == 1
    return (s.join(t, "key").where(((F.col("gram") == 1) | (F.col("s") < F.col("t"))) & left_a & here & near)
            .select("s", "s_n", "t", "t_n"))


def near_pairs(words: DataFrame, scratch: Scratch, *, group: int = GROUP) -> DataFrame:
    """Pairs (s, s_n, t, t_n) of distinct words (word, n) one edit apart, once
    each.

    ``group`` bounds a chunk group: larger ones are halved further, as far as
    windows of one code point, where no more words can agree than there are
    letters (and two letters, for an inserted one).
    """
    size = F.char_length("word")
    roles = F.explode(F.array(*[F.struct(F.lit(g).alias("gram"), (size - max(g, 0)).alias("size")) for g in (-1, 0, 1)]))
    level = (words.select("word", "n", roles.alias("r"))
             .select("word", "n", "r.gram", "r.size", F.lit(0).alias("a"), F.col("r.size").alias("z")))
    found, depth = None, 0
    while True:
        cut = scratch.write(_cut(level), f"pairs/cut-{depth}")
        # the work of a group: every chunk meets every gram
        load = cut.groupBy("key").agg(F.count_if(F.col("gram") == -1).alias("s"), F.count_if(F.col("gram") >= 0).alias("t"))
        big = scratch.write(load.where((F.greatest("s", "t") > group) & (F.least("s", "t") > 0)).select("key"), f"pairs/big-{depth}")
        if big.isEmpty():
            pairs = _pairs(cut)
            return pairs if found is None else found.unionByName(pairs)
        open_ = F.col("z") - F.col("a") > 1
        joined = cut.join(big.withColumn("hot", F.lit(True)), "key", "left")
        cold = joined.where(F.col("hot").isNull() | ~open_).drop("hot")
        pairs = scratch.write(_pairs(cold), f"pairs/found-{depth}")
        found = pairs if found is None else found.unionByName(pairs)
        level = joined.where(F.col("hot") & open_).drop("hot", "key")
        depth += 1


def _roots(linked: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last, doubling the
    hops of every step. Counts grow tenfold with every hop, so there are few."""
    step = scratch.write(linked.select("word", F.col("form").alias("root")), "roots-0")
    k = 0
    while True:
        ahead = step.select(F.col("word").alias("root"), F.col("root").alias("far"))
        joined = step.join(ahead, "root", "left")
        k += 1
        after = scratch.write(joined.select("word", F.coalesce("far", "root").alias("root"),
                                            F.col("far").isNotNull().alias("moved")), f"roots-{k}")
        step = after.select("word", "root")
        if after.where("moved").isEmpty():
            return step


def group_variants(words: DataFrame, scratch: Scratch, *, ratio: int = FORM_RATIO, group: int = GROUP) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of (word, n).

    A word's form is its near word of largest n, ties to the smallest in code
    point order, if that n is at least ``ratio`` times the word's own; root is
    the last of the chain of forms, the word itself if it has none. Words must
    be distinct. An empty table gives no rows.
    """
    pairs = near_pairs(words, scratch, group=group)
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("s").alias("word"), F.col("t").alias("other"), F.col("t_n").alias("other_n")),
        F.struct(F.col("t").alias("word"), F.col("s").alias("other"), F.col("s_n").alias("other_n")))).alias("p")).select("p.*")
    # the smallest of (-n, word) is the most frequent, then the smallest word
    if ratio <= 1:
        raise ValueError("a form must be more frequent than its variants: ratio > 1")
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("neg"), F.col("other").alias("other"))).alias("best"))
    is_form = -F.col("best.neg") >= F.lit(ratio) * F.col("n")
    named = scratch.write(
        words.join(best, "word", "left").select(
            "word", F.when(is_form, F.col("best.other")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(is_form, -F.col("best.neg")).alias("form_n")), "named")
    scratch.drop("pairs")  # the named words are written
    roots = _roots(named.where("form IS NOT NULL"), scratch)
    return (named.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def spelling_variants(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                      min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, slip: int = SLIP,
                      ratio: int = FORM_RATIO, group: int = GROUP) -> DataFrame:
    """Spelling variants of the words of all texts: :func:`word_counts`, then
    :func:`group_variants`.

    Repeated rows count as often as they occur; other columns are ignored
    whatever their names; null and empty texts and empty tables give no words.
    All of it is DataFrame work: counts, equi-joins and aggregates.
    """
    scratch = Scratch(docs.sparkSession, "spelling")
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast(T.StringType()).alias("text"))
    words = scratch.write(word_counts(d, id_col="id", text_col="text", min_length=min_length,
                                      min_count=min_count, slip=slip), "words")
    return group_variants(words, scratch, ratio=ratio, group=group)
