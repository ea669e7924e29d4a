"""Operators with an exact result against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeloom.llm import chat, mixing, simhash, substrings, suffixes, tokens, topk
from lakeloom.llm.queries import op5_chat_format

SPACE = " \t\n\x0b\x0c\r"


def words(text):
    out, cur = [], ""
    for c in (text or "") + " ":
        if c in SPACE:
            if cur:
                out.append(cur)
            cur = ""
        else:
            cur += c
    return out


# ------------------------------------------------------------------ mixing

def brute_targets(sizes, weights, share=1.5):
    """Reshare the excess round by round."""
    total = share * sum(sizes.values())
    target, left, open_ = {}, total, set(sizes)
    while open_:
        w = sum(weights[s] for s in open_)
        over = {s for s in open_ if left * weights[s] / w > 2 * sizes[s]}
        if not over:
            target |= {s: left * weights[s] / w for s in open_}
            break
        for s in over:
            target[s] = 2 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_mix_targets_and_draw(documents):
    src = {(r.doc_id, r.text): r.source for r in documents.collect()}
    rows = mixing.mix_sources(documents, shard_docs=40).collect()
    assert len(rows) == documents.count()
    size = Counter()
    for (i, t), s in src.items():
        size[s] += len(words(t)) * (2 if i == 90_004 else 1)
    names = sorted((s for s in size if s is not None)) + ([None] if None in size else [])
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    want = brute_targets(dict(size), weight)
    taken = Counter()
    for r in rows:
        assert r.size == len(words(next(t for (i, t), s in src.items() if i == r.doc_id and s == r.source
                                        and len(words(t)) == r.size)))
        assert 0 <= r.taken <= 2 * r.size
        assert r.source_size == size[r.source]
        assert r.target == pytest.approx(want[r.source])
        taken[r.source] += r.taken
    for s in size:
        # half a block per shard (six here) and one block between sources
        assert abs(taken[s] - want[s]) <= 6 * 8 + 16, s
    again = mixing.mix_sources(documents, shard_docs=40).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_many_small_sources_come_near_their_targets(llm):
    rows = [(i, "a b c d e", f"s{i:04d}") for i in range(1000)]
    docs = llm.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    got = mixing.mix_sources(docs).collect()
    assert sum(r.target for r in got) == pytest.approx(7500)
    assert abs(sum(r.taken for r in got) - 7500) <= 75
    assert all(abs(r.taken - r.target) <= 1 and r.taken <= 10 for r in got)
    # and beside a large one
    more = docs.unionByName(llm.createDataFrame([(2000 + i, "w " * 300, "big") for i in range(300)], docs.schema))
    rows = mixing.mix_sources(more).collect()
    assert all(abs(r.taken - r.target) <= 1 for r in rows if r.source != "big")
    big = [r for r in rows if r.source == "big"]
    assert abs(sum(r.taken for r in big) - big[0].target) <= 16


def test_mix_of_a_short_source_in_a_large_table(llm):
    rows = [(i, "w " * 60, "big") for i in range(4000)] + [(4000 + i, "a b c d e", "small") for i in range(200)]
    docs = llm.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    taken, target = Counter(), {}
    for r in mixing.mix_sources(docs, shard_docs=4).collect():
        source = "big" if r.doc_id < 4000 else "small"
        taken[source] += r.taken
        target[source] = r.target
    assert target["small"] == 2000
    for s in target:
        assert abs(taken[s] - target[s]) <= max(16, target[s] / 100), s


def test_sainte_lague_is_highest_quotients(llm):
    rnd = random.Random(5)
    parties = [("g%d" % g, k, float(rnd.choice([0, 1, 5, 5, 40, rnd.randint(1, 900)])), pool)
               for g, pool in enumerate([0, 1, 3, 17, 200]) for k in range(9)]
    df = llm.createDataFrame(parties, "g string, k int, votes double, pool bigint")
    got = {(r.g, r.k): r.seats for r in mixing.sainte_lague(df, ["g"], ["k"]).collect()}
    for g, pool in enumerate([0, 1, 3, 17, 200]):
        mine = [(v, k) for n, k, v, _ in parties if n == f"g{g}"]
        quot = sorted(((-v / (2 * s + 1), k) for v, k in mine for s in range(pool + 1) if v > 0))[:pool]
        seats = Counter(k for _, k in quot)
        assert {k: got[f"g{g}", k] for _, k in mine} == {k: seats[k] for _, k in mine}


def test_mix_of_nothing(empty):
    assert mixing.mix_sources(empty).collect() == []


def test_mix_ignores_clashing_columns(documents):
    d = documents.withColumn("size", F.lit("x")).withColumn("shard", F.lit(1)).withColumn("_src", F.lit(2))
    assert mixing.mix_sources(d).count() == documents.count()


# ----------------------------------------------------------------- simhash

def brute_fingerprint(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = words(w)
    if not w:
        return 0
    s = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_near_groups(documents):
    rows = documents.select("doc_id", "text").collect()
    fps = {t: brute_fingerprint(t) for t in {r.text for r in rows}}
    fp = np.array([fps[r.text] for r in rows], np.uint64)
    comp = components(len(rows), np.argwhere(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 4).tolist())
    low = {}
    for c, r in zip(comp, rows):
        if r.doc_id is not None:
            low[c] = min(low.get(c, r.doc_id), r.doc_id)
    want = Counter((r.doc_id, f"{f:016x}", low.get(c)) for r, f, c in zip(rows, fp.tolist(), comp))
    got = Counter((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_groups(documents).collect())
    assert got == want
    assert_keeps_one(documents)


def assert_keeps_one(docs):
    """One row per group: smallest id (none last), smallest signed print."""
    rows = docs.collect()
    fps = {t: brute_fingerprint(t) for t in {r.text for r in rows}}
    fp = np.array([fps[r.text] for r in rows], np.uint64)
    comp = components(len(rows), np.argwhere(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 4).tolist())
    best = {}
    for r, f, c in zip(rows, fp.view(np.int64).tolist(), comp):
        rank = (r.doc_id is None, r.doc_id or 0, f)
        best[c] = min(best.get(c, rank), rank)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    got = Counter((r.doc_id is None, r.doc_id or 0, int(np.uint64(fps[r.text]).view(np.int64))) for r in kept.collect())
    assert got == Counter(best.values())
    assert kept.subtract(docs).count() == 0


def test_rows_of_one_id_are_judged_by_their_text(llm):
    def frame(rows):
        return llm.createDataFrame(rows, "doc_id bigint, text string, _id string, _fp int, _gone int")
    words_a, words_b, words_c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    for rows in ([(1, words_a), (1, words_b), (2, words_c)], [(1, words_a), (5, words_a), (5, words_b)],
                 [(None, words_a)] * 3, [(None, words_a), (7, words_a), (None, words_b)], [(3, words_a)] * 4 + [(3, words_b)] * 2,
                 [(4, None), (4, ""), (None, None), (9, words_c)]):
        assert_keeps_one(frame([(i, t, "x", 1, 2) for i, t in rows]))
    assert simhash.keep_one(frame([(1, words_a, "x", 1, 2), (1, words_b, "y", 1, 2), (2, words_c, "z", 1, 2)])).count() == 3


def test_rows_without_id_bridge(llm):
    """a and c differ in eight bits, b lies between them and has no id."""
    text = {i: t for i, t in enumerate([" ".join(f"w{(i * 7 + k) % 90}" for i in range(k % 13 + 30)) for k in range(60)])}
    docs = llm.createDataFrame([(None if k % 3 else k, t) for k, t in text.items()], "doc_id bigint, text string")
    got = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.near_groups(docs, max_bits=24).collect()}
    fp = np.array([brute_fingerprint(t) for t in text.values()], np.uint64)
    comp = components(60, np.argwhere(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 24).tolist())
    low = {}
    for k, c in enumerate(comp):
        if k % 3 == 0:
            low[c] = min(low.get(c, k), k)
    assert got == {(None if k % 3 else k, f"{f:016x}"): low.get(c) for k, (f, c) in enumerate(zip(fp.tolist(), comp))}


def test_anchor_search_finds_every_link():
    rng = np.random.default_rng(0)
    fp = rng.integers(0, 2**64, 800, dtype=np.uint64)
    near = np.repeat(fp[:200], 4)
    for i in range(len(near)):
        for b in rng.choice(64, rng.integers(0, 7), replace=False):
            near[i] ^= np.uint64(1) << np.uint64(b)
    fp = np.unique(np.concatenate([fp, near]))
    row, key, home = simhash.anchors_of(fp)
    assert home.sum() == 3 * len(fp)
    a, b = np.nonzero(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 4)
    want = simhash.Forest(len(fp))
    want.add(a, b)
    for big in (1 << 22, 1):
        got = simhash.Forest(len(fp))
        simhash.link_within(key, fp[row], home, got, row, 4, big)
        assert (got.root == want.root).all()


def family(n, bits, seed=0):
    """Distinct fingerprints that differ in the given bits alone."""
    rng = np.random.default_rng(seed)
    v = rng.choice(1 << len(bits), n, replace=False).astype(np.uint64)
    out = np.full(n, 0x0123456789ABCDEF, np.uint64)
    for j, b in enumerate(bits):
        out ^= ((v >> np.uint64(j)) & np.uint64(1)) << np.uint64(b)
    return out


@pytest.mark.parametrize("bits", [range(42, 63), range(0, 64, 4), range(20, 44), [63], []])
def test_midpoints_link_what_pairs_do(bits, monkeypatch):
    fp = family(min(1500, 1 << len(bits)), list(bits))
    a, b = np.nonzero(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 4)
    want = simhash.Forest(len(fp))
    want.add(a, b)
    for points in (1 << 22, 5000):
        got = simhash.Forest(len(fp))
        simhash.link_by_midpoints(fp, got, np.arange(len(fp)), 4, points)
        assert (got.root == want.root).all()
    for busy, dear in ((1, 0.01), (1, 1e9)):  # by midpoints, by bands
        monkeypatch.setattr(simhash, "BUSY", busy)
        monkeypatch.setattr(simhash, "SORTED", dear)
        row, key, home = simhash.anchors_of(fp)
        got = simhash.Forest(len(fp))
        simhash.link_within(key, fp[row], home, got, row, 4, 100)
        assert (got.root == want.root).all()


def test_a_large_family_of_near_copies_is_quick():
    import time

    fp = family(20_000, list(range(42, 63)))
    row, key, home = simhash.anchors_of(fp)
    start = time.perf_counter()
    got = simhash.Forest(len(fp))
    simhash.link_within(key, fp[row], home, got, row, 4)
    assert time.perf_counter() - start < 20  # 63 s by pairs
    assert (got.root == 0).all()


def test_near_groups_of_nothing(empty):
    assert simhash.near_groups(empty).collect() == []
    assert simhash.keep_one(empty).collect() == []


# ------------------------------------------------------------ suffix dedup

def brute_repeats(docs, depth=50):
    last = (1 << 63) - 1
    first = {}
    for i, t in sorted((last if i is None else i, t) for i, t in docs):
        for p in range(len(t) - depth + 1):
            first.setdefault(t[p:p + depth], i)
    out = []
    for i, t in docs:
        gone = bytearray(len(t))
        for p in range(len(t) - depth + 1):
            if first[t[p:p + depth]] < (last if i is None else i):
                gone[p:p + depth] = b"\1" * depth
        runs = sum(1 for k in range(len(t)) if gone[k] and not (k and gone[k - 1]))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_cut_repeats(documents):
    docs = documents.where("coalesce(doc_id, 0) != 90005").select("doc_id", "text")
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    got = substrings.cut_repeats(docs, digests=True).collect()
    assert Counter(map(tuple, got)) == Counter(brute_repeats(rows))


def test_cut_repeats_keeps_columns(documents):
    out = substrings.cut_repeats(documents)
    assert out.columns == documents.columns and out.count() == documents.count()
    stats = {r.doc_id: r for r in substrings.cut_repeats(documents, digests=True).collect() if r.doc_id is not None}
    for r in out.where("doc_id < 90000").collect():
        if stats[r.doc_id].n_removed == 0:
            assert hashlib.sha256(r.text.encode()).hexdigest() == stats[r.doc_id].kept_sha256


def test_cut_repeats_of_nothing(empty):
    assert substrings.cut_repeats(empty, digests=True).collect() == []


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 10**6))
def test_pieces_settle_like_brute_force(seed):
    import zlib
    rnd = random.Random(seed)
    letters = rnd.choice([b"a", b"ab", b"abcdefgh"])
    base = [bytes(rnd.choice(letters) for _ in range(rnd.randint(40, 150))) for _ in range(3)]
    docs = []
    for _ in range(14):
        parts = [rnd.choice(base)[rnd.randint(0, 30):] if rnd.random() < .6
                 else bytes(rnd.choice(letters) for _ in range(rnd.randint(0, 80))) for _ in range(3)]
        docs.append((rnd.randint(0, 9), b"".join(parts)))
    docs += docs[:2]
    blobs, spans = defaultdict(list), []
    blocks, buckets = rnd.randint(1, 3), rnd.randint(1, 4)
    for k in range(blocks):
        rows = [(i, zlib.crc32(t), t) for j, (i, t) in enumerate(docs) if j % blocks == k and len(t) >= 50]
        for b, blob, own in substrings._map_block(rows, 50, buckets) if rows else ():
            if blob is not None:
                blobs[b].append(blob)
            if own is not None:
                spans.append(substrings._unpack(own, substrings._SPAN_TYPES))
    for x in blobs.values():
        found = substrings._settle_bucket(x, 50)
        if found is not None:
            spans.append(found)
    per = defaultdict(list)
    for cols in spans:
        for i, c, a, z in zip(*[x.tolist() for x in cols]):
            per[i, c].append(np.array([a, z], np.int64).tobytes())
    got = []
    for i, t in docs:
        kept, n, runs = substrings._cut(t, b"".join(per.get((i, zlib.crc32(t)), [])))
        got.append((i, len(t), n, runs, hashlib.sha256(kept).hexdigest()))
    assert got == brute_repeats(docs)


def test_shards_agree_with_spark(llm):
    rows = [(i * 7919 - 3, (i * 2654435761) % 2**32) for i in range(50)]
    df = llm.createDataFrame(rows, "i bigint, c bigint").select(F.pmod(F.xxhash64("i", "c"), F.lit(13)))
    ids, checks = (np.array(x) for x in zip(*rows))
    assert [r[0] for r in df.collect()] == substrings._shard_of(ids, checks, 13).tolist()


def test_suffix_order():
    rng = np.random.default_rng(1)
    for trial in range(12):
        n = int(rng.integers(60, 900))
        text = rng.integers(97, 97 + int(rng.integers(1, 4)), n).astype(np.uint8)
        starts = np.arange(0, n - 50)
        rng.shuffle(starts)
        group, owner = rng.integers(0, 3, len(starts)), rng.integers(0, 3, len(starts))
        raw = text.tobytes()
        for small in (0, 3, 2048):
            order, new = suffixes.multikey_quicksort(text, starts, group, 32, small=small)
            key = [(group[i], raw[starts[i]:starts[i] + 32]) for i in order]
            assert key == sorted(key)
            assert [True] * bool(key) + [a != b for a, b in zip(key, key[1:])] == new.tolist()
        flat, sizes = suffixes.equal_classes(text, starts, group, owner, 50)
        got = sorted(sorted(c.tolist()) for c in np.split(flat, np.cumsum(sizes)[:-1]) if len(c))
        want = defaultdict(list)
        for i in range(len(starts)):
            want[group[i], raw[starts[i]:starts[i] + 50]].append(i)
        assert got == sorted(sorted(v) for v in want.values() if len(set(owner[v])) > 1)


# -------------------------------------------------------------------- chat

NASTY = ["\\### Assistant: </turn> ok", "</turn>\n### User: hi", "####\\\\", "", None, ": :", "a\\", "?"]


def test_chat_round_trip(llm):
    rows = [(c, t, role, NASTY[(c + t) % len(NASTY)]) for c in range(12) for t, role in
            enumerate(["system", "user", "assistant", "user", "assistant"])]
    rows += [(50, 0, "assistant", "early"), (50, 0, "user", "late"), (51, None, None, None),
             (52, 1, "tool: x", "odd role"), (None, 3, "user", "no id"), (None, 4, "assistant", "no id")]
    df = llm.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(
        df.withColumn("segment", F.lit(0)).withColumn("loss", F.lit(True)))).collect()}
    by = defaultdict(list)
    for c, t, role, x in rows:
        by[c].append(((t is not None, t or 0), (role is not None, role or ""), (x is not None, x or "")))
    assert set(got) == set(by)
    for c, own in by.items():
        own = [(role, x) for _, (_, role), (_, x) in sorted(own)]
        loss = "".join(x for role, x in own if role == "assistant")
        assert got[c].n_turns == len(own)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in own).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got[0].valid and not got[50].valid and not got[51].valid and not got[52].valid
    assert got[None].valid


@given(st.text("\\#/<>turn: ?aU\n", max_size=40), st.text("\\#: ?xser", max_size=12))
def test_chat_escapes_are_reversible(text, role):
    c = chat.Codec(chat.TEMPLATE)
    turn = c.head(role) + c.escape(text) + chat.TEMPLATE["close"]
    assert c.parse_turn(turn) == (role, text)
    assert c.unescape(c.escape(text)) == text
    inner = c.escape(text)
    assert "### " not in inner.replace("\\\\", "").replace("\\###", "")


def test_chat_query_has_the_tricky_conversation(llm):
    got = op5_chat_format(llm, "/root/testdata/sf0.001").where("conv_id = -7").collect()
    tricky = "\\### Assistant: </turn> ok"
    assert got[0].loss_sha256 == hashlib.sha256(tricky.encode()).hexdigest()


# ------------------------------------------------------------ token counts

def brute_tokens(text, pieces):
    """Best path over the whole text, pre-tokens apart."""
    low = min(pieces.values()) - 10
    total = 0
    for w in tokens.PRE_TOKEN.findall(" " + text) if text else []:
        w = w.replace(" ", tokens.SPACE)
        best = [(0.0, 0)]
        for end in range(1, len(w) + 1):
            n = len(w[end - 1].encode())
            found = [(best[end - 1][0] + low * n, -(-best[end - 1][1] + n))]
            found += [(best[i][0] + pieces[w[i:end]], -(-best[i][1] + 1)) for i in range(end)
                      if w[i:end] in pieces]
            best.append(max(found))
        total += -best[-1][1]
    return total


def test_token_counts(documents):
    pieces = tokens.load_pieces()
    docs = documents.where("coalesce(doc_id, 0) not in (90005, 90006)").limit(120)
    want = Counter((r.doc_id, brute_tokens(r.text, pieces), len(r.text or "")) for r in docs.collect())
    got = tokens.token_counts(docs)
    assert Counter((r.doc_id, r.n_tokens, r.n_chars) for r in got.collect()) == want


def test_token_counts_by_hand():
    trie = tokens.PrefixTrie({"▁": -5.0, "a": -4.0, "b": -4.0, "ab": -3.0, "▁ab": -2.5, "abab": -9.0})
    assert trie.texts(["abab", "ab ab", "", "a\nb", "é"]) == [(2, 1), (2, 2), (0, 0), (4, 3), (3, 1)]


# ------------------------------------------------------------------- top k

def brute_top(rows, k=5):
    out = []
    for q, x in rows:
        if q % 50:
            continue
        s = sorted((-sum(a * b for a, b in zip(x, y)), c) for c, y in rows if c != q and len(x) == len(y))
        out += [(q, n + 1, c, -v) for n, (v, c) in enumerate(s[:k])]
    return out


@pytest.mark.parametrize("slices", [(8192, 2048), (40, 3)])
def test_top_k(llm, slices):
    rnd = random.Random(2)
    rows = [(i, [rnd.choice([0.0, 0.5, -0.25, rnd.gauss(0, 1)]) for _ in range(24)]) for i in range(300)]
    rows += [(301, rows[7][1]), (350, rows[0][1]), (302, []), (400, []), (303, [1.0, 2.0]), (450, [3.0, 1.0])]
    clean = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows]
    bad = [(500, None), (550, [1.0, None]), (600, [float("nan")] * 24), (650, [float("inf")] * 24),
           (None, rows[0][1])]
    df = llm.createDataFrame(rows + bad + rows[:5], "vec_id bigint, embedding array<double>")
    got = topk.top_k(df.withColumn("score", F.lit(1)), slice_rows=slices[0], slice_queries=slices[1]).collect()
    assert sorted(map(tuple, got)) == sorted(brute_top(clean))


def test_top_k_of_nothing(llm):
    df = llm.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert topk.top_k(df).collect() == []


def test_vectors_beyond_the_range_of_scores_are_refused(llm):
    def frame(x):
        return llm.createDataFrame([(0, [x, 1.0]), (1, [x, -x]), (2, [0.5, 0.25])], "vec_id bigint, embedding array<double>")
    for x in (1e17, 1e19, 1e300, 2.0 ** 31 / 256):
        with pytest.raises(ValueError, match="too long"):
            topk.top_k(frame(x))
    x = 5e6  # scaled 1.28e9: the longest squared length is 3.3e18, below 2**62
    want = {1: int(256 * x) ** 2 - 256 * int(256 * x), 2: 128 * int(256 * x) + 64 * 256}
    assert {r.vec_id: r.score for r in topk.top_k(frame(x)).collect()} == want
