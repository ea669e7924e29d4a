"""Spelling variants, tokenizer alignment and personal data."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeloom.llm import alignment, pii, spelling
from lakeloom.llm.common import Scratch
from lakeloom.llm.crf import Chains

# ---------------------------------------------------------------- spelling


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(counts, ratio=10):
    names = sorted(counts)
    near = defaultdict(list)
    by_size = defaultdict(list)
    for w in names:
        by_size[len(w)].append(w)
    for w in names:
        for o in itertools.chain(*(by_size[len(w) + d] for d in (-1, 0, 1))):
            if o != w and one_edit(w, o):
                near[w].append(o)
    form = {}
    for w in names:
        if near[w]:
            best = min(near[w], key=lambda o: (-counts[o], o))
            if counts[best] >= ratio * counts[w]:
                form[w] = best
    out = set()
    for w in names:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, counts[w], len(near[w]), counts.get(form.get(w))))
    return out


def brute_counts(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def test_spelling_over_awkward_documents(llm, documents):
    some = documents.where("doc_id > 90000 OR doc_id % 4 = 0 OR doc_id IS NULL")
    want = brute_variants(brute_counts([(r.doc_id, r.text) for r in some.collect()]))
    got = spelling.spelling_variants(some.withColumn("word", F.lit(1)).withColumn("n", F.lit("x")).withColumn("a", F.lit(0)))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want and len(want) > 100


@pytest.mark.parametrize("group", [1, 3, 256])
def test_large_chunk_groups_lose_no_pair(llm, group):
    rng = random.Random(5)
    words = {"interstate" + "".join(rng.choice("abc") for _ in range(rng.randrange(1, 4))) for _ in range(80)}
    words |= {"".join(rng.choice("ab") for _ in range(rng.randrange(7, 10))) for _ in range(150)}
    words |= {"éééééééé", "ééééééé", "éééeéééé", "xinterstatea", "interstateaa"}
    counts = {w: rng.choice([2, 3, 25, 400, 5000]) for w in sorted(words)}
    df = llm.createDataFrame(list(counts.items()), "word string, n bigint").repartition(3)
    pairs = [tuple(sorted((r.s, r.t))) for r in spelling.near_pairs(df, Scratch(llm, "t"), group=group).collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a, b in itertools.combinations(sorted(words), 2) if one_edit(a, b)}
    got = spelling.group_variants(df, Scratch(llm, "t"), group=group)
    assert {tuple(r) for r in got.collect()} == brute_variants(counts)


def test_spelling_of_nothing(llm, empty):
    assert spelling.spelling_variants(empty).collect() == []
    nulls = llm.createDataFrame([(None, None), (1, ""), (2, "short words only"), (3, "lonelyword")],
                                "doc_id bigint, text string")
    assert spelling.spelling_variants(nulls).collect() == []
    with pytest.raises(ValueError):
        spelling.group_variants(nulls.selectExpr("text AS word", "doc_id AS n"), Scratch(llm, "t"), ratio=1)


# --------------------------------------------------------------- alignment

ENDS = st.lists(st.integers(1, 4), min_size=0, max_size=60)


@settings(max_examples=200, deadline=None)
@given(ENDS, ENDS, st.integers(1, 9))
def test_merge_path_pieces(x, y, piece):
    a, b = np.cumsum(np.array(x, np.int64)), np.cumsum(np.array(y, np.int64))
    top = max(int(a[-1]) if len(a) else 0, int(b[-1]) if len(b) else 0)
    a = np.unique(np.r_[a, top])[np.unique(np.r_[a, top]) > 0].astype(np.int64)
    b = np.unique(np.r_[b, top])[np.unique(np.r_[b, top]) > 0].astype(np.int64)
    m = alignment.merge_ends(a, b, piece)
    pa_, pb = np.r_[0, a], np.r_[0, b]
    over = [(i, j) for i in range(len(a)) for j in range(len(b)) if max(pa_[i], pb[j]) < min(pa_[i + 1], pb[j + 1])]
    assert list(zip(m.over_a.tolist(), m.over_b.tolist())) == over
    assert [(i, j) for i in range(len(a)) for j in range(len(b)) if a[i] == b[j]] == list(
        zip(m.end_a.tolist(), m.end_b.tolist()))


def test_diagonals_give_equal_work():
    a, b = np.arange(1, 1001), np.array([1000])
    cross = alignment.merge_path(a, b, np.arange(0, 1001, 100))
    assert cross.tolist() == list(range(0, 1001, 100))


@pytest.fixture(scope="module")
def brute_alignment():
    import sentencepiece
    import tokenizers
    t = tokenizers.Tokenizer.from_file(alignment.BYTE_BPE)
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_BPE)
    alphabet = {b: c for c, b in zip(map(chr, [*range(33, 127), *range(161, 173), *range(174, 256)]),
                                     [*range(33, 127), *range(161, 173), *range(174, 256)])}
    names = {v: k for k, v in t.get_vocab().items()}
    rest = iter(range(256, 400))
    for b in range(256):
        if b not in alphabet:
            alphabet[b] = chr(next(rest))
    back = {c: b for b, c in alphabet.items()}

    def one(text):
        if not text:
            return [], [], [], []
        raw = (" " + text).encode()
        a = t.encode(" " + text, add_special_tokens=False).ids
        b = sp.encode(text)
        ab = [bytes(back[c] for c in names[i]) for i in a]
        bb = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) and sp.is_byte(i)
              else p.replace("▁", " ").encode() for i, p in ((i, sp.id_to_piece(i)) for i in b)]
        if b"".join(ab) != raw or b"".join(bb) != raw:
            return [], [], [], []
        ea, eb = list(itertools.accumulate(map(len, ab))), list(itertools.accumulate(map(len, bb)))
        at_b = {e: j for j, e in enumerate(eb)}
        ends = [(i, at_b[e]) for i, e in enumerate(ea) if e in at_b]
        groups, i0, j0 = [], 0, 0
        for i, j in ends:
            groups.append((a[i0:i + 1], b[j0:j + 1]))
            i0, j0 = i + 1, j + 1
        return a, b, [(a[i], b[j]) for i, j in ends], groups
    return one


AWKWARD = ["<|endoftext|> and </s> <unk> <0x41>", "a▁b", "two  spaces   here ", "\x00\x01 �", "日本語 текст 😀é",
           " ", "\n\n", "x", "it's we'll", "1234567890 12,5", "ab" * 5000]


@pytest.mark.parametrize("limit", [alignment.BROADCAST_PAIRS, 10])
def test_alignment_against_brute_force(llm, documents, brute_alignment, limit):
    more = llm.createDataFrame([(95_000 + k, t, None, None, None) for k, t in enumerate(AWKWARD)], documents.schema)
    docs = documents.where("doc_id > 90000 OR doc_id % 5 = 0 OR doc_id IS NULL").unionByName(more)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    done = [(i, *brute_alignment(t)) for i, t in rows]
    n = Counter(pair for d in done for pair in d[3])
    top = defaultdict(int)
    for (_, b), c in n.items():
        top[b] = max(top[b], c)
    want = sorted(str((i, len(a), len(b), len(g), len(ln), sum(n[p] == top[p[1]] for p in ln), sum(n[p] for p in ln),
                       hashlib.sha256(";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
                                      .encode()).hexdigest() if g else "", len(a) + len(b) - len(g)))
                  for i, a, b, ln, g in done)
    clash = docs.withColumn("pairs", F.lit(1)).withColumn("row", F.lit("r")).withColumn("n", F.lit(0))
    got = alignment.align_tokenizers(clash, broadcast_pairs=limit)
    assert got.columns[:8] == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(str(tuple(r)) for r in got.collect()) == want
    assert sum(1 for d in done if d[1]) > 40


def test_groups_give_the_text_back(llm, documents):
    docs = documents.where("doc_id < 20")
    text = {r.doc_id: r.text for r in docs.collect()}
    model = alignment.PieceTokenizer(open(alignment.PIECE_BPE, "rb").read())
    parts = defaultdict(list)
    for r in alignment.groups(docs).collect():
        parts[r.doc_id].append((r.group, r.start, r.end, b"".join(model.bytes[i] for i in r.b_ids)))
    for i, t in text.items():
        got = sorted(parts[i])
        assert [g[0] for g in got] == list(range(len(got)))
        assert b"".join(g[3] for g in got) == (" " + t).encode()
        assert all(z - s == len(x) for _, s, z, x in got) and got[0][1] == 0


def test_alignment_of_nothing(empty):
    assert alignment.align_tokenizers(empty).collect() == []
    assert alignment.groups(empty).collect() == []


def test_ids_must_follow_merges():
    with pytest.raises(ValueError):
        alignment.ByteTokenizer(b'{"model": {"vocab": {"a": 0, "b": 1, "ab": 3, "ba": 2}, "merges": ["a b", "b a"]}}')


# ------------------------------------------------------------ personal data

def plain_base(text):
    """The contract's patterns, as written."""
    out = [(m.start(), 0, m.end()) for m in re.finditer(
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        total = sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d)))
        if 14 <= len(d) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 10 <= len(re.findall("[0-9]", m.group())) <= 15]
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a.@1029+- (\n٣é", max_size=60))
def test_base_spans_match_the_plain_patterns(text):
    assert pii.base_spans(text) == plain_base(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["a.b@c.d", "x@y", ".@d.e", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "4420439893348601",
                                 "4420-4398 9334 8601", "+1 (988) 555-2485", "12", ".", "+", "@", "٣٤", "0000255.1.1.1"]),
                max_size=8), st.sampled_from(["", " ", ".", "\n"]))
def test_base_spans_of_joined_forms(parts, glue):
    text = glue.join(parts)
    assert pii.base_spans(text) == plain_base(text)


def test_base_spans_of_long_runs_are_linear():
    for text in ("x" * 400_000, "1" * 400_000, "a." * 200_000, "@" * 200_000, "1." * 200_000, "+" * 200_000,
                 "+1" + "(" * 200_000, "1 " * 200_000, "a@" * 100_000):
        pii.base_spans(text)
        pii.candidates(text)


def test_message_passing_is_exact_without_loops():
    """Two chains and skip edges that close no loop, against enumeration."""
    rng = np.random.Generator(np.random.PCG64(3))
    k = len(pii.LABELS)
    emit = rng.normal(size=(5, k))
    trans, start = rng.normal(size=(k, k)), rng.normal(size=k)
    skip = np.array([[1.5, 0.4], [0.7, -0.2]])
    lens, edges = np.array([2, 1, 2]), np.array([[1, 2, 0], [2, 4, 1]])
    got = pii.beliefs(emit, Chains(lens), edges, trans, start, skip, rounds=8)
    psi = [pii._compatible(w) for w in skip]
    want = np.zeros((5, k))
    for y in itertools.product(range(k), repeat=5):
        s = sum(emit[i, y[i]] for i in range(5))
        s += start[y[0]] + trans[y[0], y[1]] + start[y[2]] + start[y[3]] + trans[y[3], y[4]]
        s += psi[0][y[1], y[2]] + psi[1][y[2], y[4]]
        for i in range(5):
            want[i, y[i]] += np.exp(s)
    assert np.allclose(got, want / want.sum(1, keepdims=True), atol=1e-6)


def test_evidence_holds_base_labels():
    t = pii.Tokens(["mail bo.42@mail8.example.com or +1 (988) 555-2485, 4420439893348601."])
    assert [pii.LABELS[i] for i in t.fixed] == ["email", "phone", "phone+", "phone+", "card"]
    m = {"w": np.zeros((pii.SLOTS, 7)), "trans": np.zeros((7, 7)), "start": np.zeros(7), "skip": np.zeros((2, 2))}
    p = pii.beliefs(pii._evidence(m["w"][t.x].sum(1), t.fixed), Chains(t.lens), t.edges, m["trans"], m["start"], m["skip"])
    assert np.allclose(p[np.arange(5), t.fixed], 1)


@pytest.fixture(scope="module")
def pii_model(llm):
    return pii.train(llm.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def _found(llm, model, texts):
    df = llm.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r.doc_id: r for r in pii.find(df, model).collect()}


def _values(text, spans):
    out = []
    for s in filter(None, spans.split(",")):
        kind, a, z = s.split(":")
        out.append((kind, text[int(a):int(z)]))
    return out


def test_skip_edges_find_further_mentions_and_only_those(llm, pii_model):
    base = ("Call +1 (988) 555-2485 today. Card 4420439893348601 was used. IP 42.144.35.254 answered. "
            "Mail bosbt.42@mail8.example.com now.")
    tail = " Later (988) 555-2485 rang, card 4420439893348602 failed, 42.144.35 was down and bosbt.42 wrote."
    numbers = " Year 2021 and 2021, order 9921834 and 9921834, version 10.1.1 or 10.1.1."
    texts = [base + numbers + tail, tail + " x" * 300 + base, tail + numbers, tail + tail + numbers, base + numbers, "", None]
    rows = _found(llm, pii_model, texts)
    for i in (0, 1):
        added = set(_values(texts[i], rows[i].spans)) - set(_values(texts[4], rows[4].spans))
        assert added == {("phone", "(988) 555-2485"), ("card", "4420439893348602"), ("ip", "42.144.35"),
                         ("email", "bosbt.42")}, i
    for i in (2, 3):
        assert rows[i].spans == "" and rows[i].n_added == 0
    assert rows[4].n_added == 0 and len(rows[4].spans.split(",")) == 4
    for i in (5, 6):
        assert (rows[i].spans, rows[i].base_sha256) == ("", hashlib.sha256(b"").hexdigest())


def test_pii_held_out_damage(llm, pii_model):
    """Damaged copies in documents the model has not seen: found where the
    document supports them, left alone where it does not."""
    rng = random.Random(9)
    docs = [r.text for r in llm.read.parquet("/root/testdata/check_h/documents.parquet").where(
        "doc_id % 97 = 0 AND length(text) BETWEEN 200 AND 4000").collect() if not pii.base_spans(r.text)][:200]
    assert len(docs) > 100
    caught = wrong = 0
    texts, marks = [], []
    for t in docs:
        digits = "".join(rng.choice("0123456789") for _ in range(15))
        card = next(digits + c for c in "0123456789" if pii.luhn(digits + c))
        value, kind = rng.choice([("u%d.%02d@host%d.example.org" % (rng.randrange(999), rng.randrange(99), rng.randrange(9)), 0),
                                  (".".join(str(rng.randrange(100, 255)) for _ in range(4)), 1), (card, 2),
                                  ("+1 (%03d) 555-%04d" % (rng.randrange(999), rng.randrange(9999)), 3)])
        bad = pii._damaged(value, kind, rng)
        for text in (f"{t} {value} {t[:500]} {bad} {t[-100:]}", f"{t} {bad} {t[:500]} {bad} end"):
            texts.append(text)
        marks.append((kind, bad))
    rows = _found(llm, pii_model, texts)
    for i, (kind, bad) in enumerate(marks):
        caught += rows[2 * i].n_added > 0 and pii.KINDS[kind] in {k for k, _ in _values(texts[2 * i], rows[2 * i].spans)}
        wrong += rows[2 * i + 1].n_added > 0
    assert caught >= 0.9 * len(marks) and wrong <= 0.02 * len(marks), (caught, wrong, len(marks))


def test_pii_over_awkward_documents(llm, documents, empty, pii_model):
    docs = documents.withColumn("spans", F.lit(1)).withColumn("n_email", F.lit("x"))
    got = pii.find(docs, pii_model)
    want = Counter((r.doc_id, *(sum(k == kind for _, k, _ in plain_base(r.text or "")) for kind in range(4)),
                    hashlib.sha256(",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in plain_base(r.text or "")).encode())
                    .hexdigest()) for r in documents.where("doc_id <> 90006 OR doc_id IS NULL").collect())
    rows = got.where("doc_id <> 90006 OR doc_id IS NULL").collect()
    assert Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in rows) == want
    assert pii.find(empty, pii.train(empty)).collect() == []
    # nothing to learn from: base spans only
    bare = pii.train(llm.createDataFrame([("no data 2021 and 2021",), (None,)], "text string"))
    assert _found(llm, bare, ["a.b@c.de 1234567 1234567"])[0].spans == "email:0:8"
