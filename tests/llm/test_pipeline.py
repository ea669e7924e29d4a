"""Every pipeline stage, and the whole run, against slow plain versions."""

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from lakeloom.llm import decontam, quality
from lakeloom.llm.queries import ORACLE_SQL
from tests.llm.conftest import SF
from tests.llm.test_exact import brute_fingerprint, components

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(llm, documents, tmp_path_factory):
    """The tables of a run: documents with awkward rows, and some that hold
    test items or parts of them."""
    root = str(tmp_path_factory.mktemp("tables"))
    bench = llm.read.parquet(f"{SF}/benchmark.parquet")
    items = [r.text for r in bench.orderBy("item_id").collect()]
    padding = " ".join(f"plain{k}" for k in range(40))
    extra = [(91_000 + k, f"{padding} nr{k}.\n{t.upper()}\nAnd more of nr{k}.", "en", "src1", 1) for k, t in enumerate(items[:8])]
    extra += [(91_100 + k, f"Half of nr{k}: " + " ".join(t.split()[:len(t.split()) // 2]), "en", "src2", 1)
              for k, t in enumerate(items[8:16])]
    docs = documents.select(*COLUMNS).unionByName(llm.createDataFrame(extra, documents.select(*COLUMNS).schema))
    docs.write.parquet(f"{root}/documents.parquet")
    bench.write.parquet(f"{root}/benchmark.parquet")
    llm.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{root}/labels.parquet")
    return root


def rows_of(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


def plain_line_features(lines):
    """The features of each line alone, one line at a time."""
    classes = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#$%&*@^~=+<>\\/_{}[]", b"!?", b"|", b".,;:'\"()-",
               bytes(range(128, 256))]
    # words of the same bytes in another order count as equal
    words = [[bytes(sorted(w)) for w in re.split(rb"[ \t\r\x0b\x0c]+", line) if w] for line in lines]
    seen = Counter(tuple(w) for w in words)
    out = []
    for line, w in zip(lines, words):
        size, n = len(line), len(w)
        shares = [(size - len(line.translate(None, c))) / max(size, 1) for c in classes]
        shares += [sum(a == b for a, b in zip(w, w[k:])) / max(n, 1) for k in (1, 2)]
        mean = (size - n + 1) / max(n, 1)
        out.append([1.0, math.log1p(size) / 6, min(mean, 30) / 10, n <= 2, size == 0, n > 1 and seen[tuple(w)] > 1]
                   + shares + [s > cut for s in shares for cut in (0.01, 0.05, 0.15, 0.4)])
    return np.array(out, float)


def plain_quality(text, m):
    """Length-weighted marginals by log-space forward-backward."""
    lines = (text or "").encode().split(b"\n")
    own = plain_line_features(lines)
    none = np.zeros((1, own.shape[1]))
    x = np.concatenate([own, np.r_[none, own[:-1]], np.r_[own[1:], none]], axis=1)
    emit = np.stack([np.zeros(len(x)), x @ m["w"]], axis=1)
    ahead, behind = [m["start"] + emit[0]], [np.zeros(2)]
    for e in emit[1:]:
        ahead.append(np.logaddexp.reduce(ahead[-1][:, None] + m["trans"], axis=0) + e)
    for e in emit[:0:-1]:
        behind.append(np.logaddexp.reduce(m["trans"] + (e + behind[-1])[None, :], axis=1))
    total = 0.0
    for line, a, b in zip(lines, ahead, behind[::-1]):
        total += (len(line) + 1) / (1 + math.exp(min(700, (a[0] + b[0]) - (a[1] + b[1]))))
    return total / sum(len(line) + 1 for line in lines)


def brute_quality(rows, m):
    return [r for r in rows if plain_quality(r[1], m) >= 0.5]


def brute_near_duplicates(rows):
    """Of a group the smallest id, none last; then the smallest signed print."""
    fp = np.array([brute_fingerprint(r[1]) for r in rows], np.uint64)
    comp = components(len(rows), np.argwhere(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 4).tolist())
    best = {}
    for r, f, c in zip(rows, fp.view(np.int64).tolist(), comp):
        rank = (r[0] is None, r[0] or 0, f, r)
        if c not in best or rank[:3] < best[c][:3]:
            best[c] = rank
    return [b[3] for b in best.values()]


def brute_passages(rows, depth=50):
    last = (1 << 63) - 1
    own = [last if r[0] is None else r[0] for r in rows]
    texts = [(r[1] or "").encode() for r in rows]
    first = {}
    for i, t in sorted(zip(own, texts)):
        for p in range(len(t) - depth + 1):
            first.setdefault(t[p:p + depth], i)
    out = []
    for r, i, t in zip(rows, own, texts):
        gone = bytearray(len(t))
        for p in range(len(t) - depth + 1):
            if first[t[p:p + depth]] < i:
                gone[p:p + depth] = b"\1" * depth
        kept = bytes(c for c, g in zip(t, gone) if not g).decode("utf-8", "ignore")
        text = None if r[1] is None else kept
        out.append((r[0], text, r[2], r[3], None if text is None else len(text)))
    return out


def plain_words(text):
    return [w for w in re.split(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", text.lower()) if w]


def grams(words, n=5):
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute_matches(rows, items):
    """(row, item) pairs: 0.8 of the item's shingles and half of its answer's
    words in one window of twice the longest item, without any index."""
    parts = []
    for k, text in items:
        cut = re.split(r"(?<=[.!?])\s+", (text or "").strip())
        answer = plain_words(cut[-1]) if len(cut) > 1 else []
        words = plain_words(" ".join(cut[:-1]) if len(cut) > 1 else text or "") + answer
        if words:
            parts.append((k, words, answer))
    step = max((len(w) for _, w, _ in parts), default=1)
    out = set()
    for n, r in enumerate(rows):
        words = plain_words(r[1] or "")
        for at in range(0, len(words), step):
            window = words[at:at + 2 * step]
            have, whole = Counter(window), grams(window)
            for k, w, answer in parts:
                want = grams(w)
                got = whole if len(w) >= 5 else grams(window, len(w))
                if len(want & got) >= 0.8 * len(want) and \
                        sum(min(c, have[t]) for t, c in Counter(answer).items()) >= 0.5 * len(answer):
                    out.add((n, k))
    return out


def sql_mix(rows):
    """The mix by SQL, of which the stage keeps what is drawn from."""
    con = duckdb.connect()
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
    con.register("documents", pa.table({c: pa.array([r[k] for r in rows], t) for k, (c, t) in enumerate(zip(COLUMNS, kinds))}))
    got = con.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({ORACLE_SQL['op1_mixing']}) WHERE taken > 0")
    return Counter((i, a, b, round(t, 6), n) for i, a, b, t, n in got.fetchall())


def mixed(df):
    return Counter((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in df.collect())


def test_quality_scores_by_plain_forward_backward(llm, folder):
    docs = llm.read.parquet(f"{folder}/documents.parquet")
    model = quality.train(docs, llm.read.parquet(f"{folder}/labels.parquet"))
    m = quality.load(model)
    assert "w" in m
    got = sorted((str(r.doc_id), r.score) for r in quality.score_documents(docs, model).collect())
    want = sorted((str(r[0]), plain_quality(r[1], m)) for r in rows_of(docs))
    assert [i for i, _ in got] == [i for i, _ in want]
    assert np.allclose([s for _, s in got], [s for _, s in want], atol=1e-4)


def test_matches_without_an_index(llm, folder):
    docs, bench = (llm.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    rows = rows_of(docs)
    want = Counter((str(rows[n][0]), k) for n, k in brute_matches(rows, [(r.item_id, r.text) for r in bench.collect()]))
    assert len({i for i, _ in want}) >= 8
    assert Counter((str(r.doc_id), r.item_id) for r in decontam.contaminated(docs, bench).collect()) == want


def test_stages_and_run_against_plain_versions(llm, folder, tmp_path):
    bench = [(r.item_id, r.text) for r in llm.read.parquet(f"{folder}/benchmark.parquet").collect()]
    docs = llm.read.parquet(f"{folder}/documents.parquet")
    m = quality.load(quality.train(docs, llm.read.parquet(f"{folder}/labels.parquet")))

    def clean(rows):
        bad = {n for n, _ in brute_matches(rows, bench)}
        return [r for n, r in enumerate(rows) if n not in bad]

    plain = {"quality": lambda rows: brute_quality(rows, m), "near_duplicates": brute_near_duplicates,
             "repeated_passages": brute_passages, "decontamination": clean}
    assert list(plain) + ["mixing"] == [name for name, _ in corpus_pipeline.STAGES]
    rows = rows_of(docs)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, rows = rows, plain[name](rows)
        assert rows != before, name  # each stage has something to do
        out = stage(llm, docs, folder)
        assert out.columns == COLUMNS
        out.write.parquet(f"{tmp_path}/{name}")
        docs = llm.read.parquet(f"{tmp_path}/{name}")
        assert Counter(rows_of(docs)) == Counter(rows), name
    want = sql_mix(rows)
    assert mixed(corpus_pipeline.STAGES[-1][1](llm, docs, folder)) == want
    assert mixed(corpus_pipeline.run(llm, folder)) == want
