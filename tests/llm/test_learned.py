"""Learned operators and decontamination: held-out accuracy, inference
against enumeration, retrieval against brute force, awkward rows."""

import itertools
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import decontam, language, quality, toxicity
from lakeloom.llm.crf import Chains, forward_backward
from tests.llm.conftest import fold

BIG = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def corpus(llm):
    return llm.read.parquet(f"{BIG}/documents.parquet"), llm.read.parquet(f"{BIG}/labels.parquet")


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(0)
    lens, k = [3, 1, 0, 4], 3
    emit, trans, start = rng.normal(size=(8, k)), rng.normal(size=(k, k)), rng.normal(size=k)
    got, moves, first, z = forward_backward(emit, Chains(lens), trans, start, pairs=True)
    want, want_moves, want_first, want_z, at = np.zeros((8, k)), np.zeros((k, k)), np.zeros(k), 0.0, 0
    for n in lens:
        if n:
            paths = list(itertools.product(range(k), repeat=n))
            w = np.array([np.exp(start[y[0]] + sum(emit[at + i, y[i]] for i in range(n))
                                 + sum(trans[a, b] for a, b in zip(y, y[1:]))) for y in paths])
            want_z += np.log(w.sum())
            for p, y in zip(w / w.sum(), paths):
                want_first[y[0]] += p
                for i in range(n):
                    want[at + i, y[i]] += p
                for a, b in zip(y, y[1:]):
                    want_moves[a, b] += p
        at += n
    assert np.allclose(got, want) and np.allclose(moves, want_moves)
    assert np.allclose(first, want_first) and z == pytest.approx(want_z)


def awkward(out, documents, column):
    rows = out.collect()
    assert len(rows) == documents.count()
    assert all(0.0 <= r.score <= 1.0 for r in rows)
    assert {r.doc_id for r in rows} == {r.doc_id for r in documents.select("doc_id").collect()}
    twins = [r[column] for r in rows if r.doc_id == 90_004]
    assert len(twins) == 2 and twins[0] == twins[1]


def test_quality_held_out(corpus, documents, empty):
    docs, labels = corpus
    model = quality.train(docs, labels)
    scored = quality.score_documents(docs, model)
    rows = scored.where("held_out").join(labels, "doc_id").collect()
    assert all(fold(r.doc_id, 3) == 1 for r in rows)
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.98
    assert np.mean([r.predicted for r in rows if r.quality == 1]) > 0.995
    awkward(quality.score_documents(documents.withColumn("score", F.lit("x")), model), documents, "score")
    assert quality.score_documents(empty, model).collect() == []
    assert quality.keep_good(empty, model).collect() == []


def test_toxicity_held_out(corpus, documents, empty):
    docs, labels = corpus
    model = toxicity.train(docs, labels)
    rows = toxicity.score_documents(docs, model).where("held_out").join(labels, "doc_id").collect()
    assert all(fold(r.doc_id, 4) == 2 for r in rows)
    assert np.mean([r.predicted for r in rows if r.toxic == 1]) > 0.9
    assert np.mean([r.predicted for r in rows if r.toxic == 0]) < 0.05
    awkward(toxicity.score_documents(documents, model), documents, "score")
    assert toxicity.score_documents(empty, model).collect() == []


def test_toxicity_keeps_every_telling_word():
    bad = ["".join(w) for w in itertools.product("bcdfghjk", "aeiouyw", "lmnprst")]
    assert len(bad) == 392
    rows = [(" ".join(bad[(d * 7 + j) % 392] for j in range(7)) + " some plain text", 1) for d in range(1120)]
    rows += [(f"some plain text number {d}", 0) for d in range(2000)]
    model = toxicity.fit(pa.table({"text": [t for t, _ in rows], "positive": [p for _, p in rows],
                                   "prior": [0.3] * len(rows)}))
    scorer = toxicity.Scorer(model)
    assert set(bad) <= set(scorer.names)
    assert all(scorer.score(f"{w} {w}".encode()) > scorer.score(b"some plain text") for w in bad)


def test_telling_features_are_counted_exactly(llm):
    rng = np.random.default_rng(5)
    rows = [(" ".join(f"w{k}" for k in rng.zipf(1.3, 20) % 5000) + (" qzx" if d < 40 else ""), int(d < 400))
            for d in range(1200)]
    frame = llm.createDataFrame(rows, "text string, positive int").repartition(5)
    got = toxicity.telling_features(frame)
    seen = {}
    for t, p in rows:
        for f in {f for w in t.split() for f in [w] + [w[:n] + "*" for n in (4, 5, 6) if len(w) >= n]}:
            seen.setdefault(f, [0, 0])[p] += 1
    z = {}
    for f, (u, p) in seen.items():
        m = (u + p) / 1200
        if u + p >= 8:
            z[f] = abs(p / 400 - u / 800) / (m * (1 - m) * (1 / 400 + 1 / 800) + 1e-12) ** 0.5
    strong = {f: v for f, v in z.items() if v > 5}
    assert got == sorted(f for f, v in strong.items() if all(strong.get(s, 0) < v for s in toxicity.shorter(f)))
    assert "qzx" in got  # in 40 positives alone, however often other words occur
    assert toxicity.telling_features(frame.where("positive = 1")) == []
    parts = list(toxicity.count_features([t.encode() for t, _ in rows], [p for _, p in rows], 50))
    assert len(parts) > 5
    total = {}
    for part in parts:
        for f, (u, p) in part.items():
            total.setdefault(f, [0, 0])
            total[f] = [total[f][0] + u, total[f][1] + p]
    assert total == seen


@pytest.mark.parametrize("shift", [-3.0, 0.0, 3.0])
def test_the_gradient_is_that_of_the_non_negative_risk(shift):
    rng = np.random.default_rng(1)
    x, positive, prior = rng.normal(size=(30, 4)), np.arange(30) < 12, 0.4
    w = rng.normal(size=4) * 0.3

    def parts(w, b):
        z = x @ w + b
        plus, minus = np.log1p(np.exp(-z)), np.log1p(np.exp(z))
        unl = minus[~positive].mean() - prior * minus[positive].mean()
        return prior * plus[positive].mean() + unl, unl

    def risk(w, b):
        whole, unl = parts(w, b)
        return whole if parts(w0, b0)[1] >= 0 else -unl

    w0, b0 = w, shift
    score = 1 / (1 + np.exp(-(x @ w + shift)))
    gw, gb = toxicity.risk_gradient(score, positive, prior, lambda g: x.T @ g)
    step = 1e-6
    for i in range(4):
        d = np.zeros(4)
        d[i] = step
        assert gw[i] == pytest.approx((risk(w + d, shift) - risk(w - d, shift)) / (2 * step), abs=1e-5)
    assert gb == pytest.approx((risk(w, shift + step) - risk(w, shift - step)) / (2 * step), abs=1e-5)


def test_one_id_with_very_many_rows(llm, monkeypatch):
    docs = llm.createDataFrame([(1, f"text {i}") for i in range(300)] + [(k, "plain words") for k in range(2, 9)],
                               "doc_id bigint, text string")
    labels = llm.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id bigint, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "train_in_task", lambda s, f: seen.extend(s.collect()) or b"")
    toxicity.train(docs, labels, folds=1, held=5, unlabelled=6)
    assert Counter(r.positive for r in seen) == {0: 6, 1: 2}


def test_language_held_out(corpus, documents, empty):
    docs, _ = corpus
    model = language.train(docs, per_language=60)
    rows = language.identify(docs, model).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(fold(r.doc_id, 4) == 2 for r in rows)
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.99
    out = language.identify(documents, model)
    awkward(out, documents, "lang_pred")
    got = {r.doc_id: r.lang_pred for r in out.collect()}
    assert {got[i] for i in (90_001, 90_002, 90_003, 90_007)} == {"und"}
    assert language.identify(empty, model).collect() == []


def test_code_switched_words_get_their_own_label(corpus):
    docs, _ = corpus
    rows = docs.where("doc_id < 1200").select("text", "lang").collect()
    model = language.fit(pa.table({"text": [r.text for r in rows], "lang": [r.lang for r in rows]}))
    tagger = language.Tagger(model)
    pick = {r.lang: " ".join(r.text.split()[:40]) for r in rows if 400 < len(r.text) < 3000}
    mixed = (pick["en"] + " " + pick["de"]).encode()
    share = dict(zip(tagger.langs, tagger.shares([mixed])[0]))
    n_en, n_de = len(pick["en"].split()), len(pick["de"].split())
    assert abs(share["en"] - n_en / (n_en + n_de)) < 0.12 and abs(share["de"] - n_de / (n_en + n_de)) < 0.12


@pytest.mark.parametrize("labels", [[], [(0, 1, 0), (1, 1, 0)]])
def test_models_without_two_classes(llm, documents, labels):
    lab = llm.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    for out in (quality.score_documents(documents, quality.train(documents, lab)),
                toxicity.score_documents(documents, toxicity.train(documents, lab))):
        assert all(0 <= r.score <= 1 for r in out.collect())


def test_language_without_training_text(documents, empty):
    out = language.identify(documents, language.train(empty, per_language=5)).collect()
    assert {r.lang_pred for r in out} == {"und"}


# ------------------------------------------------------------ contamination

def brute_matches(docs, items):
    out = set()
    for i, text in docs:
        got = decontam.shingles(decontam.words_of(text or ""))
        for k, item in items:
            want = decontam.shingles(decontam.words_of(item or ""))
            if want and len(want & got) >= decontam.OVERLAP * len(want):
                out.add((i, k))
    return out


def test_contaminated(llm):
    docs = llm.read.parquet(f"{BIG}/documents.parquet").where("doc_id < 4000")
    bench = llm.read.parquet(f"{BIG}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    planted = [(1_000_000 + k, f"Before it {t.upper()} and after.", "en", "s", 1) for k, t in items[:60]]
    planted += [(2_000_000 + k, " ".join(t.split()[:len(t.split()) // 2]), "en", "s", 1) for k, t in items[:60]]
    planted += [(3_000_000, None, None, None, None), (3_000_001, "", None, None, 0), (None, items[0][1], None, None, 1)]
    docs = docs.unionByName(llm.createDataFrame(planted, docs.schema)).withColumn("score", F.lit(1))
    want = brute_matches([(r.doc_id, r.text) for r in docs.collect()], items)
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench).collect()}
    assert got == want
    small = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench, index_bytes=9000).collect()}
    assert small == want
    scores = [{(r.doc_id, r.item_id): round(r.score, 9) for r in decontam.contaminated(docs, bench, index_bytes=n).collect()}
              for n in (9000, 16 << 20)]
    assert scores[0] == scores[1]  # statistics of all items, whatever the parts
    kept = decontam.drop_contaminated(docs, bench)
    bad = {i for i, _ in want}
    assert sorted(str(r.doc_id) for r in kept.select("doc_id").collect()) == sorted(
        str(r.doc_id) for r in docs.select("doc_id").collect() if r.doc_id not in bad)


def test_wand_equals_full_scoring():
    rng = np.random.default_rng(3)
    vocab = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocab, rng.integers(3, 14))), "") for i in range(120)]
    index = decontam.Index(items)
    for _ in range(200):
        terms = sorted(set(rng.integers(0, len(index.terms), 12).tolist()))
        score = np.zeros(len(index.ids))
        for j in terms:
            for k, x in zip(*index.lists[j][:2]):
                score[k] += x
        got = dict(index.wand(terms))
        near = {k for k in range(len(score)) if abs(score[k] - 1) < 1e-6}
        assert set(got) - near == {k for k in range(len(score)) if score[k] >= 1} - near


def test_empty_benchmark(documents, llm, empty):
    none = llm.createDataFrame([], "item_id bigint, text string")
    assert decontam.contaminated(documents, none).collect() == []
    assert decontam.drop_contaminated(documents, none).count() == documents.count()
    bench = llm.createDataFrame([(1, None), (None, "x y z"), (2, ""), (3, "...")], "item_id bigint, text string")
    assert decontam.contaminated(documents, bench).collect() == []
    assert decontam.contaminated(empty, bench).collect() == []


# --------------------------------------------------- quality, slow versions

def toy_quality(seed=0):
    rng = np.random.default_rng(seed)
    return {"w": rng.normal(size=153) * 0.4, "trans": rng.normal(size=(2, 2)), "start": rng.normal(size=2), "share": np.array(0.5)}


def test_document_scores_by_enumeration():
    import itertools

    m = toy_quality()
    texts = [b"Good line here.\nbuy!!! NOW\n\nGood line here.", b"", b"a b\na b\n1 2 3", b"\n", b"| x | y |\n$$$ 100%", "é ç\nñ".encode()]
    for t in texts:
        x, length, per_doc = quality.line_features([t])
        n = per_doc[0]
        emit = x.astype(np.float64) @ m["w"]
        total, good = 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=int(n)):
            s = m["start"][y[0]] + sum(m["trans"][a, b] for a, b in zip(y, y[1:])) + sum(e for e, k in zip(emit, y) if k)
            total += np.exp(s)
            good += np.exp(s) * np.array(y)
        want = (good / total * (length + 1)).sum() / (length + 1).sum()
        assert quality.score_texts([t], m)[0] == pytest.approx(want, abs=1e-9)
    alone = [quality.score_texts([t], m)[0] for t in texts]
    assert np.allclose(quality.score_texts(texts, m), alone, atol=1e-12)


def test_long_documents_by_windows(monkeypatch):
    m = toy_quality(1)
    texts = [b"word word word\nx\n\n!!\n" * 700, b"short one\nagain", b"\n" * 3000, b"one line only " * 500]
    want = quality.score_texts(texts, m)
    monkeypatch.setattr(quality, "LONG_CHAIN", 100)
    monkeypatch.setattr(quality, "WINDOW_LINES", 37)
    monkeypatch.setattr(quality, "WINDOW_BYTES", 600)
    assert np.allclose(quality.score_texts(texts, m), want, atol=1e-9)


def test_memory_of_a_text_of_line_breaks():
    import tracemalloc

    tracemalloc.start()
    quality.score_texts([b"\n" * 1_000_000], toy_quality())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 125 << 20, peak  # 4 million lines: under 500 MB


def test_the_fit_takes_bounded_rows_and_lines(llm, monkeypatch):
    docs = llm.createDataFrame([(1, "good text here\n" * 5)] * 50 + [(2, "bad $$$ !!!\n" * 5), (3, "good text\n"), (4, "$$ bad")],
                               "doc_id bigint, text string")
    labels = llm.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0)], "doc_id bigint, quality int")
    seen = []
    monkeypatch.setattr(quality, "train_in_task", lambda s, f: seen.append(s.collect()) or b"")
    quality.train(docs, labels, folds=1, held=5)
    assert sorted(r.label for r in seen[0]) == [0, 0, 1, 1]  # one row an id
    import pyarrow as pa
    monkeypatch.setattr(quality, "SAMPLE_LINES", 3)
    model = quality.load(quality.fit(pa.table({"text": ["a\n" * 50, "b", "c\n$$"], "label": [1, 0, 1]}), steps=2))
    assert 0 <= float(model["share"]) <= 1
