"""Personal data by fixed forms and a skip-chain conditional random field.

The base finds e-mail addresses, IP addresses, card and phone numbers by form.
Further mentions often lack the form: a number with a mistyped digit, an
address without its host, a phone number without its plus sign. The model
decides on those from the whole document.

Tokens with a digit or an at sign are candidates; a word without either is
never labelled, so candidates with letters between them are independent and
the chains are runs of neighbouring candidates. Tokens of a document that are
equal, or that share a telling part (digits, local part, half of a long number,
all but one end of an address), are joined by skip edges, however far apart.
Base spans are evidence: their labels are fixed and loopy message passing
carries them along chains and skip edges, which makes the labels of a document
agree. Occurrences of one part form a path, so edges grow with the tokens.

There are no labels to learn from, so the model learns from the base: damaged
copies of a base span are planted in the same document, where they carry its
label, and, twice each, in another document, where nothing supports them and
they carry none; repeated plain numbers are planted there as well. All other
tokens outside base spans carry none.
"""

from __future__ import annotations

import io
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import text_blocks, train_in_task
from lakeloom.llm.crf import Adam, Chains, forward_backward, observed

KINDS = ("email", "ip", "card", "phone")
# outside, then inside of single-token kinds, then first and further tokens
LABELS = ("O", "email", "ip", "card", "card+", "phone", "phone+")
_KIND_OF = np.array([-1, 0, 1, 2, 2, 3, 3])
_FIRST = {0: 1, 1: 2, 2: 3, 3: 5}
_MORE = {0: 1, 1: 2, 2: 4, 3: 6}

SLOTS = 1 << 14  # weights of hashed features, per label
FEATURES = 14  # of a token
SAMPLE_ROWS = 1500  # documents with candidates the model is fitted on, at most
SAMPLE_BYTES = 1 << 14  # longest document in that sample
ROUNDS = 6  # message passing
BLOCK = 1 << 20

# --- fixed values: the base forms ---
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_HINT = re.compile(r"[0-9@]")
_EDGE = re.compile(r"[\s,;:!?\"'<>()\[\]{}|/\\=*]")
_SPACES = re.compile(r"[^\W\d_]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Every at sign with the whole run of local characters before it; the
    matches of the plain pattern, in time linear in the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        done = m.end() if m else at + 1
        at = text.find("@", done)


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four parts at a time of every dotted run; a run is read once."""
    for run in _DOTTED.finditer(text):
        if run.group().count(".") < 3:
            continue
        parts, at = run.group().split("."), run.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k:k + 4]
            size = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                yield at, at + size
            at += size + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all base spans, by start, then kind."""
    if not _HINT.search(text):
        return []
    out = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    out += [(s, 1, e) for s, e in _addresses(text)]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_DIGIT.findall(m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def candidates(text: str) -> list[tuple[int, int]]:
    """(start, end) of tokens with a digit or an at sign: runs without white
    space and enclosing punctuation, less dots and dashes at their ends."""
    out, done = [], 0
    hit = _HINT.search(text)
    while hit:
        start = hit.start()
        while start > done and not _EDGE.match(text, start - 1):
            start -= 1
        edge = _EDGE.search(text, hit.end())
        end = done = edge.start() if edge else len(text)
        while text[start] in ".-_":
            start += 1
        while text[end - 1] in ".-_":
            end -= 1
        out.append((start, end))
        hit = _HINT.search(text, done)
    return out


def _shape(token: str) -> str:
    """Kinds of characters with the lengths of digit runs."""
    low = re.sub(r"[^\W\d_]+", "a", token)
    return re.sub(r"[0-9]+", lambda m: f"9{min(m.end() - m.start(), 20)}", low)[:40]


def _telling(token: str, digits: str) -> set[str]:
    """Parts that a damaged copy of the token still has."""
    low = token.lower()
    keys = set()
    if "@" in low:
        local, _, host = low.partition("@")
        if len(local) >= 4:
            keys.add("l" + local)
        if len(host) >= 4 and local:
            keys.add("l" + local + "@" + host.split(".")[0])
    elif len(low) >= 4:
        keys.add("l" + low.removeprefix("+"))
    if len(digits) >= 6:
        keys.add("d" + digits)
    if len(digits) >= 12:
        # one wrong digit leaves one of two halves
        half = len(digits) // 2
        keys |= {f"p{len(digits)}{digits[:half]}", f"s{len(digits)}{digits[half:]}"}
    dots = low.split(".")
    if len(dots) in (3, 4) and all(p.isdigit() for p in dots):
        if len(dots) == 4:
            keys |= {"f" + ".".join(dots[:3]), "t" + ".".join(dots[1:])}
        else:
            keys |= {"f" + low, "t" + low}
    return keys


def _slot(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % SLOTS


class Tokens:
    """Candidate tokens of some documents end to end, their features, chains
    and skip edges."""

    def __init__(self, texts: list[str]) -> None:
        self.spans: list[tuple[int, int]] = []
        self.doc: list[int] = []
        self.per_doc: list[list[tuple[int, int, int]]] = []
        lens: list[int] = []
        rows: list[list[int]] = []
        edges: list[tuple[int, int, int]] = []
        fixed: list[int] = []
        for k, text in enumerate(texts):
            base = base_spans(text)
            self.per_doc.append(base)
            found = candidates(text) if text else []
            seen: dict[str, int] = {}
            last, b = -1, 0
            taken = -1
            words = [text[s:e] for s, e in found]
            shapes = [_shape(w) for w in words]
            for n, (s, e) in enumerate(found):
                at = len(self.spans)
                joined = n > 0 and s - last <= 4 and not _SPACES.search(text, last, s)
                if joined:
                    lens[-1] += 1
                else:
                    lens.append(1)
                w = words[n]
                digits = "".join(_DIGIT.findall(w))
                size = len(digits)
                long = "" if not 14 <= size <= 19 else "luhn" if luhn(digits) else "not luhn"
                left = text[max(0, s - 24):s]
                right = text[e:e + 24]
                names = ["bias", "s:" + shapes[n], f"n:{min(size, 24)}", "l:" + long,
                         "w:" + w[:32].lower(), "c:" + left[-1:] + "_" + right[:1],
                         "a:" + (left.split() or [""])[-1].lower()[-12:], "z:" + (right.split() or [""])[0].lower()[:12],
                         "b:" + (shapes[n - 1] if joined else ""),
                         "j:" + str(joined), f"d:{w.count('.')}:{min(size, 20)}", f"@:{w.count('@')}",
                         "p:" + left[-1:], "t:" + re.sub(r"[^a9]", "", shapes[n])[:12]]
                rows.append([_slot(x) for x in names])
                for key in _telling(w, digits):
                    before = seen.get(key)
                    if before is not None and before != at:
                        edges.append((before, at, 0 if key[0] in "ld" else 1))
                    seen[key] = at
                # base spans are in order of their start; the first that covers
                # the token labels it
                while b < len(base) and base[b][2] <= s:
                    b += 1
                label = -1
                if b < len(base) and base[b][0] < e:
                    label = (_MORE if taken == b else _FIRST)[base[b][1]]
                    taken = b
                fixed.append(label)
                self.spans.append((s, e))
                self.doc.append(k)
                last = e
        self.x = np.array(rows, np.int32).reshape(len(rows), FEATURES)
        self.lens = np.array(lens, np.int64)
        self.edges = np.unique(np.array(edges, np.int64).reshape(len(edges), 3), axis=0)
        self.fixed = np.array(fixed, np.int64)  # label of a base token, -1 elsewhere


def _compatible(weights: np.ndarray) -> np.ndarray:
    """Log potentials of a skip edge: one weight for the same kind, one for
    both outside."""
    out = np.zeros((len(LABELS), len(LABELS)))
    same = (_KIND_OF[:, None] == _KIND_OF[None, :])
    out[same & (_KIND_OF[:, None] >= 0)] = weights[0]
    out[0, 0] = weights[1]
    return out


def _evidence(emit: np.ndarray, fixed: np.ndarray) -> np.ndarray:
    out = emit.copy()
    at = np.flatnonzero(fixed >= 0)
    out[at] -= 60.0
    out[at, fixed[at]] += 60.0
    return out


def beliefs(emit: np.ndarray, chains: Chains, edges: np.ndarray, trans: np.ndarray, start: np.ndarray,
            skip: np.ndarray, rounds: int = ROUNDS, pairs: bool = False):
    """Marginals of all tokens by message passing between exact chain passes.

    ``emit`` are log potentials (tokens, labels); ``edges`` rows (u, v, type);
    ``skip`` (types, 2) weights. A round is one forward-backward pass over all
    chains, then one message each way over every skip edge; messages start
    even. Exact where chains and edges form no loop and ``rounds`` reaches
    along them. With ``pairs`` also chain and edge expectations.
    """
    u, v, kind = edges[:, 0], edges[:, 1], edges[:, 2]
    psi = np.exp(np.stack([_compatible(w) for w in skip]))[kind] if len(edges) else np.zeros((0, 7, 7))
    k = emit.shape[1]
    to_v, to_u = np.full((len(edges), k), -np.log(k)), np.full((len(edges), k), -np.log(k))
    for r in range(rounds if len(edges) else 1):
        total = emit.copy()
        np.add.at(total, v, to_v)
        np.add.at(total, u, to_u)
        got = forward_backward(total, chains, trans, start, pairs=pairs)
        p = got[0] if pairs else got
        if r + 1 == rounds or not len(edges):
            break
        # what a token believes without what this edge told it
        from_u = p[u] / np.exp(to_u)
        from_v = p[v] / np.exp(to_v)
        new_v = np.einsum("ea,eab->eb", from_u, psi)
        new_u = np.einsum("eb,eab->ea", from_v, psi)
        to_v = np.log(np.maximum(new_v / new_v.sum(1, keepdims=True), 1e-30))
        to_u = np.log(np.maximum(new_u / new_u.sum(1, keepdims=True), 1e-30))
    if not pairs:
        return p
    agree = np.zeros((len(skip), 2))
    if len(edges):
        joint = (p[u] / np.exp(to_u))[:, :, None] * psi * (p[v] / np.exp(to_v))[:, None, :]
        joint /= joint.sum((1, 2), keepdims=True)
        same = (_KIND_OF[:, None] == _KIND_OF[None, :]) & (_KIND_OF[:, None] >= 0)
        np.add.at(agree[:, 0], kind, (joint * same).sum((1, 2)))
        np.add.at(agree[:, 1], kind, joint[:, 0, 0])
    return p, got[1], got[2], agree


# ---------------------------------------------------------------- training

def _damaged(text: str, kind: int, rng: random.Random) -> str:
    """A copy of a base span that no longer has its form; a plain number
    stays as it is."""
    if kind < 0:
        return text
    if kind == 0:
        local, _, host = text.partition("@")
        return local if _DIGIT.search(local) and rng.random() < 0.5 else local + "@" + host.split(".")[0]
    if kind == 1:
        parts = text.split(".")
        return ".".join(parts[:3]) if rng.random() < 0.5 else ".".join(parts[:3] + [str(256 + rng.randrange(700))])
    if kind == 2:
        at = rng.choice([i for i, c in enumerate(text) if c.isdigit()])
        return text[:at] + str((int(text[at]) + 1 + rng.randrange(9)) % 10) + text[at + 1:]
    return text[1:] if rng.random() < 0.5 else re.sub(r"^\+[0-9]+[\x20-]*", "", text) or text[1:]


def _planted(text: str, spans: list[tuple[str, int]], rng: random.Random) -> tuple[str, list[tuple[int, int, int]]]:
    """The text with damaged copies at word gaps, and where they are."""
    gaps = sorted(rng.sample(range(len(text)), min(len(text), 4 * len(spans)))) if text else []
    out, marks, upto, size = [], [], 0, 0
    at = [text.find(" ", g) for g in gaps]
    at = sorted({g for g in at if g >= 0})
    for g, (value, kind) in zip(at, spans):
        piece = text[upto:g] + " "
        copy = _damaged(value, kind, rng)
        marks.append((size + len(piece), kind, size + len(piece) + len(copy)))
        out += [piece, copy]
        size += len(piece) + len(copy)
        upto = g
    out.append(text[upto:])
    return "".join(out), marks


def _labels(t: Tokens, marks: list[list[tuple[int, int, int]]]) -> np.ndarray:
    y = np.maximum(t.fixed, 0)
    for n, (s, e) in enumerate(t.spans):
        if t.fixed[n] >= 0:
            continue
        for a, kind, z in marks[t.doc[n]]:
            if s < z and a < e:
                first = n == 0 or t.doc[n - 1] != t.doc[n] or t.spans[n - 1][0] < a
                y[n] = (_FIRST if first else _MORE)[kind]
    return y


def fit(table: pa.Table, steps: int = 80, rate: float = 0.15, l2: float = 3e-3) -> bytes:
    """Weights from sample texts (column ``text``), see the module docstring.
    Weights of skip edges are not shrunk: support must outweigh the look of a
    token that the sample does not have."""
    texts = sorted(t for t in table.column("text").to_pylist() if t)
    every, marks = list(texts), [[] for _ in texts]
    values = [[(t[s:e], k) for s, k, e in base_spans(t)][:8] for t in texts]
    have = [i for i, v in enumerate(values) if v]
    for k, i in enumerate(have):
        rng = random.Random(zlib.crc32(texts[i].encode("utf-8", "surrogatepass")))
        text, at = _planted(texts[i], values[i], rng)
        every.append(text)
        marks.append(at)
        # the same copies where nothing supports them
        other = have[(k + 1) % len(have)]
        if other != i and not {v for v, _ in values[other]} & {v for v, _ in values[i]}:
            numbers = [(str(rng.randrange(10 ** rng.randrange(1, 13))), -1) for _ in range(2)]
            again = [*values[i], *numbers] * 2
            rng.shuffle(again)
            every.append(_planted(texts[other], again, rng)[0])
            marks.append([])
    t = Tokens(every)
    k = len(LABELS)
    p = {"w": np.zeros((SLOTS, k)), "trans": np.zeros((k, k)), "start": np.zeros(k), "skip": np.zeros((2, 2))}
    if len(t.spans) and (t.fixed >= 0).any():
        y = _labels(t, marks)
        chains = Chains(t.lens)
        moves, first = observed(y, chains, k)
        hot = np.zeros((len(y), k))
        hot[np.arange(len(y)), y] = 1
        told = np.zeros((2, 2))
        if len(t.edges):
            yu, yv = _KIND_OF[y[t.edges[:, 0]]], _KIND_OF[y[t.edges[:, 1]]]
            np.add.at(told[:, 0], t.edges[:, 2], (yu == yv) & (yu >= 0))
            np.add.at(told[:, 1], t.edges[:, 2], (yu == yv) & (yu < 0))
        free = max(float((t.fixed < 0).sum()), 1.0)
        used, x = np.unique(t.x, return_inverse=True)
        x = x.reshape(t.x.shape)
        q = {"w": np.zeros((len(used), k)), "trans": p["trans"], "start": p["start"], "skip": p["skip"]}
        opt = Adam(rate)
        for _ in range(steps):
            emit = _evidence(q["w"][x].sum(1), t.fixed)
            m, em, ef, agree = beliefs(emit, chains, t.edges, q["trans"], q["start"], q["skip"], pairs=True)
            g = (m - hot) / free
            gw = np.stack([np.bincount(x.ravel(), weights=np.repeat(g[:, c], x.shape[1]), minlength=len(used))
                           for c in range(k)], axis=1)
            opt.step(q, {"w": gw + l2 * q["w"], "trans": (em - moves) / free + l2 * q["trans"],
                         "start": (ef - first) / free + l2 * q["start"], "skip": (agree - told) / free})
        p["w"][used] = q["w"]
        p |= {"trans": q["trans"], "start": q["start"], "skip": q["skip"]}
    else:
        p["w"][_slot("bias"), 0] = 8.0  # nothing to learn from: nothing is added
    buf = io.BytesIO()
    np.savez_compressed(buf, **{n: a.astype(np.float32) for n, a in p.items()})
    return buf.getvalue()


def load(model: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(model)) as z:
        return {k: z[k].astype(np.float64) for k in z.files}


def train(docs: DataFrame, *, text_col: str = "text", sample_rows: int = SAMPLE_ROWS,
          sample_bytes: int = SAMPLE_BYTES) -> bytes:
    """Fit on at most ``sample_rows`` distinct texts of at most
    ``sample_bytes`` that may hold a base span, the first by a hash of the
    text. No label or other column is read."""
    text = F.col(text_col).cast("string")
    some = (docs.select(text.alias("text"))
            .where((F.octet_length("text") <= sample_bytes)
                   & F.col("text").rlike(r"@|\+[0-9]|[0-9]{4}|[0-9]\.[0-9]"))
            .withColumn("h", F.xxhash64("text", F.lit(31))))
    picked = some.select("h").distinct().orderBy("h").limit(sample_rows)
    # copies of one text meet before the shuffle, so a frequent text is one row
    sample = some.join(F.broadcast(picked), "h").groupBy("h").agg(F.min("text").alias("text")).select("text")
    return train_in_task(sample, fit)


# --------------------------------------------------------------- inference

def find_spans(texts: list[str], m: dict[str, np.ndarray], threshold: float = 0.5):
    """Per text its base spans and all spans, both sorted (start, kind, end).

    A run of tokens the model labels becomes one span if no base span overlaps
    it; every token of it is labelled with more than ``threshold`` belief."""
    t = Tokens(texts)
    full = [list(b) for b in t.per_doc]
    if not t.spans:
        return t.per_doc, full
    emit = _evidence(m["w"][t.x].sum(1), t.fixed)
    p = beliefs(emit, Chains(t.lens), t.edges, m["trans"], m["start"], m["skip"])
    inside = 1 - p[:, 0] > threshold
    label = 1 + p[:, 1:].argmax(1)
    breaks = np.zeros(len(p), bool)
    breaks[np.cumsum(t.lens) - t.lens] = True
    current = None  # document and span
    added: list[tuple[int, tuple[int, int, int]]] = []
    for n in np.flatnonzero(inside & (t.fixed < 0)).tolist():
        s, e = t.spans[n]
        kind = int(_KIND_OF[label[n]])
        grows = (current is not None and current[0] == n - 1 and not breaks[n] and kind >= 2
                 and label[n] == _MORE[kind] and added[-1][1][1] == kind)
        if grows:
            added[-1] = (t.doc[n], (added[-1][1][0], kind, e))
        else:
            added.append((t.doc[n], (s, kind, e)))
        current = (n,)
    for doc, (s, kind, e) in added:
        if s and texts[doc][s - 1] == "(" and ")" in texts[doc][s:e]:
            s -= 1
        if not any(a < e and s < z for a, _, z in t.per_doc[doc]):
            full[doc].append((s, kind, e))
    return t.per_doc, [sorted(f) for f in full]


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find(docs: DataFrame, model: bytes, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added)
    for every row.

    Counts and digest are of base spans; ``spans`` lists base and added spans
    as ``kind:start:end`` in code points, end exclusive. Whole texts are read;
    null and empty texts have no spans. Rows repeat as often as the input,
    other columns are ignored, an empty table gives no rows. No shuffle.
    """
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load(model)
        for b in text_blocks(batches, max_bytes=BLOCK):
            base, full = find_spans([x or "" for x in b.column("text").to_pylist()], m)
            counts = [[sum(1 for _, kind, _ in s if kind == k) for s in base] for k in range(4)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts),
                 pa.array([hashlib.sha256(written(s).encode()).hexdigest() for s in base], pa.string()),
                 pa.array([written(s) for s in full], pa.string()),
                 pa.array([len(f) - len(s) for f, s in zip(full, base)], pa.int64())],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, n_email bigint, n_ip bigint, "
                             "n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint")
