"""Sorting of suffixes by the deep-shallow scheme, and byte-string sampling.

``equal_classes`` orders fixed-depth suffixes: multikey quicksort on 8-byte
characters down to a shallow depth, then a blind trie per group that is still
tied. Suffixes that agree to the full depth come out as one class.
"""

from __future__ import annotations

import numpy as np

GRAM = 16  # length of the sampled gram, a power of two
_rng = np.random.Generator(np.random.PCG64(1234))
_MIX = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_B = [int(x) | 1 for x in _rng.integers(2**62, 2**63, 4, dtype=np.uint64)]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A mixed 64-bit hash of every GRAM-byte string, by doubling."""
    h = _MIX[data]
    width = 1
    for b in _B:  # widths 2, 4, 8, 16
        h = h[:-width] * np.uint64(b) + h[width:]
        width *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def window_grams(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For every start of a ``depth``-byte string, the position of the
    smallest gram hash inside it (the leftmost on a tie of the 40 bits used)
    and that hash. Equal strings choose equal grams at equal offsets."""
    h = gram_hashes(data)
    window = depth - GRAM + 1
    v = (h & ~np.uint64(0xFFFFFF)) | np.arange(len(h), dtype=np.uint64)
    width = 1
    while width * 2 <= window:
        v = np.minimum(v[:-width], v[width:])
        width *= 2
    if width < window:
        rest = window - width
        v = np.minimum(v[:-rest], v[rest:])
    return (v & np.uint64(0xFFFFFF)).astype(np.int64), v >> np.uint64(24)


def _words(text: np.ndarray, at: np.ndarray, offset: int, n: int) -> np.ndarray:
    """Big-endian numbers of the n <= 8 bytes at ``at + offset``."""
    out = np.zeros(len(at), np.uint64)
    for i in range(n):
        out = (out << np.uint64(8)) | text[at + (offset + i)]
    return out


def multikey_quicksort(text: np.ndarray, starts: np.ndarray, group: np.ndarray, depth: int,
                       small: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """Order of ``starts`` within their groups by the first ``depth`` bytes,
    and a flag per position: does it differ from the one before?

    Ternary partition around a median character (8 bytes at a time); the
    middle part moves on to the next character. Parts of at most ``small``
    suffixes are put aside and finished together by one stable sort per
    character.
    """
    n = len(starts)
    order = np.lexsort((group,)) if n else np.zeros(0, np.int64)
    heads = np.flatnonzero(np.r_[True, group[order][1:] != group[order][:-1]]) if n else np.zeros(0, np.int64)
    stack = [(int(a), int(b), 0) for a, b in zip(heads, np.r_[heads[1:], n]) if b - a > small]
    done = np.zeros(n, bool)
    new = np.zeros(n, bool)
    new[heads] = True
    while stack:
        a, b, k = stack.pop()
        part = order[a:b]
        if k * 8 >= depth:
            done[a:b] = True
            continue
        w = _words(text, starts[part], 8 * k, min(8, depth - 8 * k))
        pivot = np.partition(w, len(w) // 2)[len(w) // 2]
        low, mid = w < pivot, w == pivot
        pieces = [part[low], part[mid], part[~low & ~mid]]
        order[a:b] = np.concatenate(pieces)
        at = a
        for piece, step in zip(pieces, (0, 1, 0)):
            if len(piece):
                new[at] = True
                if len(piece) > small or step and (k + 1) * 8 >= depth:
                    stack.append((at, at + len(piece), k + step))
            at += len(piece)
    # the small parts: one label per part, then stable sorts character by
    # character; parts that are already sorted keep their place
    rest = np.flatnonzero(~done)
    if len(rest):
        part = np.cumsum(new)[rest]
        idx = order[rest]
        keys = [_words(text, starts[idx], 8 * k, min(8, depth - 8 * k)) for k in range((depth + 7) // 8)]
        o = np.lexsort((*keys[::-1], part))
        order[rest] = idx[o]
        diff = part[o][1:] != part[o][:-1]
        for w in keys:
            diff |= w[o][1:] != w[o][:-1]
        new[rest] = np.r_[True, diff]
        # a part that follows a finished one starts anew in any case
        new[heads] = True
        new[rest[np.flatnonzero(np.r_[True, rest[1:] != rest[:-1] + 1])]] = True
        nxt = rest + 1
        new[nxt[nxt < n][~np.isin(nxt[nxt < n], rest)]] = True
    return order, new


class BlindTrie:
    """Compacted trie that stores branching depths and one leaf per branch;
    strings are compared in full with a single leaf on insertion."""

    __slots__ = ("root", "size")

    def __init__(self) -> None:
        self.root = None

    def insert(self, s: bytes, item: int) -> None:
        node = self.root
        if node is None:
            self.root = (s, [item])
            return
        # blind descent by branching bytes alone
        path = []
        while len(node) == 3:
            path.append(node)
            depth, kids, first = node
            node = kids.get(s[depth]) or first[0]
        leaf = node[0]
        if leaf == s:
            node[1].append(item)
            return
        lcp = 0
        while leaf[lcp] == s[lcp]:
            lcp += 1
        new = (s, [item])
        parent = None
        node = self.root
        for p in path:
            if p[0] > lcp:
                break
            if p[0] == lcp:
                p[1][s[lcp]] = new
                return
            parent = p
            node = p[1].get(s[p[0]])
        inner = (lcp, {leaf[lcp]: node, s[lcp]: new}, [node if len(node) == 2 else node[2][0]])
        if parent is None:
            self.root = inner
        else:
            parent[1][s[parent[0]]] = inner

    def classes(self):
        """Leaves in byte order, each with its items."""
        stack = [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if len(node) == 2:
                yield node[1]
            else:
                stack.extend(node[1][c] for c in sorted(node[1], reverse=True))


def equal_classes(text: np.ndarray, starts: np.ndarray, group: np.ndarray, owner: np.ndarray,
                  depth: int, shallow: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of one group that agree in ``depth`` bytes and belong to two or
    more owners: (members, sizes), the members class by class."""
    order, new = multikey_quicksort(text, starts, group, min(shallow, depth))
    heads = np.flatnonzero(new)
    none = np.zeros(0, np.int64)
    if len(heads) == 0:
        return none, none
    sizes = np.diff(np.r_[heads, len(order)])
    mixed = _mixed(owner[order], heads)
    if depth <= shallow:
        return order[np.repeat(mixed, sizes)], sizes[mixed]
    raw = text.tobytes()
    tail = depth - shallow
    flat = order[np.repeat(mixed, sizes)]
    sizes = sizes[mixed]
    items, points = flat.tolist(), (starts[flat] + shallow).tolist()
    members: list[int] = []
    counts: list[int] = []
    at = 0
    for n in sizes.tolist():
        if n == 2:  # a trie of two leaves is one comparison
            p, q = points[at], points[at + 1]
            if raw[p:p + tail] == raw[q:q + tail]:
                members += items[at:at + 2]
                counts.append(2)
        else:
            trie = BlindTrie()
            for i in range(at, at + n):
                p = points[i]
                trie.insert(raw[p:p + tail], items[i])
            for c in trie.classes():
                if len(c) > 1:
                    members += c
                    counts.append(len(c))
        at += n
    flat, sizes = np.array(members, np.int64), np.array(counts, np.int64)
    if len(sizes) == 0:
        return none, none
    mixed = _mixed(owner[flat], np.cumsum(sizes) - sizes)
    return flat[np.repeat(mixed, sizes)], sizes[mixed]


def _mixed(owner: np.ndarray, heads: np.ndarray) -> np.ndarray:
    return np.minimum.reduceat(owner, heads) != np.maximum.reduceat(owner, heads)
