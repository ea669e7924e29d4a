"""Linear-chain conditional random field inference and updates in numpy,
vectorised over many chains of different length."""

from __future__ import annotations

import numpy as np


class Chains:
    """Rows of all chains end to end; chain i has ``lens[i]`` rows. Chains are
    walked together, longest first, so step t touches a prefix of them."""

    def __init__(self, lens: np.ndarray) -> None:
        lens = np.asarray(lens, np.int64)
        self.order = np.argsort(-lens, kind="stable")
        self.lens = lens[self.order]
        self.first = (np.cumsum(lens) - lens)[self.order]
        top = int(self.lens[0]) if len(lens) else 0
        # chains longer than t, for every t
        self.active = len(lens) - np.searchsorted(np.sort(lens), np.arange(top), side="right")

    def by_step(self) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers step by step (longest chains first), and where each
        step begins."""
        if getattr(self, "_perm", None) is None:
            off = np.r_[0, np.cumsum(self.active)].astype(np.int64)
            step = np.repeat(np.arange(len(self.active)), self.active)
            rank = np.arange(int(off[-1])) - off[:-1][step]
            self._perm, self._off = self.first[rank] + step, off
        return self._perm, self._off


def forward_backward(emit: np.ndarray, chains: Chains, trans: np.ndarray, start: np.ndarray,
                     pairs: bool = False):
    """Marginals (rows, labels); with ``pairs`` also the expected transition
    counts, start counts and the log partition sum over all chains."""
    k = emit.shape[1]
    perm, off = chains.by_step()
    emit = emit[perm]  # step by step, so that a step is one slice
    top = emit.max(1) if len(emit) else np.zeros(0)
    e = np.exp(emit - top[:, None])
    t_mat = np.exp(trans)
    s_vec = np.exp(start)
    alpha, scale = np.empty_like(e), np.ones((len(e), 1))
    ones = np.ones((k, 1))
    steps = list(zip(off[:-1].tolist(), off[1:].tolist()))
    prev = None
    for a, z in steps:
        x = alpha[a:z]
        if prev is None:
            np.multiply(e[a:z], s_vec, out=x)
        else:
            np.dot(prev[:z - a], t_mat, out=x)
            x *= e[a:z]
        c = scale[a:z]
        np.dot(x, ones, out=c)
        x /= c
        prev = x
    e /= scale
    moves = np.zeros((k, k))
    beta = np.ones((len(chains.lens), k))
    back = np.ascontiguousarray(t_mat.T)
    for i in range(len(steps) - 1, 0, -1):
        a, z = steps[i]
        n = z - a
        b = beta[:n]
        w = e[a:z] * b
        if pairs:
            p = off[i - 1]
            moves += t_mat * (alpha[p:p + n].T @ w)
        alpha[a:z] *= b
        np.dot(w, back, out=b)
    if steps:
        alpha[:steps[0][1]] *= beta[:steps[0][1]]
    out = np.empty_like(alpha)
    out[perm] = alpha
    if not pairs:
        return out
    first = alpha[:steps[0][1]].sum(0) if steps else np.zeros(k)
    return out, moves, first, float(np.log(scale).sum() + top.sum())


def observed(labels: np.ndarray, chains: Chains, k: int):
    """Transition and start counts of given labels."""
    moves, first = np.zeros((k, k)), np.zeros(k)
    inner = np.ones(len(labels), bool)
    heads = chains.first[chains.lens > 0]
    inner[heads] = False
    at = np.flatnonzero(inner)
    np.add.at(moves, (labels[at - 1], labels[at]), 1)
    np.add.at(first, labels[heads], 1)
    return moves, first


class Adam:
    def __init__(self, rate: float) -> None:
        self.rate, self.t, self.m, self.v = rate, 0, {}, {}

    def step(self, params: dict[str, np.ndarray], grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        for name, g in grads.items():
            m = self.m.setdefault(name, np.zeros_like(g))
            v = self.v.setdefault(name, np.zeros_like(g))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            params[name] -= self.rate * (m / (1 - 0.9 ** self.t)) / (
                np.sqrt(v / (1 - 0.99 ** self.t)) + 1e-8)
