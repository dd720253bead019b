"""Linear-chain conditional random field with two labels over sequences of binned measures.

A sequence is a (lines, measures) matrix of bin numbers.  The score of label 1
at a line is a sum of weights, one for each measure's bin on the line itself, on
the line before and on the line after (bin ``BINS`` where there is none); label
0 scores 0.  Neighbouring labels add one of four transition weights.  All
sequences of a batch are run through the chain together, one position a step.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Bins of a measure; the next number stands for a missing neighbour.
BINS = 8


class Batch:
    """Sequences of bins side by side, the longest first."""

    def __init__(self, sequences: list[np.ndarray]):
        length = np.array([len(x) for x in sequences], dtype=np.int64)
        self.order = np.argsort(-length, kind="stable")
        self.length = length[self.order]
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]]) if len(length) else length
        bins = np.concatenate([sequences[i] for i in self.order]).astype(np.int64)
        n, self.measures = bins.shape
        gap = np.full_like(bins, BINS)
        before, after = gap.copy(), gap.copy()
        before[1:], after[:-1] = bins[:-1], bins[1:]
        before[self.start] = BINS
        after[self.start + self.length - 1] = BINS
        #: places of a line's weights in the flat table (3, measures, BINS + 1)
        cell = np.arange(self.measures) * (BINS + 1)
        step = self.measures * (BINS + 1)
        self.places = np.concatenate([bins + cell, before + cell + step, after + cell + 2 * step], axis=1)
        self.inner = np.ones(n, dtype=bool)
        self.inner[self.start] = False
        #: sequences that have a line number t
        self.alive = [int(np.searchsorted(-self.length, -t, side="left")) for t in range(int(self.length[0]) if n else 0)]

    def run(self, node: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Forward and backward log sums per line and label, and the log normaliser per sequence."""
        own = np.stack([np.zeros_like(node), node], axis=1)
        ahead, back = own.copy(), np.zeros_like(own)
        for t, n in enumerate(self.alive):
            if t:
                at = self.start[:n] + t
                x = ahead[at - 1]
                ahead[at] += np.logaddexp(x[:, :1] + move[0], x[:, 1:] + move[1])
        for t in range(len(self.alive) - 1, 0, -1):
            at = self.start[:self.alive[t]] + t
            x = own[at] + back[at]
            back[at - 1] = np.logaddexp(x[:, :1] + move[:, 0], x[:, 1:] + move[:, 1])
        last = ahead[self.start + self.length - 1]
        return ahead, back, np.logaddexp(last[:, 0], last[:, 1])

    def marginals(self, weights: np.ndarray) -> list[np.ndarray]:
        """Probability of label 1 at every line, in the order the sequences came."""
        node, move = self._scores(weights)
        ahead, back, total = self.run(node, move)
        p = np.exp(ahead[:, 1] + back[:, 1] - np.repeat(total, self.length))
        out: list[np.ndarray] = [np.empty(0)] * len(self.order)
        for k, i in enumerate(self.order):
            out[i] = p[self.start[k]:self.start[k] + self.length[k]]
        return out

    def _scores(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return weights[self.places].sum(axis=1), weights[-4:].reshape(2, 2)

    def loss(self, weights: np.ndarray, label: np.ndarray, share: np.ndarray) -> tuple[float, np.ndarray]:
        """Negative log likelihood and gradient, where all lines of sequence i have ``label[i]``; it counts ``share[i]`` times."""
        label, share = label[self.order], share[self.order]
        node, move = self._scores(weights)
        ahead, back, total = self.run(node, move)
        y, w = np.repeat(label, self.length), np.repeat(share, self.length)
        z = np.repeat(total, self.length)
        own = np.bincount(np.repeat(np.arange(len(label)), self.length), weights=node, minlength=len(label))
        true = np.where(label == 1, own + (self.length - 1) * move[1, 1], (self.length - 1) * move[0, 0])
        grad = np.zeros_like(weights)
        off = w * (np.exp(ahead[:, 1] + back[:, 1] - z) - y)
        grad += np.bincount(self.places.ravel(), weights=np.repeat(off, self.places.shape[1]), minlength=len(weights))
        to = np.flatnonzero(self.inner)
        here = np.stack([np.zeros(len(to)), node[to]], axis=1) + back[to]
        pair = np.exp(ahead[to - 1][:, :, None] + move[None] + here[:, None, :] - z[to][:, None, None])
        edges = (pair * w[to][:, None, None]).sum(axis=0)
        for k in (0, 1):
            edges[k, k] -= (share * (self.length - 1))[label == k].sum()
        grad[-4:] += edges.ravel()
        return float((share * (total - true)).sum()), grad


def n_weights(measures: int) -> int:
    return 3 * measures * (BINS + 1) + 4


def minimise(f: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, steps: int,
             memory: int = 8, enough: float = 1e-4) -> np.ndarray:
    """Limited-memory quasi-Newton descent with step halving; ends early when a step gains too little."""
    value, grad = f(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        d, kept = grad.copy(), []
        for s, y in reversed(past):
            a = (s @ d) / (s @ y)
            d -= a * y
            kept.append(a)
        if past:
            s, y = past[-1]
            d *= (s @ y) / (y @ y)
        else:
            d /= max(1.0, float(np.abs(grad).sum()))
        for (s, y), a in zip(past, reversed(kept)):
            d += s * (a - (y @ d) / (s @ y))
        size, slope = 1.0, float(grad @ d)
        while size > 1e-4:
            new = x - size * d
            found, g = f(new)
            if found <= value - 1e-4 * size * slope:
                break
            size /= 2
        else:
            return x
        if (new - x) @ (g - grad) > 1e-12:
            past = [*past[-(memory - 1):], (new - x, g - grad)]
        gain, x, value, grad = value - found, new, found, g
        if gain < enough * max(1.0, abs(value)):
            break
    return x
