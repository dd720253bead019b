"""FP-tree of documents' term vectors, searched depth first by branch and bound.

A document is the list of its terms that some item asks for, most frequent term
first; documents with equal beginnings share the path of a trie.  In the order of
these lists the documents below a node are neighbours, so a node is a range of
documents, and its path is what the first and the last of them share.  Every
inner node keeps, for each term below it, the largest number of occurrences, and
the least length factor; together they bound the score of any document below.
"""

from __future__ import annotations

import bisect

import numpy as np

#: Nodes of up to this many documents are scored document by document.
LEAF = 16


def saturation(tf: np.ndarray, m: np.ndarray | int) -> np.ndarray:
    """The contract's share of a term's weight, in millionths, rounded down."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Items:
    """The items' terms by rank: ``items[start[r]:start[r + 1]]`` ask for rank r of weight ``weight[r]``."""

    def __init__(self, weight: np.ndarray, asked: list[list[int]], n_items: int):
        self.weight, self.n = weight.astype(np.int64), n_items
        sizes = np.array([len(x) for x in asked], dtype=np.int64)
        self.start = np.concatenate([[0], np.cumsum(sizes)])
        self.items = np.array([i for x in asked for i in x], dtype=np.int64)

    def spread(self, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each item that asks for one of ``ranks``: the place in ``ranks``, the item."""
        n = self.start[ranks + 1] - self.start[ranks]
        place = np.repeat(np.arange(len(ranks)), n)
        first = np.repeat(self.start[ranks] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        return place, self.items[first + np.arange(len(place))]

    def sums(self, ranks: np.ndarray, share: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        """(rows, items): exact sums of weight times share over the terms of each row."""
        place, item = self.spread(ranks)
        out = np.zeros(rows * self.n, dtype=np.int64)
        np.add.at(out, row[place] * self.n + item, (self.weight[ranks] * share)[place])
        return out.reshape(rows, self.n)


class Best:
    """The best documents of every item so far; equal scores by id, null ids last."""

    def __init__(self, n_items: int, k: int):
        self.k, self.rows = k, [[] for _ in range(n_items)]
        #: a document must reach this score to be of interest; 0 never is
        self.least = np.ones(n_items, dtype=np.int64)

    def offer(self, item: int, score: int, doc) -> None:
        rows = self.rows[item]
        bisect.insort(rows, (-score, doc is None, 0 if doc is None else doc))
        if len(rows) > self.k:
            rows.pop()
        if len(rows) == self.k:
            self.least[item] = -rows[-1][0]


class Tree:
    """Documents (id, m, ranks of terms, occurrences) as one FP-tree.

    ``ranks`` and ``tf`` hold the documents one after the other, ``size`` entries each.
    """

    def __init__(self, ids: list, m: np.ndarray, size: np.ndarray, ranks: np.ndarray, tf: np.ndarray):
        doc = np.repeat(np.arange(len(ids)), size)
        by_rank = np.lexsort((ranks, doc))
        ranks, tf = ranks[by_rank], tf[by_rank]
        cut = np.concatenate([[0], np.cumsum(size)])
        key = ranks.astype(">u4")
        order = sorted(range(len(ids)), key=lambda i: key[cut[i]:cut[i + 1]].tobytes())
        self.ids, self.m = [ids[i] for i in order], m[order]
        size = size[order]
        self.start = np.concatenate([[0], np.cumsum(size)])
        source = np.repeat(cut[order] - self.start[:-1], size) + np.arange(len(ranks))
        self.ranks, self.tf = ranks[source], tf[source]

    def _path(self, lo: int, hi: int) -> int:
        """Length of the path that documents lo .. hi - 1 share."""
        a = self.ranks[self.start[lo]:self.start[lo + 1]]
        b = self.ranks[self.start[hi - 1]:self.start[hi]]
        n = min(len(a), len(b))
        differ = np.flatnonzero(a[:n] != b[:n])
        return int(differ[0]) if len(differ) else n

    def children(self, lo: int, hi: int) -> list[tuple[int, int]]:
        """The ranges of documents that continue the path with the same term; those that end there come first."""
        at = self.start[lo:hi] + self._path(lo, hi)
        ends = at >= self.start[lo + 1:hi + 1]
        term = np.where(ends, -1, self.ranks[np.minimum(at, len(self.ranks) - 1)])
        border = np.flatnonzero(np.diff(term)) + 1
        if not len(border):  # equal term lists: nothing left to branch on
            border = np.arange(LEAF, hi - lo, LEAF)
        cuts = [0, *border.tolist(), hi - lo]
        return [(lo + a, lo + b) for a, b in zip(cuts, cuts[1:])]

    def maxima(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Terms below a node, their largest tf, and the least m."""
        r, t = self.ranks[self.start[lo]:self.start[hi]], self.tf[self.start[lo]:self.start[hi]]
        order = np.argsort(r, kind="stable")
        r, t = r[order], t[order]
        first = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]])) if len(r) else np.empty(0, np.int64)
        return r[first], np.maximum.reduceat(t, first) if len(r) else t, int(self.m[lo:hi].min())

    def bound(self, lo: int, hi: int, items: Items) -> np.ndarray:
        """No document below the node scores more for an item."""
        r, t, m = self.maxima(lo, hi)
        return items.sums(r, saturation(t, m), np.zeros(len(r), np.int64), 1)[0]

    def scores(self, lo: int, hi: int, items: Items) -> np.ndarray:
        """(documents, items): exact scores."""
        a, b = self.start[lo], self.start[hi]
        row = np.repeat(np.arange(hi - lo), np.diff(self.start[lo:hi + 1]))
        return items.sums(self.ranks[a:b], saturation(self.tf[a:b], self.m[lo:hi][row]), row, hi - lo)

    def search(self, items: Items, best: Best) -> None:
        """Offer ``best`` every document that can be among an item's best.

        Depth first, the most promising child first.  An item leaves a subtree as
        soon as its own bound there is below its current k-th score; a bound that
        equals it stays, as a smaller id may win the tie.  A child of more than
        half its parent's documents inherits the parent's bound.
        """
        if not self.ids:
            return
        whole = len(self.ids)
        stack = [(0, whole, self.bound(0, whole, items), whole)]
        while stack:
            lo, hi, bound, bounded = stack.pop()
            alive = np.flatnonzero(bound >= best.least)
            if not len(alive):
                continue
            if hi - lo <= LEAF:
                found = self.scores(lo, hi, items)
                for doc, i in zip(*np.nonzero(found[:, alive] >= best.least[alive])):
                    item = int(alive[i])
                    if found[doc, item] >= best.least[item]:
                        best.offer(item, int(found[doc, item]), self.ids[lo + doc])
                continue
            below = []
            for a, b in self.children(lo, hi):
                fresh = 2 * (b - a) <= bounded
                x = self.bound(a, b, items) if fresh else bound
                below.append((float(x[alive].sum()), a, b, x, b - a if fresh else bounded))
            below.sort(key=lambda c: (c[0], -c[1]))
            stack += [c[1:] for c in below]
