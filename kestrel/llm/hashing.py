"""Hashes of words and byte windows over whole Arrow batches, in numpy.

A window's hash is a difference of prefix sums of byte * base ** position,
shifted back by the inverse power: no loop over bytes, any window length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240131).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_K5 = np.uint64(0xD6E8FEB86659FD93)


class _Powers:
    """Powers of the base and of its inverse, as far as needed so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(1 << (n - 1).bit_length(), 1 << 16)  # grown seldom
            for name, x in (("up", _BASE), ("down", _INVERSE)):
                a = np.full(n, x, np.uint64)
                a[0] = 1
                setattr(self, name, np.cumprod(a))
        return self.up, self.down


_powers = _Powers()


def forget() -> None:
    """Drop the powers; they are computed again where needed."""
    _powers.__init__()


def mix(x: np.ndarray) -> np.ndarray:
    """A seeded permutation of the 64-bit numbers."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct numbers (np.unique hashes, which is slower than this sort)."""
    s = np.sort(x)
    return s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s


def prefix_sums(b: np.ndarray) -> np.ndarray:
    up, _ = _powers.get(len(b) + 1)
    out = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTE[b] * up[:len(b)], out=out[1:])
    return out


def windows(sums: np.ndarray, start: np.ndarray, length: int | np.ndarray) -> np.ndarray:
    """Hash of the bytes [start, start + length)."""
    return mix((sums[start + length] - sums[start]) * _powers.get(len(sums))[1][start])


def chunks(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes; a larger row is alone."""
    a = n = 0
    for k, x in enumerate(sizes):
        if n and n + x > limit:
            yield a, k
            a, n = k, 0
        n += x
    if a < len(sizes):
        yield a, len(sizes)


def _word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z as a-z) and the number of words of each text."""
    sizes = np.array([len(t) + 1 for t in texts])
    b = _LOWER[np.frombuffer(b" ".join([*texts, b""]), np.uint8)]
    blank = _SPACE[b]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if len(b) and not blank[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[0::2], edge[1::2]  # the buffer ends with a space
    h = windows(prefix_sums(b), start, end - start)
    ends = np.cumsum(sizes)
    return h, np.diff(np.searchsorted(start, np.concatenate([[0], ends])))


def shingle_sets(texts: list[str | None], n: int = 5) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer than n words are one shingle."""
    raw = [(t or "").encode("utf-8", "replace") for t in texts]
    for a, b in chunks([len(t) for t in raw], 2_000_000):
        h, counts = _word_hashes(raw[a:b])
        s = h[:max(0, len(h) - n + 1)].copy()
        for k in range(1, n):
            s = mix(s * _K5 + h[k:len(h) - n + 1 + k])
        at = 0
        for c in counts.tolist():
            if c >= n:
                yield distinct(s[at:at + c - n + 1])
            elif c:
                x = h[at:at + 1]
                for k in range(1, c):
                    x = mix(x * _K5 + h[at + k:at + k + 1])
                yield x + np.uint64(c)
            else:
                yield h[:0]
            at += c
