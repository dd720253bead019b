"""Toxicity: noisy-channel restoration of disguised words, then a score of the restored text.

1. Language model: counts of character trigrams over the words of all
   documents.  The table has a fixed size (61 classes cubed), whatever the corpus.
2. Channel: a disguised word is a lattice.  Each position offers the characters
   it may stand for (leetspeak, look-alikes, a censored letter), a mark at an end of
   the word also nothing, a run of two equal letters one or two, a longer run also
   itself, and a blank between spaced letters or a mark inside a token offers nothing
   or a word border.  Other punctuation cuts a token, and what stands between
   the marks of a token is also read on its own.
   Viterbi decoding finds the path with the least channel cost plus language-model
   cost, whatever the length of the word.  As short words cost less, the path that
   takes every mark for a letter and leaves runs of two is a second reading.  A word
   without any such position has a lattice of one path and is its own restoration.
3. Score: log likelihood ratios of restored words and their prefixes, learned from
   at most ``SAMPLE`` toxic labelled documents and ``CLEAN`` times as many clean ones
   (smallest hash of the id); near copies among the toxic ones count once, and a
   feature (found once, or found more often) must be more frequent than chance
   explains.  A text's log odds are the prior plus the distinct strongest features of
   its words; their sigmoid is the score.

Labels, language, source and id are no inputs of a score; the id only decides
who may teach.  Nulls and edge cases: a null or empty text has no words and gets
the score of no evidence; a null id is scored like any other and never teaches; a
label row without a label is ignored, rows that disagree count as toxic.
Without labelled rows of both classes every score is 0.  Texts are read whole.
Repeated rows get equal scores.  Other columns are ignored.
"""

from __future__ import annotations

import array
import functools
import itertools
import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import ship, tidy
from kestrel.llm.hashing import shingle_sets



#: Toxic documents that the classifier is fitted on, at most, and clean ones for each.
SAMPLE, CLEAN = 2000, 2
#: Features that chance may bring in, at most; clean texts added to those that have a
#: feature; least weight of a feature.
FALSE_FEATURES, DOUBT, LEAST_WEIGHT = 1.0, 4.0, 1.5
#: Features that the classifier keeps, at most.
FEATURES = 4000
THRESHOLD = 0.7

#: What a character may stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "2": "z",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "¡": "i", "(": "c", "<": "c",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j",
    "α": "a", "ο": "o", "ι": "i", "ν": "v", "ρ": "p", "τ": "t", "υ": "u", "κ": "k",
}
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõö÷øùúûüýþÿ"
_CENSORED = "*#%_"
_JOINTS = ".-_*~·'’"
_HIDDEN = re.compile("[­​-‏⁠﻿]")
_N = 61  #: border, 59 letters, anything else
_CLASS = np.full(0x110000, 60, np.int64)
_CLASS[[i for i in range(0x3000) if not chr(i).isalpha()]] = 0
for _i, _c in enumerate(LETTERS):
    _CLASS[ord(_c)] = _i + 1



@functools.lru_cache(maxsize=4096)
def _class(c: str) -> int:
    return int(_CLASS[ord(c)])


_CLASS_OF = {c: _class(c) for c in LETTERS}

#: Costs of the channel in nats.
_SWAP, _CENSOR, _COLLAPSE, _KEEP_RUN, _JOIN, _SPLIT = 0.5, 2.0, 0.5, 2.0, 0.2, 2.5
_PAIR, _NOISE = 2.0, 0.5  # one letter written twice; a mark at an end that is no letter
_ANY = [(x, _CENSOR) for x in LETTERS[:26]]
_MARKS = 32  # marks at a word's ends of which the tables are kept
#: A stretch of letters that stand for themselves, none of them twice in a row.
_STRETCH = re.compile(f"(?:([{LETTERS}])(?!\\1))+")
#: Characters that a lattice has a choice for.
_CHOICE = re.compile("[" + re.escape("".join(STANDS_FOR) + _CENSORED + _JOINTS) + "]")


def trigram_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Character trigrams of all texts: an array of 61 ** 3 counts."""
    ship(docs.sparkSession)

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_N ** 3, np.int64)
        for batch in batches:
            texts = [t for t in batch.column(0).to_pylist() if t]
            for a in range(0, len(texts), 200):
                points = np.frombuffer("  ".join(["", *texts[a:a + 200], ""]).lower().encode(
                    "utf-32-le", "replace"), np.uint32)
                c = _CLASS[points]
                c = np.append(c[(c[:-1] | c[1:]).nonzero()[0]], 0)  # one border between words
                if len(c) > 2:
                    total += np.bincount((c[:-2] * _N + c[1:-1]) * _N + c[2:], minlength=_N ** 3)
        at = total.nonzero()[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["k", "n"])

    rows = docs.select(F.col(text_col).alias("t")).mapInArrow(count, "k long, n long")
    out = np.zeros(_N ** 3, np.int64)
    for k, n in rows.groupBy("k").agg(F.sum("n").alias("n")).collect():  # 61 ** 3 rows at most
        out[k] = n
    return out


class Channel:
    """Viterbi decoding of disguised words under the trigram model."""

    def __init__(self, counts: np.ndarray):
        c = counts.reshape(_N, _N, _N).astype(np.float64)
        two, one = c.sum(0), c.sum((0, 1))
        p1 = (one + 1) / (one.sum() + _N)
        p2 = (two + 20 * p1) / (two.sum(1, keepdims=True) + 20)
        p3 = (c + 20 * p2[None]) / (c.sum(2, keepdims=True) + 20)
        self.array = -np.log(p3).reshape(_N * _N, _N)
        self.cost = self.array.ravel().tolist()
        #: For each cost of dropping a mark: states after k marks that begin a word, and least
        #: costs and choices of k marks that end one.
        self.heads: dict[tuple, list[dict]] = {}
        self.tails: dict[tuple, list[tuple[np.ndarray, np.ndarray | None]]] = {}

    @staticmethod
    def lattice(word: str, spaced: bool = False, keep: bool = False, stretches: bool = False) -> list[list[tuple[str, float]]]:
        """Options (text, cost) of each position of a lower-case word.

        ``keep``: every mark that may be a letter is one, and runs of two stay. ``stretches``: letters in a row
        that have no choice are one position.
        """
        out: list[list[tuple[str, float]]] = []
        first, last = 0, len(word)
        if not spaced:
            first = next((i for i, c in enumerate(word) if c.isalnum()), len(word))
            last = next((i for i in range(len(word) - 1, -1, -1) if word[i].isalnum()), -1)
        i = 0
        while i < len(word):
            if stretch := stretches and _STRETCH.match(word, i):
                out.append([(stretch.group(), 0.0)])
                i = stretch.end()
                continue
            c, n = word[i], 1
            while i + n < len(word) and word[i + n] == c:
                n += 1
            end = [("", _NOISE)] if not keep and not first <= i <= last else []
            border = [] if keep or spaced or c.isalnum() else [(" ", _SPLIT)]
            if spaced and c == " ":
                out.append([("", _JOIN), (" ", _SPLIT)])
            elif c in _CENSORED:
                inside = [] if end or keep else [("", _JOIN)] * (c in _JOINTS) + border
                out += [end + inside + _ANY] * n
            elif c in _JOINTS:
                out.append([("", _JOIN)] + (border if first < i < last else []))
            elif c.isalpha() and c not in STANDS_FOR:
                out.append([(c, _COLLAPSE), (c + c, _COLLAPSE), (c * n, _KEEP_RUN)] if n > 2
                           else [(c * n, 0.0)] + ([(c, _PAIR)] if n > 1 and not keep else []))
            else:
                options = [(x, _SWAP) for x in STANDS_FOR.get(c, "")] or [(c, 0.0)]
                out.append((end or border) + options)
                if n > 1:
                    out.append((end or ([] if keep and n == 2 else [("", 0.0 if n > 2 else _PAIR)])) + options)
            i += n
        return out

    def _any_letter(self, states: dict, options: list[tuple[str, float]]) -> dict:
        """States after a position that may be any letter, all letters at once."""
        after: dict = {}
        for x, more in options[:-26]:
            self._step(states, x, more, after)
        keys = sorted(states, key=lambda s: (s[1], s[0]))
        total = self.array[[p * _N + q for p, q in keys], 1:27] + (
            np.array([states[k][0] for k in keys]) + _CENSOR)[:, None]
        for q, group in itertools.groupby(range(len(keys)), key=lambda i: keys[i][1]):
            rows = list(group)
            part = total[rows[0]:rows[-1] + 1]
            at = part.argmin(0)
            for x, (i, cost) in enumerate(zip(at.tolist(), part.min(0).tolist())):
                if (q, x + 1) not in after or cost < after[q, x + 1][0]:
                    after[q, x + 1] = (cost, (states[keys[rows[i]]][1], LETTERS[x]))
        return after

    def _step(self, states: dict, x: str, more: float, after: dict) -> None:
        cost_of, classes = self.cost, [_CLASS_OF.get(c) or _class(c) for c in x]
        if len(states) == 1 and not after:  # one path in, one path out
            ((p, q), (total, path)), = states.items()
            total += more
            for k in classes:
                total += cost_of[(p * _N + q) * _N + k]
                p, q = q, k
            after[p, q] = (total, (path, x) if x else path)
            return
        for (p, q), (cost, path) in states.items():
            total = cost + more
            for k in classes:
                total += cost_of[(p * _N + q) * _N + k]
                p, q = q, k
            old = after.get((p, q))
            if old is None or total < old[0]:
                after[p, q] = (total, (path, x) if x else path)

    def decode(self, word: str, spaced: bool = False, keep: bool = False) -> str:
        lattice = self.lattice(word, spaced, keep, True)
        a, b = 0, len(lattice)
        while a < min(len(lattice), _MARKS) and len(lattice[a]) >= 26 and lattice[a] == lattice[0]:
            a += 1
        while b > max(a, len(lattice) - _MARKS) and len(lattice[b - 1]) >= 26 and lattice[b - 1] == lattice[-1]:
            b -= 1
        # a path is (path before, text): linear in the word, paths that end are freed
        states = self._head(lattice[0], a) if a else {(0, 0): (0.0, None)}
        for alone, group in itertools.groupby(lattice[a:b], key=lambda o: len(o) == 1):
            if alone:  # no choice: one step
                run = list(group)
                after: dict = {}
                self._step(states, "".join(o[0][0] for o in run), sum(o[0][1] for o in run), after)
                states = after
                continue
            for options in group:
                if len(options) >= 26:
                    states = self._any_letter(states, options)
                    continue
                after = {}
                for x, more in options:
                    self._step(states, x, more, after)
                states = after
        if b == len(lattice):
            if len(states) == 1:
                (_, path), = states.values()
                return self._text(path).strip()
            cost_of = self.cost
            path = min((v[0] + cost_of[(p * _N + q) * _N], i, v[1]) for i, ((p, q), v) in enumerate(states.items()))[2]
            return self._text(path).strip()
        tail = self._tail(lattice[-1], len(lattice) - b)
        ends = tail[len(lattice) - b][0]
        p, q = min(states, key=lambda s: states[s][0] + ends[s])
        text = [self._text(states[p, q][1])]
        for k in range(len(lattice) - b, 0, -1):
            if x := int(tail[k][1][p, q]):
                text.append(LETTERS[x - 1])
                p, q = q, x
        return "".join(text).strip()

    @staticmethod
    def _text(path: tuple | None) -> str:
        out = []
        while path:
            path, x = path
            out.append(x)
        return "".join(reversed(out))

    def _head(self, options: list[tuple[str, float]], k: int) -> dict:
        """States after k positions that may be any letter, at a word's start."""
        got = self.heads.setdefault(tuple(options[:-26]), [{(0, 0): (0.0, None)}])
        while len(got) <= k:
            got.append(self._any_letter(got[-1], options))
        return got[k]

    def _tail(self, options: list[tuple[str, float]], k: int) -> list[tuple[np.ndarray, np.ndarray | None]]:
        """Least costs of k positions that may be any letter and the border after them, from every state."""
        c = self.array.reshape(_N, _N, _N)
        got = self.tails.setdefault(tuple(options[:-26]), [(c[:, :, 0], None)])
        while len(got) <= k:
            before = got[-1][0]
            cost = c[:, :, 1:27] + before[None, :, 1:27] + _CENSOR
            at, least = cost.argmin(2) + 1, cost.min(2)
            for _, more in options[:-26]:  # nothing
                at, least = np.where(before + more <= least, 0, at), np.minimum(before + more, least)
            got.append((least, at))
        return got


_EDGE = ".,;:!?\"'()[]{}«»“”„…"
_OPEN, _CLOSE = "\"'[{«“„", ".,;:?\"')]}«»“”„…"  # marks at a word's ends that stand for no letter
_PLAIN = re.compile(r"[^\W\d_]+\Z")
#: Marks that a lattice reads, and all others that are no part of a word (accents are).
_MARK = "".join(c for c in dict.fromkeys([*STANDS_FOR, *_CENSORED, *_JOINTS]) if not c.isalnum())
_BETWEEN = re.compile(f"[{re.escape(_MARK)}]+")
_ACCENTS = "".join(c for c in map(chr, range(0x20000)) if unicodedata.category(c)[0] == "M")
_CUT = re.compile(f"[^\\w{re.escape(_MARK + _ACCENTS)}]+")
_RUN = re.compile(r"([^\W\d_])\1")
_SPACED = re.compile(r"(?<!\S)(?:[^\s][.,\-_]?[ \t]+){2,}[^\s](?!\S)")


class Restorer:
    """Restored words of texts; remembers disguised words it has decoded."""

    def __init__(self, counts: np.ndarray):
        self.channel = Channel(counts)
        self.known: dict[str, tuple[str, ...]] = {}

    def word(self, token: str) -> tuple[str, ...]:
        """Restored words of one blank-free lower-case token."""
        t = token.lstrip(_OPEN).rstrip(_CLOSE)
        if _PLAIN.match(t) and not _RUN.search(t) and t.isascii():
            return (t,)
        got = self.known.get(token)
        if got is None:
            if len(self.known) > 100_000:
                self.known.clear()
            got = self.known[token] = tuple(sorted(set().union(
                *(self._readings(u) for u in _CUT.split(_HIDDEN.sub("", token).lstrip(_OPEN).rstrip(_CLOSE)) if u))))
        return got

    def _readings(self, u: str) -> set[str]:
        """The words of the cheapest path, the path that takes marks for letters, a word without
        marks itself, and what stands between marks."""
        if not (_CHOICE.search(u) or _RUN.search(u)):
            return {u} - {""}
        out = set(self.channel.decode(u).split())
        if len(parts := [x for x in _BETWEEN.split(u) if x]) > 1:
            for x in parts:
                if len(x) > 2:  # shorter words have no features
                    out |= self._readings(x)
        if not (plain := _PLAIN.match(u) and u.isascii()) and any(c.isalnum() or c in STANDS_FOR for c in u):
            out.add(self.channel.decode(u, keep=True))  # marks for any letter alone say nothing
        if plain or u.isalpha() or not any(c.isalpha() for c in u) and u.isalnum():
            out.add(u)
        return out - {""}

    def tokens(self, text: str) -> Counter:
        """Readings of each token of a text, joined by tabs, and how often they occur."""
        tokens = Counter(text.lower().split())
        out: Counter = Counter()
        for t, n in tokens.items():
            out["\t".join(self.word(t))] += n
        out.update(self.spaced(text, tokens))
        del out[""]
        return out

    def words(self, text: str) -> Counter:
        """Restored words of a text and how often each occurs."""
        out: Counter = Counter()
        for t, n in self.tokens(text).items():
            for w in t.split("\t"):
                out[w] += n
        return out

    def spaced(self, text: str, tokens: Iterable[str]) -> list[str]:
        """Words written letter by letter; looked for only where three different letters stand alone."""
        short = [t for t in tokens if len(t) <= 2]
        if sum(len(t.strip(_EDGE)) == 1 for t in short) < 3:
            return []
        out: set[str] = set()
        for m in _SPACED.finditer(text.lower()):
            letters = [x.strip(_EDGE) or x for x in m.group().split()]
            if len(set(letters)) < 3:
                continue
            for a in range(0, len(letters), 30):  # windows overlap, so no word is cut
                out.update(self.channel.decode(" ".join(letters[a:a + 60]), True).split())
            if len(letters) <= 20:
                out.update(self.word("".join(letters)))
        return sorted(out)


def features(word: str) -> list[str]:
    """A restored word and its prefixes."""
    return ["=" + word, *[word[:k] for k in range(4, min(len(word), 8))]] if len(word) > 2 else []


def counted(words: Iterable[str]) -> set[str]:
    """Features of a text's words (readings of one word joined by tabs), marked 1 or 2 by
    whether they occur once or more often."""
    n = Counter(f for w in words for f in {f for x in w.split("\t") for f in features(x)})
    return {("2" if k > 1 else "1") + f for f, k in n.items()}


def may_teach(id_col: str = "doc_id") -> Column:
    """Rows of which the labels may be learned."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(3)) != 1, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, sample: int, id_col: str, text_col: str) -> DataFrame:
    """(toxic, text) of a bounded sample of labelled rows."""
    rows = labels.select(F.col("doc_id").alias("l_id"), F.col("toxic").alias("toxic")).where(
        F.col("toxic").isNotNull() & may_teach("l_id")).groupBy("l_id").agg(F.max("toxic").alias("toxic"))
    part = [rows.where(F.col("toxic") == k).orderBy(F.xxhash64("l_id"), "l_id").limit(n)
            for k, n in ((0, CLEAN * sample), (1, sample))]
    some = F.broadcast(part[0].unionByName(part[1]))  # (1 + CLEAN) * sample rows at most
    return docs.select(F.col(id_col).alias("l_id"), F.col(text_col).alias("t")).join(some, "l_id").select(
        "toxic", "t")


def _clusters(bottoms: list[list[int]]) -> list[int]:
    """Clusters of near copies: texts that share three of their eight least shingle hashes."""
    root = list(range(len(bottoms)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    seen: dict[tuple[int, ...], int] = {}
    for i, x in enumerate(bottoms):
        for three in itertools.combinations(x, min(3, len(x))):
            j = seen.setdefault(three, i)
            if j != i:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(bottoms))]


def _chance(t: int, n: int, share: float) -> float:
    """Probability of t or more toxic texts among n, if a feature says nothing."""
    total, term = 0.0, share ** t * math.comb(n, t) * (1 - share) ** (n - t)
    for k in range(t, n + 1):
        total += term
        term *= (n - k) / (k + 1) * share / (1 - share)
        if term < total * 1e-9:
            break
    return total


def train(rows: list[tuple[int, str, list[int]]]) -> tuple[float | None, dict[str, float]]:
    """Prior log odds and weights of features, from (label, restored words, least shingle hashes).

    A feature is kept if chance would bring less than one such feature among all
    that were looked at; its weight is its log likelihood ratio with ``DOUBT``
    added to the clean texts that have it.
    """
    toxic, clean = ([w.split(" ") for y, w, _ in rows if y == k] for k in (1, 0))
    if not toxic or not clean:
        return None, {}
    clusters: dict[int, list[list[str]]] = {}
    for k, x in zip(_clusters([least for y, _, least in rows if y == 1]), toxic):
        clusters.setdefault(k, []).append(x)
    n1, n0 = len(clusters), len(clean)

    def groups() -> Iterator[set[str]]:
        return (set().union(*map(counted, x)) for x in clusters.values())

    least = 3 if n1 > 3 else 2
    # hashed counts first: few features are frequent enough to be kept by name
    buckets = array.array("l", bytes(8 << 22))
    for x in groups():
        for f in x:
            buckets[zlib.crc32(f.encode("utf-8", "replace")) & 0x3FFFFF] += 1
    tested = max(1, sum(1 for k in buckets if k))
    t = Counter()
    for x in groups():
        t.update(f for f in x if buckets[zlib.crc32(f.encode("utf-8", "replace")) & 0x3FFFFF] >= least)
    del buckets
    t = {f: k for f, k in t.items() if k >= least}
    c = Counter()
    for x in clean:
        c.update(f for f in counted(x) if f in t)
    share, out = n1 / (n1 + n0), {}
    for f, n in t.items():
        weight = math.log((n + 0.5) / (n1 + 1)) - math.log((c[f] + DOUBT) / (n0 + 1))
        if weight >= LEAST_WEIGHT and n / (n + c[f]) > share and _chance(n, n + c[f], share) * tested <= FALSE_FEATURES:
            out[f] = weight
    # a prefix that a longer feature explains would only add words that are no part of it
    explained = {f[0] + g[:k] for f in out for g in [f[1:].lstrip("=")] for k in range(4, len(g) + 1)
                 if f[0] + g[:k] != f and t.get(f[0] + g[:k], 0) * 0.9 <= t[f]}
    best = sorted((f for f in out if f not in explained), key=lambda f: (-out[f], f))[:FEATURES]
    return math.log(n1 / n0), {f: out[f] for f in best}


def fit(docs: DataFrame, labels: DataFrame, counts: np.ndarray, sample: int = SAMPLE,
        id_col: str = "doc_id", text_col: str = "text") -> tuple[float | None, dict[str, float]]:
    """Intercept (None: nothing to learn from) and weights of features."""
    ship(docs.sparkSession)

    @tidy
    def restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = Restorer(counts)
        for b in batches:
            texts = b.column("t").to_pylist()
            words = [" ".join(sorted(w for w, n in r.tokens(t or "").items() for _ in range(min(n, 2)))) for t in texts]
            least = [x[:8].view(np.int64).tolist() for x in shingle_sets(texts)]
            yield pa.RecordBatch.from_arrays(
                [b.column("toxic").cast(pa.int32()), pa.array(words, pa.string()),
                 pa.array(least, pa.list_(pa.int64()))], names=["toxic", "words", "least"])

    got = _sample(docs, labels, sample, id_col, text_col).mapInArrow(
        restored, "toxic int, words string, least array<long>")
    return train([tuple(r) for r in got.orderBy("toxic", "words").collect()])


#: A word that begins with three letters or more and may have marks at its end.
_LETTERS_FIRST = re.compile(f"([^\\W\\d_]{{3,}})[{re.escape(_MARK)}]*\\Z")


def heads(letters: str) -> set[str]:
    """First four letters (all, if fewer) that a restored word may have, if its token begins with ``letters``,
    which have no choice but how often a letter in a row is written."""
    if letters[0] != letters[1] != letters[2] != letters[3:4]:
        return {letters[:4]}
    out, i = {""}, 0
    while i < len(letters) and any(len(x) < 4 for x in out):
        c, n = letters[i], 1
        while i + n < len(letters) and letters[i + n] == c:
            n += 1
        out = {(x + c * k)[:4] for x in out for k in {n, min(n, 2), 1}}
        i += n
    return out


class Scorer:
    """Scores of texts under a fitted classifier; remembers the features of each token."""

    def __init__(self, counts: np.ndarray, intercept: float | None, weights: dict[str, float]):
        self.restorer, self.intercept, self.weights = Restorer(counts), intercept, weights
        self.plain = {f[1:] for f in weights}
        #: first four letters (all, if fewer) of the words that have a known feature
        self.begins = {f[1:5] if f[0] == "=" else f[:4] for f in self.plain}
        self.known: dict[str, tuple[tuple[str, ...], ...]] = {}
        self.quiet: set[str] = set()  # tokens without a known feature

    def _may_speak(self, token: str) -> bool:
        """False if no reading of the token can have a known feature: decoding it would tell nothing."""
        m = _LETTERS_FIRST.match(token.lstrip(_OPEN).rstrip(_CLOSE))
        if not m or not (letters := m.group(1)).isascii() and _CHOICE.search(letters):
            return True
        alone = m.end() == m.end(1)  # marks at the end may be letters
        return any(x in self.begins or len(x) < 4 and not alone for x in heads(letters))

    def _evidence(self, words: Iterable[str]) -> tuple[tuple[str, ...], ...]:
        """The known features of each word that has any."""
        near = [w for w in words if w[:4] in self.begins]
        found = [tuple([f for f in features(w) if f in self.plain]) for w in near]
        return tuple([x for x in found if x])

    def score(self, text: str | None) -> float:
        if self.intercept is None:
            return 0.0
        tokens = Counter(text.lower().split()) if text else {}
        known, quiet, hits = self.known, self.quiet, []
        for t in set(tokens).difference(quiet):
            got = known.get(t)
            if got is None:
                got = self._evidence(self.restorer.word(t)) if self._may_speak(t) else ()
                if not got:
                    if len(quiet) > 200_000:
                        quiet.clear()
                    quiet.add(t)
                    continue
                if len(known) > 200_000:
                    known.clear()
                known[t] = got
            hits.append((got, tokens[t]))
        if tokens and (extra := self.restorer.spaced(text, tokens)):
            hits += [((x,), 1) for x in self._evidence(extra)]
        if not hits:
            return 1 / (1 + math.exp(-self.intercept))
        seen: Counter = Counter()
        for got, n in hits:
            for f in {f for x in got for f in x}:
                seen[f] += n
        # each word speaks through its strongest feature, each feature once
        chosen = set()
        for x in {x for got, _ in hits for x in got}:
            keys = [("2" if seen[f] > 1 else "1") + f for f in x]
            chosen.add(max(keys, key=lambda k: (self.weights.get(k, 0.0), k)))
        z = self.intercept + sum(self.weights.get(k, 0.0) for k in sorted(chosen))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def score(docs: DataFrame, counts: np.ndarray, intercept: float | None, weights: dict[str, float],
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score): whole texts, restored word by word."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(counts, intercept, weights)
        for batch in batches:
            out = [scorer.score(t) for t in batch.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("i"), pa.array(out, pa.float64())],
                                             names=[id_col, "score"])

    return docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).mapInArrow(
        run, f"`{id_col}` {kind}, score double")


def drop_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that score under the threshold, with all their columns."""
    counts = trigram_counts(docs, text_col)
    intercept, weights = fit(docs, labels, counts, sample, id_col, text_col)
    at = docs.columns.index(text_col)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(counts, intercept, weights)
        for batch in batches:
            keep = [scorer.score(t) < threshold for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, held_out, score, predicted) for every row of ``docs``."""
    counts = trigram_counts(docs, text_col)
    intercept, weights = fit(docs, labels, counts, sample, id_col, text_col)
    s = score(docs, counts, intercept, weights, id_col, text_col)
    return s.select(id_col, F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(3)) == 1,
                                       F.lit(False)).alias("held_out"),
                    "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
