"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text is normalised (space to U+2581, one such mark in front), cut into units
(a run of marks and what follows it) and each unit is merged by an agenda of
adjacent symbol pairs: the pair whose merged piece has the best score goes
first, the leftmost of equals.  No piece of the vocabulary has a mark behind
another character, so no merge crosses a unit (checked when the model loads).

Units of up to ``WIDE`` characters are merged many at a time: every row of a
matrix of symbols pops the head of its own agenda in each step, which is the
order of the scalar agenda row by row.  Longer units use a heap.  Every unit
not yet known to the worker is encoded by the sentencepiece library too, and its ids are
decoded by it, one call each per group of texts; a difference ends the job.  Units are decoded from their
ids; only a decoded text that is not the unit itself has to be kept.

Nulls and edge cases: a null or empty text has no ids and decodes to the empty
text.  Characters that the vocabulary lacks become byte pieces.  Texts of any
length are encoded whole.  Repeated rows are encoded alike.  Only ``id_col``
and ``text_col`` are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import FORGET, ship, tidy
from kestrel.llm.hashing import chunks

MARK = "▁"
WIDE = 48
#: Units that a worker remembers in each of two generations; a unit used in the
#: younger one outlives the older.
REMEMBERED = 300_000
#: Bytes of text encoded at a time, at about.
GROUP = 1 << 21
_CHAR = 1 << 16  #: symbols from here on are characters without a piece of their own
_NONE = np.int64(1) << 40
_UNIT = re.compile(f"{MARK}+[^{MARK}]*")


class Vocabulary:
    """Pieces, the table of mergeable pairs, and the agenda."""

    def __init__(self, model_path: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        n = sp.get_piece_size()
        self.text = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (
            sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.id = {self.text[i]: i for i in plain}
        if any(MARK in t.lstrip(MARK) for t in self.id):
            raise ValueError("a piece of this vocabulary crosses a word boundary")
        self.unknown = sp.unk_id()
        self.control = {i for i in range(n) if sp.is_control(i)}
        byte = {int(self.text[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.byte_id = [byte.get(b, self.unknown) for b in range(256)]
        self.byte_of = {i: b for b, i in byte.items()}
        #: ids whose text depends on their neighbours; a byte under 128 is a character by itself
        self.open = {self.unknown, *self.control, *(i for b, i in byte.items() if b >= 128)}
        self.shown = [chr(self.byte_of[i]) if i in self.byte_of else t.replace(MARK, " ") for i, t in enumerate(self.text)]
        order = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in plain}, reverse=True))}
        self.symbol = {}  # character -> symbol
        for t in self.id:
            for c in t:
                self.symbol[c] = self.id.get(c, _CHAR + ord(c))
        pairs = {}
        for t, i in self.id.items():
            for k in range(1, len(t)):
                a, b = self._symbol(t[:k]), self._symbol(t[k:])
                if a is not None and b is not None:
                    pairs[a << 21 | b] = (order[sp.get_score(i)], i)
        self.pairs = pairs
        keys = np.array(sorted(pairs), np.int64)
        self._table(keys, np.array([pairs[k][0] << 17 | pairs[k][1] for k in keys.tolist()], np.int64))
        self.code = np.arange(0x110000, dtype=np.int32) + _CHAR
        for c, s in self.symbol.items():
            self.code[ord(c)] = s
        #: unit -> its ids, comma between them; the text of a unit's ids where it is not the unit
        self.known: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self.changed: dict[str, str] = {}
        self.decimal = [str(i) for i in range(n)]
        self.shown_size = np.array([len(t) for t in self.shown], dtype=np.int64)

    def _symbol(self, t: str) -> int | None:
        return self.symbol.get(t) if len(t) == 1 else self.id.get(t)

    def _table(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Open addressing with linear probes."""
        self.bits = max(4, int(np.ceil(np.log2(4 * max(1, len(keys))))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, _NONE, np.int64)
        at, left, self.probes = self._slot(keys), np.arange(len(keys)), 0
        while len(left):
            self.probes += 1
            free = self.keys[at[left]] < 0
            slots, first = np.unique(at[left][free], return_index=True)
            put = left[free][first]
            self.keys[slots], self.values[slots] = keys[put], values[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                >> np.uint64(64 - self.bits)).astype(np.int64)

    def look_up(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """rank << 17 | merged piece of each pair, or _NONE."""
        key = a << 21 | b
        at = self._slot(key)
        out = np.where(self.keys[at] == key, self.values[at], _NONE)
        open_ = np.flatnonzero((self.keys[at] != key) & (self.keys[at] >= 0))
        for _ in range(self.probes):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            got = self.keys[at[open_]]
            hit = got == key[open_]
            out[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit & (got >= 0)]
        return out

    def _agenda_rows(self, m: np.ndarray, rows: np.ndarray, out: list) -> None:
        """Merge all rows of a matrix of symbols; out[row] gets the final symbols."""
        r = self.look_up(m[:, :-1].ravel(), m[:, 1:].ravel()).reshape(len(m), -1)
        while len(m):
            width = m.shape[1]
            head = (r >> 17).argmin(1) if width > 1 else np.zeros(len(m), np.int64)
            best = r[np.arange(len(m)), head] if width > 1 else np.full(len(m), _NONE)
            done = best >= _NONE
            for k, line in zip(rows[done].tolist(), m[done].tolist()):
                out[k] = line
            live = ~done
            if not live.any():
                return
            m, r, rows, head, best = m[live], r[live], rows[live], head[live], best[live]
            at = np.arange(len(m))
            m[at, head] = best & 0x1FFFF
            keep = np.ones(m.shape, bool)
            keep[at, head + 1] = False
            m = m[keep].reshape(len(m), width - 1)
            keep = np.ones(r.shape, bool)
            keep[at, head] = False
            r = r[keep].reshape(len(m), width - 2)
            for side in (head - 1, head):
                k = np.flatnonzero((side >= 0) & (side < width - 2))
                if len(k):
                    r[k, side[k]] = self.look_up(m[k, side[k]], m[k, side[k] + 1])

    def agenda(self, unit: str) -> list[int]:
        """The scalar agenda: a heap of (rank, left end) over a linked list."""
        s = [self.symbol.get(c, _CHAR + ord(c)) for c in unit]
        after, before = list(range(1, len(s) + 1)), list(range(-1, len(s) - 1))
        heap = [(p[0], i, s[i], s[i + 1], p[1]) for i in range(len(s) - 1)
                if (p := self.pairs.get(s[i] << 21 | s[i + 1]))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, merged = heapq.heappop(heap)
            j = after[i]
            if s[i] != a or j >= len(s) or s[j] != b:
                continue  # one of the two has been merged since
            s[i], s[j] = merged, -1
            after[i] = after[j]
            if after[i] < len(s):
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < len(s) and (p := self.pairs.get(s[x] << 21 | s[y])):
                    heapq.heappush(heap, (p[0], x, s[x], s[y], p[1]))
        return [x for x in s if x >= 0]

    def _ids(self, symbols: list[int]) -> list[int]:
        if max(symbols) < _CHAR:
            return symbols
        out = []
        for x in symbols:
            out += [x] if x < _CHAR else [self.byte_id[b] for b in chr(x - _CHAR).encode("utf-8", "replace")]
        return out

    def encode_units(self, units: list[str]) -> list[list[int]]:
        out: list = [None] * len(units)
        by_length: dict[int, list[int]] = {}
        for k, u in enumerate(units):
            by_length.setdefault(len(u), []).append(k)
        for n, rows in by_length.items():
            if n > WIDE:
                for k in rows:
                    out[k] = self.agenda(units[k])
                continue
            for a in range(0, len(rows), 20_000):
                part = rows[a:a + 20_000]
                points = np.frombuffer("".join(units[k] for k in part).encode("utf-32-le"), np.uint32)
                self._agenda_rows(self.code[points].astype(np.int64).reshape(len(part), n), np.array(part), out)
        return [self._ids(x) for x in out]

    def units(self, text: str) -> list[str]:
        return _UNIT.findall(MARK + text.replace(" ", MARK)) if text else []

    def encode(self, text: str) -> list[int]:
        return [i for x in self.encode_units(self.units(text)) for i in x]

    def pieces_text(self, ids: list[int]) -> str:
        """Text of ids, with the leading mark as a space."""
        out, raw = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            if i == self.unknown:
                out.append(" ⁇ ")
            elif i not in self.control:
                out.append(self.text[i])
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        return "".join(out).replace(MARK, " ")

    def decode(self, ids: list[int]) -> str:
        t = "".join(map(self.shown.__getitem__, ids)) if self.open.isdisjoint(ids) else self.pieces_text(ids)
        return t[1:] if t.startswith(" ") else t

    def learn(self, units: set[str], check: bool) -> None:
        """Encode units that are not known yet, and compare them with the library."""
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        new = [u for u in units if u not in self.known]
        if self.older:
            for u in new:
                if u in self.older:
                    self.known[u] = self.older[u]
            new = [u for u in new if u not in self.known]
        ids = self.encode_units(new)
        if not new:
            return
        texts = self._texts(new, ids)
        if check:
            rows = [k for k, u in enumerate(new) if u != MARK]
            theirs = self.library.encode([new[k].replace(MARK, " ")[1:] for k in rows], num_threads=1)
            bad = [new[k] for k, x in zip(rows, theirs) if ids[k] != x]
            if self.library.decode(list(itertools.chain.from_iterable(ids))) != "".join(texts)[1:]:
                bad += [u for u, x, t in zip(new, ids, texts) if self.library.decode(x) != t[1:]] or new
            if bad:
                raise ValueError(f"{len(bad)} units differ from the sentencepiece library: {bad[:3]!r}")
        decimal = self.decimal.__getitem__
        self.known.update(zip(new, [",".join(map(decimal, x)) for x in ids]))
        for u, t in zip(new, texts):
            if t != u.replace(MARK, " "):
                if len(self.changed) > REMEMBERED:
                    self.known = {k: v for k, v in self.known.items() if k in units}
                    self.older, self.changed = {}, {k: v for k, v in self.changed.items() if k in self.known}
                self.changed[u] = t

    def _texts(self, units: list[str], ids: list[list[int]]) -> list[str]:
        """Text of every unit's ids, its first mark as a space; all plain units in one look-up."""
        plain = [k for k, x in enumerate(ids) if self.open.isdisjoint(x)]
        flat = np.fromiter(itertools.chain.from_iterable(ids[k] for k in plain), np.int64)
        whole = "".join(map(self.shown.__getitem__, flat.tolist()))
        first = np.concatenate([[0], np.cumsum([len(ids[k]) for k in plain])]).astype(np.int64)
        at = np.concatenate([[0], np.cumsum(self.shown_size[flat])])[first].tolist()
        out: list = [None] * len(units)
        for k, a, b in zip(plain, at, at[1:]):
            out[k] = whole[a:b]
        return [self.pieces_text(ids[k]) if t is None else t for k, t in enumerate(out)]

    def ids_of(self, units: list[str]) -> str:
        """Ids of a text's units, all of them known, comma between them."""
        known = self.known
        return ",".join([known[u] for u in units])

    def text_of(self, units: list[str]) -> str:
        """Text of the ids of these units."""
        if self.changed.keys().isdisjoint(units):
            return "".join(units).replace(MARK, " ")[1:]
        return "".join([self.changed.get(u) or u.replace(MARK, " ") for u in units])[1:]


_loaded: dict[str, Vocabulary] = {}
FORGET[__name__] = _loaded.clear


def vocabulary(model_path: str) -> Vocabulary:
    """One vocabulary per worker process and model."""
    if model_path not in _loaded:
        _loaded[model_path] = Vocabulary(model_path)
    return _loaded[model_path]


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                     digest: bool = False, check: bool = True) -> DataFrame:
    """Ids and decoded text per document, or their digests.

    digest=False: (id_col, n_tokens, ids array<int>, decoded)
    digest=True:  (id_col, n_tokens, ids_sha256, decoded_sha256)
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    tail = "ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>, decoded string"

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model_path)
        for batch in batches:
            column = batch.column("t")
            for a, b in chunks(pc.fill_null(pc.binary_length(column), 0).to_pylist(), GROUP):
                cut = [v.units(t or "") for t in column.slice(a, b - a).to_pylist()]
                v.learn({u for units in cut for u in units}, check)
                rows = []
                for units in cut:
                    ids, text = v.ids_of(units), v.text_of(units)
                    n = ids.count(",") + 1 if ids else 0
                    if digest:
                        rows.append((n, hashlib.sha256(ids.encode()).hexdigest(),
                                     hashlib.sha256(text.encode("utf-8")).hexdigest()))
                    else:
                        rows.append((n, [int(x) for x in ids.split(",")] if ids else [], text))
                cols = list(zip(*rows))
                third = (pa.array(cols[1], pa.string() if digest else pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("i").slice(a, b - a), pa.array(cols[0], pa.int64()), third,
                     pa.array(cols[2], pa.string())],
                    names=[id_col, "n_tokens", *[x.split()[0] for x in tail.split(", ")]])

    return docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens long, {tail}")
