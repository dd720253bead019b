"""Repeated passages by a difference-cover sample, at byte level.

A byte goes if a 100-byte string that covers it also starts earlier.  Only the
first 100 bytes of a suffix matter, so names are fingerprints of bounded
prefixes; ranks of whole suffixes are never needed.

1. Blocks: documents in order of id, cut into blocks of a few MB.  A document
   whose whole text occurred before goes as a whole and takes no part in the rest.
2. Sample: positions whose residue modulo 57 lies in a difference cover of 8
   residues.  For any two positions there is a shift under 57 that takes both into
   the sample, so a repeat of 100 bytes at (p, q) contains a repeat of 44 bytes at
   two sampled positions.  The sampled 44-byte prefixes are named by fingerprint,
   sent to ranges of names and sorted there; a name that occurs once tells that
   no window can match through it.
3. Remaining suffixes: a window can repeat only if one of the sampled positions at
   its first 57 bytes has a name that occurs twice.  Those windows are named by the
   64-bit fingerprint of all 100 bytes and sorted by range as well; in a run of
   equal neighbours all but the first (by document, then position) are repeats.
4. Each block gets one bit per window back and removes what its repeats cover.

Both rounds send sorted, delta-coded fingerprints of a block (equal ones once)
to as many name ranges as the data need, and get bitmaps back: a few bytes a
window, and no range sees more than its share however often one string occurs.

Nulls and edge cases: a null or empty text has no bytes and loses none; texts
under 100 bytes lose nothing; matches never cross documents.  Of two rows with
the same id the one that sorts first by text is earlier; a row without id comes
after all others.  Other columns are carried by ``drop_repeats`` only.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.common import cut, cut_and_free, release, ship, tidy, tidy_group
from kestrel.llm.hashing import distinct, prefix_sums, windows

LENGTH = 100
#: A difference cover modulo 57; every difference occurs, each non-zero one once.
MODULUS, COVER = 57, (0, 1, 3, 13, 32, 36, 43, 52)
SEED_LENGTH = LENGTH - MODULUS + 1
#: Bytes of text a block, and fingerprints a name range, at about.
BLOCK_BYTES = 2 << 20
RANGE_NAMES = 2 << 20
#: Bytes of documents that go back to Spark in one batch, at about.
SLICE_BYTES = 1 << 20
#: Bits of a sampled name beyond those that choose its range; a chance match only costs a check.
NAME_BITS = 32

_IN_COVER = np.zeros(MODULUS, bool)
_IN_COVER[list(COVER)] = True


def pack(sorted_values: np.ndarray) -> bytes:
    """Sorted distinct 64-bit numbers as differences: low bytes as they are, high bytes compressed.

    The low bytes of a difference are noise; the byte planes above the mean hold little.
    """
    d = np.diff(sorted_values, prepend=np.uint64(0))
    mean = int(sorted_values[-1]) // len(d) + 1
    low = min(7, max(0, mean.bit_length() - 1) // 8)
    planes = d.view(np.uint8).reshape(-1, 8)
    high = zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes[:, low:].T).data)
    return bytes([low]) + len(d).to_bytes(4, "little") + planes[:, :low].tobytes() + high


def unpack(data: bytes) -> np.ndarray:
    low, n = data[0], int.from_bytes(data[1:5], "little")
    planes = np.zeros((n, 8), np.uint8)
    planes[:, :low] = np.frombuffer(data, np.uint8, n * low, 5).reshape(n, low)
    high = zstandard.ZstdDecompressor().decompress(data[5 + n * low:])
    planes[:, low:] = np.frombuffer(high, np.uint8).reshape(8 - low, n).T
    return np.cumsum(planes.view(np.uint64).ravel(), dtype=np.uint64)


#: Sampled positions of a document of up to so many bytes; longer ones are sampled by residue.
_SAMPLED = np.flatnonzero(np.tile(_IN_COVER, 20_000))


class Block:
    """Bytes of consecutive documents with the window arithmetic of both rounds.

    dead: places of documents that repeat an earlier document as a whole; they take no part.
    """

    def __init__(self, data: np.ndarray, sizes: np.ndarray, dead: list[int] | None):
        self.data, self.sizes = data, sizes
        self.ends = np.cumsum(sizes)
        self.dead = np.zeros(len(sizes), bool)
        self.dead[dead or []] = True
        self.sums = prefix_sums(data)

    def sample(self) -> np.ndarray:
        """Sampled positions with ``SEED_LENGTH`` bytes left in their document."""
        parts = [np.zeros(0, np.int64)]
        for e, n, dead in zip(self.ends.tolist(), self.sizes.tolist(), self.dead.tolist()):
            last = n - SEED_LENGTH + 1
            if dead or last <= 0:
                continue
            if last > 20_000 * MODULUS:
                own = np.flatnonzero(np.resize(_IN_COVER, last))
            else:
                own = _SAMPLED[:np.searchsorted(_SAMPLED, last)]
            parts.append(own + (e - n))
        return np.concatenate(parts)

    def names(self, at: np.ndarray) -> np.ndarray:
        return windows(self.sums, at, SEED_LENGTH)

    def candidates(self, sampled: np.ndarray, twice: np.ndarray) -> np.ndarray:
        """Window starts with a repeated sampled name among their first positions."""
        hit = sampled[twice]
        n = len(self.data)
        near = np.bincount(np.maximum(hit - MODULUS + 1, 0), minlength=n + 1).astype(np.int32)
        near -= np.bincount(hit + 1, minlength=n + 1).astype(np.int32)
        ok = np.cumsum(near[:-1], dtype=np.int32) > 0
        for e, m, dead in zip(self.ends.tolist(), self.sizes.tolist(), self.dead.tolist()):
            ok[e - m if dead else max(e - m, e - LENGTH + 1):e] = False
        return np.flatnonzero(ok)

    def window_names(self, at: np.ndarray) -> np.ndarray:
        return windows(self.sums, at, LENGTH)


def _texts_to_blocks(docs: DataFrame, id_col: str, text_col: str, carry: list[str], n_blocks: int) -> DataFrame:
    """(block, rows, sizes, data): blocks numbered in order of the documents; rows: what is carried."""
    key = [F.col("missing"), F.col("i"), F.col("t")]
    rows = docs.select(F.col(id_col).isNull().alias("missing"), F.col(id_col).cast("long").alias("i"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("t"),
                       F.struct(*[F.col(c) for c in carry]).alias("row"))
    ordered = rows.repartitionByRange(n_blocks, "missing", "i").sortWithinPartitions(*key)
    ordered = ordered.select(F.spark_partition_id().cast("long").alias("p"), "row", "t")
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("rows", T.ArrayType(ordered.schema["row"].dataType)),
        T.StructField("sizes", T.ArrayType(T.IntegerType())), T.StructField("digests", T.ArrayType(T.BinaryType())),
        T.StructField("data", T.BinaryType())])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        kind = None
        sizes: list[int] = []
        parts: list[bytes] = []
        total = serial = 0
        part = 0

        def block() -> pa.RecordBatch:
            data = zstandard.ZstdCompressor(level=3).compress(b"".join(parts))
            digests = [hashlib.blake2b(x, digest_size=16).digest() for x in parts]
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 24) + serial], pa.int64()), pa.array([held], pa.list_(kind)),
                 pa.array([sizes], pa.list_(pa.int32())), pa.array([digests], pa.list_(pa.binary())),
                 pa.array([data], pa.binary())], names=schema.names)

        for batch in batches:
            kind = batch.column("row").type
            for p, row, t in zip(*(batch.column(c).to_pylist() for c in ("p", "row", "t"))):
                raw = t.encode("utf-8", "replace")
                if parts and total + len(raw) > BLOCK_BYTES:
                    yield block()
                    held, sizes, parts, total, serial = [], [], [], 0, serial + 1
                part = p
                held.append(row), sizes.append(len(raw)), parts.append(raw)
                total += len(raw)
        if parts:
            yield block()

    return ordered.mapInArrow(run, schema)


def _open(row: dict) -> Block:
    raw = zstandard.ZstdDecompressor().decompress(row["data"])
    return Block(np.frombuffer(raw, np.uint8), np.array(row["sizes"], np.int64), row["dead"])


def _send(block: int, names: np.ndarray, bits: int, low: int) -> Iterator[tuple[int, int, bytes]]:
    """Sorted distinct names of a block, cut into 2 ** bits ranges; ``low`` bits are dropped."""
    u = distinct(names >> np.uint64(low))
    shift = np.uint64(64 - low - bits)
    cuts = np.searchsorted(u, np.arange((1 << bits) + 1, dtype=np.uint64) << shift) if bits else [0, len(u)]
    if bits:
        cuts[-1] = len(u)
    for r in range(1 << bits):
        if cuts[r] < cuts[r + 1]:
            yield r, block, pack(u[cuts[r]:cuts[r + 1]])


def _ranges(total: int) -> int:
    """Bits that choose a name range."""
    return max(3, math.ceil(math.log2(max(1, total) / RANGE_NAMES)))


def _judge(sent: DataFrame, later: bool) -> DataFrame:
    """Bitmaps per (block, range): names in several blocks, or (later) in an earlier block.

    One range at a time: its names are concatenated and sorted once.
    """

    @tidy_group
    def run(key: tuple, group: pa.Table) -> pa.Table:
        blocks = np.array(group.column("block").to_pylist(), np.int64)
        order = np.argsort(blocks, kind="stable")
        data = group.column("data")
        lists = [unpack(data[int(k)].as_py()) for k in order]
        lens = np.array([len(x) for x in lists])
        names = np.concatenate(lists)
        at = np.argsort(names, kind="stable")  # equal names stay in order of blocks
        s = names[at]
        same = s[1:] == s[:-1]
        flag = np.zeros(len(s), bool)
        flag[1:] = same
        if not later:
            flag[:-1] |= same
        out = np.empty(len(s), bool)
        out[at] = flag
        ends = np.cumsum(lens)
        bits = [np.packbits(out[e - n:e]).tobytes() for e, n in zip(ends.tolist(), lens.tolist())]
        return pa.table({"block": pa.array(blocks[order], pa.int64()),
                         "range": pa.array([key[0].as_py()] * len(order), pa.int32()),
                         "n": pa.array(lens, pa.int32()), "bits": pa.array(bits, pa.binary())})

    marks = sent.groupBy("range").applyInArrow(run, "block long, range int, n int, bits binary")
    return marks.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("range", "n", "bits"))).alias("marks"))


def _flags(names: np.ndarray, low: int, marks: list[dict] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct names (cut by ``low`` bits), which of them are marked, and each name's place among them."""
    u, back = np.unique(names >> np.uint64(low), return_inverse=True)
    parts = [np.unpackbits(np.frombuffer(m["bits"], np.uint8), count=m["n"]) for m in marks or []]
    return u, (np.concatenate(parts) if parts else np.zeros(0)).astype(bool), back


def _sampled_twice(b: Block, low: int, marks: list[dict] | None) -> tuple[np.ndarray, np.ndarray]:
    at = b.sample()
    u, marked, back = _flags(b.names(at), low, marks)
    here = np.bincount(back, minlength=len(u)) > 1
    return at, (marked | here)[back]


def _whole_copies(blocks: DataFrame) -> DataFrame:
    """(block, dead): places of documents whose whole text is that of an earlier one."""
    place = F.struct("block", "k")
    docs = blocks.select("block", F.posexplode("digests").alias("k", "digest"))
    first = docs.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = docs.join(first, "digest").where(place != F.col("first"))
    return later.groupBy("block").agg(F.collect_list("k").alias("dead"))


def _spans(starts: np.ndarray) -> list[list[int]]:
    """Maximal runs covered by windows at sorted ``starts``."""
    if not len(starts):
        return []
    new = np.flatnonzero(np.diff(starts, prepend=-LENGTH - 1) > LENGTH)
    last = np.append(new[1:], len(starts)) - 1
    return np.stack([starts[new], starts[last] + LENGTH], 1).tolist()


def _repeats(b: Block, low: int, row: dict) -> np.ndarray:
    """Starts of the windows that repeat an earlier one, from both rounds' bits."""
    at = b.candidates(*_sampled_twice(b, low, row["marks"]))
    _, marked, back = _flags(b.window_names(at), 0, row["later"])
    repeat = np.ones(len(at), bool)
    _, first = np.unique(back, return_index=True)
    repeat[first] = marked if len(marked) else False
    return at[repeat]


def _without(own: np.ndarray, spans: list[list[int]]) -> bytes:
    """The bytes outside the spans."""
    cuts = [0, *(x for span in spans for x in span), len(own)]
    return b"".join([own[x:y].tobytes() for x, y in zip(cuts[::2], cuts[1::2])])


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 carry: list[str] | None = None, real: bool = False, texts: bool = False,
                 apart: bool = False) -> DataFrame:
    """Per document: the columns of ``carry`` (the id), n_bytes, n_removed, n_spans, kept_sha256.

    real=True: carried columns in a struct ``row``, the removed spans (start, end in
    bytes) and the bytes kept instead of their digest.  texts=True: the carried columns
    in ``row`` and the kept text only; a character that loses some bytes goes with them.
    apart=True: each round is a job of its own that keeps its bitmaps and drops what it shuffled; the blocks
    are dealt out once a round, but only one round's data lie on the disks at a time.
    """
    done_with = cut_and_free if apart else (lambda df: df)
    ship(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    n_blocks = max(1, math.ceil(total / BLOCK_BYTES))
    blocks = (cut_and_free if apart else cut)(_texts_to_blocks(docs, id_col, text_col, carry or [id_col], n_blocks))
    release(docs.sparkSession)
    blocks = blocks.join(_whole_copies(blocks), "block", "left").select("block", "rows", "sizes", "data", "dead")
    n_ranges = _ranges(int(total * len(COVER) / MODULUS))
    low = 64 - NAME_BITS - n_ranges
    fields = "range int, block long, data binary"

    def out(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        c = list(zip(*rows)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c[0], pa.int32()), pa.array(c[1], pa.int64()),
                                           pa.array(c[2], pa.binary())], names=["range", "block", "data"])

    @tidy
    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for j in range(len(batch)):
                row = batch.slice(j, 1).drop_columns(["rows"]).to_pylist()[0]
                b = _open(row)
                yield out(list(_send(row["block"], b.names(b.sample()), n_ranges, low)))

    # blocks are few and large: one to a batch
    twice = done_with(_judge(blocks.mapInArrow(sampled, fields), later=False))
    marked = blocks.join(twice, "block", "left").select("block", "rows", "sizes", "data", "dead", "marks")
    second = _ranges(total // 4)

    @tidy
    def remaining(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for j in range(len(batch)):
                row = batch.slice(j, 1).drop_columns(["rows"]).to_pylist()[0]
                b = _open(row)
                at = b.candidates(*_sampled_twice(b, low, row["marks"]))
                yield out(list(_send(row["block"], b.window_names(at), second, 0)))

    later = done_with(_judge(marked.mapInArrow(remaining, fields), later=True))
    both = marked.join(later.withColumnRenamed("marks", "later"), "block", "left")
    tail = [("n_bytes", T.LongType(), pa.int64()), ("n_removed", T.LongType(), pa.int64()),
            ("n_spans", T.LongType(), pa.int64())]
    tail += [("spans", T.ArrayType(T.ArrayType(T.LongType())), pa.list_(pa.list_(pa.int64()))),
             ("kept", T.BinaryType(), pa.binary())] if real else [("kept_sha256", T.StringType(), pa.string())]
    if texts:
        tail = [("text", T.StringType(), pa.string())]
    schema = T.StructType([T.StructField("row", blocks.schema["rows"].dataType.elementType),
                           *[T.StructField(n, t) for n, t, _ in tail]])

    @tidy
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for j in range(len(batch)):  # one block in memory at a time
                held = batch.column("rows")[j].values
                row = batch.slice(j, 1).drop_columns(["rows"]).to_pylist()[0]
                b = _open(row)
                at = _repeats(b, low, row)
                b.sums = None
                where = np.searchsorted(at, np.concatenate([[0], b.ends]))
                first = size = 0
                out_rows: list[list] = []
                for k, (e, n) in enumerate(zip(b.ends.tolist(), b.sizes.tolist())):
                    own = b.data[e - n:e]
                    spans = [[0, n]] if b.dead[k] and n >= LENGTH else _spans(at[where[k]:where[k + 1]] - (e - n))
                    kept = _without(own, spans)
                    if texts:
                        out_rows.append([kept.decode("utf-8", "ignore")])
                    else:
                        out_rows.append([n, n - len(kept), len(spans),
                                         *([spans, kept] if real else [hashlib.sha256(kept).hexdigest()])])
                    size += n
                    if size > SLICE_BYTES or k == len(b.sizes) - 1:
                        cols = [pa.array(c, t) for c, (_, _, t) in zip(zip(*out_rows), tail)]
                        yield pa.RecordBatch.from_arrays([held.slice(first, len(out_rows)), *cols], names=schema.names)
                        first, size, out_rows = k + 1, 0, []

    done = both.select("block", "rows", "sizes", "data", "dead", "marks", "later").mapInArrow(finish, schema)
    return done if real or texts else done.select("row.*", *[n for n, _, _ in tail])


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with their repeats removed, all other columns as they were.

    A character that loses some of its bytes goes with them.
    """
    others = [c for c in docs.columns if c != text_col]
    out = find_repeats(docs, id_col, text_col, others or [id_col], texts=True)
    return out.select(*[F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
