"""Near-duplicate documents by circulant MinHash, confirmed on full shingle sets.

Signature: a first permutation scatters a shingle over 2 ** 20 places; a second
permutation of the places, shifted circularly by k, gives coordinate k.  The K
coordinates of a shingle are K neighbours in the second permutation's table, so
a document's signature is one running minimum over table slices.

Links, without pairing off groups:
1. Documents of equal shingle sets form a class; the class is one node.
2. ``BANDS`` x ``ROWS`` banding (a pair of similarity 0.75 shares a band but for
   2.5e-7 of cases).  In each bucket every node is paired with the least node: a
   star, linear in the bucket.  Pairs whose signatures agree in under ``LEAST``
   of the coordinates are dropped (0.75 lies 4.4 deviations above), the others
   are confirmed on the full sets.  Confirmed links give components.
3. Buckets that still hold several components may hide links that miss the centre.
   Their components are held against each other exactly, in blocks, with a bound
   that needs only each set's overlap with the centre (``_rest``); one confirmed
   link a pair of components leaves a block, never a list of pairs.

Nulls and edge cases: words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a
text of under five words is one shingle; a text without words (or null) has the
empty set and is linked with nothing.  A row without id links with nothing, has
a null component and is kept.  Rows that share an id are one document.  Whole
texts are read.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import cut, ship, tidy, tidy_group
from kestrel.llm.components import components
from kestrel.llm.hashing import mix, shingle_sets

SHINGLE = 5
PERCENT = 75
BANDS, ROWS = 40, 4
LEAST = 0.60
#: Shingles a block of the last step, at about.
BLOCK = 400_000
_PLACES = 1 << 20
_SIGMA = np.uint64(0x5851F42D4C957F2D)


class Circulant:
    """Both permutations, and signatures of shingle sets."""

    def __init__(self, k: int):
        table = np.random.default_rng(42).permutation(_PLACES).astype(np.uint32)
        self.slices = np.lib.stride_tricks.sliding_window_view(np.concatenate([table, table[:k]]), k)
        self.k = k

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        places = (mix(shingles ^ _SIGMA) >> np.uint64(44)).astype(np.int64)
        out = np.full(self.k, _PLACES, np.uint32)
        for a in range(0, len(places), 4096):
            np.minimum(out, self.slices[places[a:a + 4096]].min(0), out=out)
        return out


def sketch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, digest of the set, bands, sig: low bytes of the coordinates)."""
    ship(docs.sparkSession)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = Circulant(BANDS * ROWS)
        salt = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for batch in batches:
            n, digest, bands, sig = [], [], [], []
            for s in shingle_sets(batch.column("t").to_pylist(), SHINGLE):
                n.append(len(s))
                if not len(s):
                    digest.append(None), bands.append(None), sig.append(None)
                    continue
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                x = c.signature(s)
                h = salt.copy()
                for k in range(ROWS):
                    h = mix(h * np.uint64(31) + x[k::ROWS])
                bands.append(h.view(np.int64))
                sig.append(x.astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("i"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(sig, pa.binary())],
                names=["id", "n_shingles", "digest", "bands", "sig"])

    return docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).mapInArrow(
        run, "id long, n_shingles long, digest binary, bands array<long>, sig binary")


def _agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(-1)


def _promising(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sizes and signatures allow the similarity."""
    s = nodes.select("id", "n", "sig")
    p = pairs.join(s.toDF("a", "na", "sa"), "a").join(s.toDF("b", "nb", "sb"), "b")
    p = p.where("100 * least(na, nb) >= %d * greatest(na, nb)" % PERCENT)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(b.num_rows, -1)
                    for c in ("sa", "sb"))
            yield b.select(["a", "b"]).filter(pa.array(_agree(x, y) >= LEAST))

    return p.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _confirm(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs (u, v) whose full shingle sets are similar enough; docs: (id, text) of all nodes."""
    wanted = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    texts = cut(docs.join(wanted, "id", "left_semi"))
    p = pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int, np.ndarray] | None = None
        for batch in batches:
            ids, u, v = batch.column("b").to_pylist(), [], []
            mine = shingle_sets(batch.column("ta").to_pylist(), SHINGLE)
            for k, (a, x) in enumerate(zip(batch.column("a").to_pylist(), mine)):
                if last is None or last[0] != ids[k]:  # a centre's rows come together
                    last = (ids[k], next(shingle_sets([batch.column("tb")[k].as_py()], SHINGLE)))
                y = last[1]
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= PERCENT * (len(x) + len(y) - both):
                    u.append(a), v.append(ids[k])
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return p.select("a", "b", "ta", "tb").mapInArrow(run, "u long, v long")


def _stars(buckets: DataFrame) -> DataFrame:
    """Pairs of each bucket's members with its least member."""
    centre = buckets.groupBy("key").agg(F.min("id").alias("b"))
    return buckets.join(centre, "key").where("id != b").select(F.col("id").alias("a"), "b").distinct()


def _open(buckets: DataFrame, comp: DataFrame | None) -> DataFrame:
    """(key, id, component) of buckets that hold more than one component."""
    m = buckets if comp is None else buckets.join(comp.toDF("id", "component"), "id", "left")
    m = m.withColumn("component", F.col("id") if comp is None else F.coalesce("component", "id"))
    many = m.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n"))
    # two members have met as centre and member already
    return m.join(many.where("lo != hi and n > 2").select("key"), "key", "left_semi")


def _rest(members: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (u, v) between components that share a bucket and are still apart; at most one a pair of
    components and block.

    members: (key, id, component) of the open buckets.  All buckets with the same
    least member (the hub) form one group, so a pair that shares many buckets is
    looked at once.  Rows outside a group's largest component are dealt to blocks
    of about ``BLOCK`` shingles, and each block meets every part of the group.
    Inside a block a pair (y, z) is dismissed without touching its sets when its
    intersection cannot be large enough: it is at most
    min(|y & hub|, |z & hub|) + |(y - hub) & (z - hub)|, and the last term is
    counted with an index of the few shingles that the hub lacks.
    """
    hubs = members.groupBy("key").agg(F.min("id").alias("hub"))
    m = members.join(hubs, "key").select("hub", "id", "component").distinct()
    m = m.join(nodes.select("id", "n"), "id")
    by = m.groupBy("hub", "component").agg(F.count("*").alias("rows"), F.sum("n").alias("shingles"))
    groups = by.groupBy("hub").agg(
        F.max(F.struct("rows", "component"))["component"].alias("major"), F.sum("rows").alias("all"),
        F.sum("shingles").alias("total"), F.max(F.struct("rows", "component", "shingles"))["shingles"].alias("most"))
    groups = groups.where("all > 2").select(
        "hub", "major", F.ceil(F.col("total") / BLOCK).cast("int").alias("parts"),
        F.greatest(F.ceil((F.col("total") - F.col("most")) / BLOCK), F.lit(1)).cast("int").alias("blocks"))
    m = cut(m.join(groups, "hub"))
    h = F.xxhash64("id")
    every = m.select("hub", "id", "component", F.lit(False).alias("mine"), F.pmod(h, "parts").cast("int").alias("p"),
                     F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("q"))
    minor = m.where("component != major").select(
        "hub", "id", "component", F.lit(True).alias("mine"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("p"), F.pmod(F.hash("id"), "blocks").cast("int").alias("q"))
    centre = every.select("hub", "p", "q").distinct().select(
        "hub", F.col("hub").alias("id"), F.lit(None).cast("long").alias("component"), F.lit(False).alias("mine"), "p", "q")
    rows = every.unionByName(minor).unionByName(centre)
    wanted = cut(texts.join(m.select("id").distinct(), "id", "left_semi"))

    @tidy_group
    def run(key: tuple, g: pa.Table) -> pa.Table:
        ids, comp = (g.column(c).to_pylist() for c in ("id", "component"))
        mine = g.column("mine").to_pylist()
        sets = list(shingle_sets(g.column("t").to_pylist(), SHINGLE))
        hub = next(x for x, c in zip(sets, comp) if c is None)
        z = [k for k, c in enumerate(comp) if c is not None and not mine[k]]
        inside = [np.isin(x, hub, assume_unique=True) for x in sets]
        size = np.array([len(x) for x in sets])
        with_hub = np.array([int(x.sum()) for x in inside])
        zi = np.array(z, np.int64)
        z_size, z_hub = size[zi], with_hub[zi]
        rest = [sets[k][~inside[k]] for k in z]
        flat = np.concatenate(rest) if rest else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(z)), [len(x) for x in rest])
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        root: dict[int, int] = {}

        def find(c: int) -> int:
            while root.get(c, c) != c:
                c = root[c]
            return c

        u, v = [], []
        for y in (k for k, own in enumerate(mine) if own):
            x = sets[y][~inside[y]]
            lo, hi = np.searchsorted(flat, x, "left"), np.searchsorted(flat, x, "right")
            shared = np.zeros(len(z), np.int64)
            for a, b in zip(lo.tolist(), hi.tolist()):
                if a < b:
                    shared[owner[a:b]] += 1
            most = np.minimum(z_hub, with_hub[y]) + shared
            near = np.flatnonzero((100 + PERCENT) * most >= PERCENT * (z_size + size[y]))
            for k in near[np.argsort(-most[near], kind="stable")].tolist():
                j = z[k]
                c, d = find(comp[y]), find(comp[j])
                if c == d:
                    continue
                both = len(np.intersect1d(sets[y], sets[j], assume_unique=True))
                if 100 * both >= PERCENT * (size[y] + size[j] - both):
                    root[max(c, d)] = min(c, d)
                    u.append(ids[y]), v.append(ids[j])
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return rows.join(wanted, "id").groupBy("hub", "p", "q").applyInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_shingles, component_id, kept) for every row of ``docs``."""
    rows = cut(sketch(docs, id_col, text_col))
    some = rows.where("digest is not null and id is not null")
    # one node a set: the least id; of rows that share an id any text will do, links go by id
    nodes = cut(some.groupBy("digest").agg(
        F.min("id").alias("id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"),
        F.first("sig").alias("sig")))
    keys = nodes.select("id", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").count().where("count > 1").select("key")
    buckets = cut(keys.join(shared, "key").select("key", "id"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    alone = F.col("id").alias("component")
    pairs = cut(_promising(_stars(buckets), nodes))
    edges = comp = None
    if not pairs.isEmpty():
        edges = cut(_confirm(pairs, texts))
        comp = cut(components(edges))
    open_ = cut(_open(buckets, comp))
    if not open_.isEmpty():
        more = cut(_rest(open_, nodes, texts))
        if not more.isEmpty():
            edges = more if edges is None else edges.unionByName(more)
            comp = cut(components(edges))
    # rows of one id with several sets are one document: their classes meet in it
    classes = nodes.select(F.col("digest"), F.col("id").alias("rep"))
    links = some.select("id", "digest").join(classes, "digest").select(F.col("id").alias("u"), F.col("rep").alias("v"))
    repeated = some.groupBy("id").agg(F.min("digest").alias("x"), F.max("digest").alias("y")).where("x != y")
    if not repeated.isEmpty():
        more = links.join(repeated.select(F.col("id").alias("u")), "u", "left_semi").where("u != v")
        edges = more if edges is None else edges.unionByName(more)
        comp = cut(components(edges))
    out = rows.select("id", "n_shingles", "digest").join(classes, "digest", "left")
    if comp is not None:
        out = out.join(comp.toDF("rep", "component"), "rep", "left")
    else:
        out = out.withColumn("component", F.lit(None).cast("long"))
    out = out.withColumn("component_id", F.when(F.col("id").isNotNull(), F.coalesce("component", "rep", "id")))
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are kept, with all their columns."""
    found = near_duplicates(docs, id_col, text_col).where("kept").select(F.col(id_col).alias("_kept")).distinct()
    return docs.join(found, docs[id_col].cast("long").eqNullSafe(found["_kept"]), "left_semi")
