"""Exact top-k by inner product: a ball tree per shard, branch and bound.

Vectors are quantised to integers and dealt to shards by a hash of the id.  A
task searches one block of queries in one shard: nodes wait in a queue ordered by
their upper bound q.c + |q| r, a leaf is scored with one matrix product, and a
node is left out for every query whose k-th score so far lies above the bound.
The k-th scores of a first pass over one shard travel with the query blocks into
all other shards, so these start with a bound that already cuts.

The query set (ids divisible by ``every``) meets all rows block by block; each
pair of blocks is one row of a join on the shard, and only scores at or above
the shared k-th one leave it.

Nulls and edge cases: vectors that are null or hold null or non-finite
components take no part, nor do rows without an id; rows that share an id are one
vector (the least); vectors meet only those of their own length; fewer than k
candidates give all of them; ties go to the smaller id.  Scores must fit 64 bits.
Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import cut, ship, tidy

K = 5
EVERY = 50
SCALE = 256
SHARD = 4096
LEAF = 128
#: Shards whose queries form one block.
TOGETHER = 8


class BallTree:
    """Nodes over rows of ``v`` (ordered by id); leaves are ranges of ``order``."""

    def __init__(self, v: np.ndarray):
        self.v = v.astype(np.float64)
        self.order = np.arange(len(v))
        self.nodes: list[tuple[np.ndarray, float, int, int, int, int]] = []
        self._build(0, len(v))

    def _build(self, a: int, b: int) -> int:
        rows = self.v[self.order[a:b]]
        centre = rows.mean(0)
        radius = float(np.sqrt(((rows - centre) ** 2).sum(1).max()))
        me = len(self.nodes)
        self.nodes.append((centre, radius, a, b, -1, -1))
        if b - a > LEAF and radius > 0:
            far = rows[((rows - centre) ** 2).sum(1).argmax()]
            other = rows[((rows - far) ** 2).sum(1).argmax()]
            side = np.argsort(rows @ (other - far), kind="stable")
            self.order[a:b] = self.order[a:b][side]
            mid = (a + b) // 2
            self.nodes[me] = (centre, radius, a, b, self._build(a, mid), self._build(mid, b))
        return me


def _scores(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Integer inner products, exact: through doubles where these hold them, else in 64 bits."""
    if not v.size or not q.size:
        return np.zeros((len(q), len(v)), np.int64)
    if np.abs(v).max() * np.abs(q).max() * v.shape[1] < 2.0 ** 52:
        return (q.astype(np.float64) @ v.astype(np.float64).T).astype(np.int64)
    exact = q.astype(object) @ v.astype(object).T
    if exact.size and max(abs(int(exact.max())), abs(int(exact.min()))) >= 2 ** 63:
        raise OverflowError("an inner product does not fit 64 bits")
    return exact.astype(np.int64)


def search(tree: BallTree, v: np.ndarray, ids: np.ndarray, q: np.ndarray, q_ids: np.ndarray, k: int,
           kth: np.ndarray) -> list[list[tuple[int, int]]]:
    """Per query its best (score, id) in this shard, at or above its kth score; kth is raised in place."""
    best: list[list[tuple[int, int]]] = [[] for _ in q_ids]
    norms = np.sqrt((q.astype(np.float64) ** 2).sum(1))
    qf = q.astype(np.float64)

    def bounds(node: int) -> np.ndarray:
        centre, radius = tree.nodes[node][:2]
        x = qf @ centre + norms * radius
        return x + 1e-6 * (1 + np.abs(x))  # rounding never hides a candidate

    first = bounds(0)
    queue = [(-first.max(), 0, first)]
    while queue:
        top, node, bound = heapq.heappop(queue)
        live = np.flatnonzero(bound >= kth)
        if not len(live):
            continue
        _, _, a, b, left, right = tree.nodes[node]
        if left >= 0:
            for child in (left, right):
                x = bounds(child)
                if (x >= kth).any():
                    heapq.heappush(queue, (-x[x >= kth].max(), child, x))
            continue
        rows = tree.order[a:b]
        s = _scores(v[rows], q[live])
        keep = (s >= kth[live][:, None]) & (ids[rows][None, :] != q_ids[live][:, None])
        for x in np.flatnonzero(keep.any(1)).tolist():
            at = np.flatnonzero(keep[x])
            if len(at) > 4 * k:  # all that reach the k-th best of this leaf
                at = at[s[x][at] >= np.partition(s[x][at], len(at) - k)[len(at) - k]]
            me = live[x]
            found = best[me] + [(int(s[x][j]), int(ids[rows[j]])) for j in at.tolist()]
            found.sort(key=lambda p: (-p[0], p[1]))
            best[me] = found[:k]
            if len(best[me]) == k:
                kth[me] = max(kth[me], best[me][-1][0])
    return best


def _shards(vectors: DataFrame, shard: int) -> DataFrame:
    """(dim, shard, shards, ids, vecs): one row a shard, ids ascending, vectors as 64-bit integers."""
    fine = vectors.where("vec_id is not null and embedding is not null").where(
        F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    fine = fine.select(F.col("vec_id").cast("long").alias("vec_id"), F.size("embedding").alias("dim"), F.transform(
        "embedding", lambda x: F.floor(x.cast("double") * SCALE)).alias("v"))
    sizes = fine.groupBy("dim").agg(F.ceil(F.count("*") / shard).cast("int").alias("shards"))
    dealt = fine.join(sizes, "dim").withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.col("shards")).cast("int"))

    def build(key: tuple, g: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        ids = g.column("vec_id").to_numpy()
        flat = g.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), dim)
        order = np.lexsort([*flat.T[::-1], ids])
        ids, flat = ids[order], flat[order]
        new = np.diff(ids, prepend=ids[0] - 1) != 0 if len(ids) else np.zeros(0, bool)
        return pa.table({"dim": pa.array([dim], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int32()),
                         "shards": pa.array([g.column("shards")[0].as_py()], pa.int32()),
                         "ids": pa.array([ids[new].astype(np.int64).tobytes()], pa.binary()),
                         "vecs": pa.array([flat[new].astype(np.int64).tobytes()], pa.binary())})

    return dealt.groupBy("dim", "shard").applyInArrow(build, "dim int, shard int, shards int, ids binary, vecs binary")


def _arrays(ids: bytes, vecs: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, np.int64)
    return i, np.frombuffer(vecs, np.int64).reshape(len(i), dim)


def _queries(shards: DataFrame, every: int) -> DataFrame:
    """(dim, block, shards, q_ids, q_vecs): the queries of ``TOGETHER`` shards a row."""

    def collect(key: tuple, g: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        parts = [_arrays(i, v, dim) for i, v in zip(g.column("ids").to_pylist(), g.column("vecs").to_pylist())]
        chosen = [(i[i % every == 0], v[i % every == 0]) for i, v in parts]
        ids = np.concatenate([c[0] for c in chosen])
        vecs = np.concatenate([c[1] for c in chosen])
        return pa.table({"dim": pa.array([dim], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32()),
                         "shards": pa.array([g.column("shards")[0].as_py()], pa.int32()),
                         "q_ids": pa.array([ids.tobytes()], pa.binary()), "q_vecs": pa.array([vecs.tobytes()], pa.binary())})

    mine = shards.withColumn("block", F.expr(f"shard div {TOGETHER}").cast("int"))
    return mine.groupBy("dim", "block").applyInArrow(
        collect, "dim int, block int, shards int, q_ids binary, q_vecs binary").where(F.octet_length("q_ids") > 0)


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, shard: int = SHARD) -> DataFrame:
    """(query_id, rank, vec_id, score) for every query; vectors: (vec_id, embedding)."""
    ship(vectors.sparkSession)
    shards = cut(_shards(vectors, shard))
    queries = cut(_queries(shards, every))
    lowest = np.iinfo(np.int64).min

    def pairs(blocks: DataFrame) -> DataFrame:
        return blocks.join(shards.drop("shards"), ["dim", "shard"]).select(
            "dim", "shard", "block", "q_ids", "q_vecs", "kth", "ids", "vecs")

    def run(bound_only: bool):
        @tidy
        def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last, tree, ids, v = None, None, None, None
            for batch in batches:
                for r in batch.to_pylist():
                    if last != (r["dim"], r["shard"]):
                        last = (r["dim"], r["shard"])
                        ids, v = _arrays(r["ids"], r["vecs"], r["dim"])
                        tree = BallTree(v)
                    q_ids, q = _arrays(r["q_ids"], r["q_vecs"], r["dim"])
                    kth = (np.full(len(q_ids), lowest) if r["kth"] is None else np.frombuffer(r["kth"], np.int64).copy())
                    best = search(tree, v, ids, q, q_ids, k, kth)
                    if bound_only:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([r["dim"]], pa.int32()), pa.array([r["block"]], pa.int32()),
                             pa.array([kth.tobytes()], pa.binary())], names=["dim", "block", "kth"])
                    else:
                        rows = [(int(i), s, x) for i, b in zip(q_ids, best) for s, x in b]
                        c = list(zip(*rows)) or [(), (), ()]
                        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in c],
                                                         names=["query_id", "score", "vec_id"])
        return inner

    pilot = queries.withColumn("shard", F.lit(0)).withColumn("kth", F.lit(None).cast("binary"))
    kth = pairs(pilot).mapInArrow(run(True), "dim int, block int, kth binary")
    spread = queries.join(kth, ["dim", "block"], "left").withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    found = pairs(spread).mapInArrow(run(False), "query_id long, score long, vec_id long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
