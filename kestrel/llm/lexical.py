"""Ranked lexical search: the best documents of every item, by branch and bound over FP-trees.

One pass reads the texts and keeps, per document, its number of terms and the
occurrences of the terms that the items ask for; from these come the corpus
statistics and the terms' order by frequency.  A second pass builds FP-trees over
bounded runs of these vectors and searches each for all items (``fptree``); the
k-th scores found so far go on to the next tree of the task.  Every task returns at most
k documents an item; these are ranked first in slices of an item, then per item.

Items are taken in blocks of about ``BLOCK`` (item, term) pairs: the only data that is sent to
all tasks.  An item with more terms is a block of its own.

Nulls and edge cases: a null or empty text has no terms; such documents count
nowhere and are never found.  Items without terms, or whose terms no document
holds, have no rows.  Rows of ``items`` with equal ids are one item with the terms
of all of them.  Repeated documents are ranked each on its own; equal scores go by
ascending id, a null id last.  Empty tables give no rows.  Only the named columns are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import cut, ship, tidy
from kestrel.llm.fptree import Best, Items, Tree

#: A term: letters and digits of ASCII, and all characters beyond it.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: (item, term) pairs that one pass looks for, at about.
BLOCK = 1 << 18
#: Vector entries of one tree, at about: some 30 MB with its sorting space.
TREE = 1 << 19
#: Slices in which an item's candidates are ranked before they meet.
SLICES = 64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Byte by byte: A-Z to lower case, what ends a term to a space.
_FOLD = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return text.translate(_FOLD).split() if text else []


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, term): every term of an item once."""
    folded = F.translate(F.coalesce(F.col(text_col), F.lit("")), _UPPER, _LOWER)
    return items.select(F.col(id_col).alias("item"), F.explode(F.array_distinct(
        F.regexp_extract_all(folded, F.lit(TERM), F.lit(0)))).alias("term")).distinct()


def vectors(docs: DataFrame, vocabulary: list[str], id_col: str, text_col: str) -> DataFrame:
    """(id, n, term, tf): number of terms, and occurrences of those in ``vocabulary`` by their places."""
    ship(docs.sparkSession)
    place = {t.encode("utf-8"): i for i, t in enumerate(vocabulary)}

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n, found = [], [], []
            keys = batch.column("id").to_pylist()
            for k, text in enumerate(batch.column("t").cast(pa.binary())):
                words = terms(text.as_py())
                if words:
                    count = Counter(map(place.get, words))
                    count.pop(None, None)
                    ids.append(keys[k])
                    n.append(len(words))
                    found.append(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.column("id").type), pa.array(n, pa.int64()),
                 pa.array([list(c) for c in found], pa.list_(pa.int32())),
                 pa.array([list(c.values()) for c in found], pa.list_(pa.int64()))], names=["id", "n", "term", "tf"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(
        run, f"id {kind}, n long, term array<int>, tf array<long>")


def _candidates(vecs: DataFrame, asked: list[list[int]], order: np.ndarray, weight: np.ndarray, n_items: int,
                corpus: tuple[int, int], k: int) -> DataFrame:
    """(block_item, id, score): the k best documents of each task for every item.

    ``order[place]`` is the rank of a vocabulary term by frequency; ``asked`` and ``weight`` go by rank.
    """
    docs_n, terms_n = corpus

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, best = Items(weight, asked, n_items), Best(n_items, k)
        held, entries, kind = [], 0, None

        def flush() -> None:
            ids = [x for b in held for x in b[0]]
            if ids:
                n, size, place, tf = (np.concatenate([b[j] for b in held]) for j in (1, 2, 3, 4))
                m = np.array([10 + 90 * int(x) * docs_n // terms_n for x in n], dtype=np.int64)
                Tree(ids, m, size, order[place], tf).search(items, best)
            held.clear()

        for batch in batches:
            kind = batch.column("id").type
            for a in range(0, len(batch), 256):
                part = batch.slice(a, 256)
                t, f = part.column("term"), part.column("tf")
                size = np.diff(t.offsets.to_numpy()).astype(np.int64)
                held.append((part.column("id").to_pylist(), part.column("n").to_numpy(), size,
                             t.flatten().to_numpy().astype(np.int64), f.flatten().to_numpy()))
                entries += int(size.sum())
                if entries > TREE:
                    flush()
                    entries = 0
        flush()
        if kind is not None:
            rows = [(i, None if none else doc, -s) for i, found in enumerate(best.rows) for s, none, doc in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], kind),
                 pa.array([r[2] for r in rows], pa.int64())], names=["block_item", "id", "score"])

    kind = vecs.schema["id"].dataType.simpleString()
    return vecs.where(F.size("term") > 0).mapInArrow(run, f"block_item int, id {kind}, score long")


def _best(rows: DataFrame, keys: list, k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_col, rank, id_col, score): the k best documents of every item with a score above 0."""
    spark = docs.sparkSession
    pairs = cut(item_terms(items, item_col, item_text))
    item_type, id_type = pairs.schema["item"].dataType, docs.schema[id_col].dataType
    blocks = max(1, -(-pairs.count() // BLOCK))
    found = None
    for b in range(blocks):
        block = pairs.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect()
        number = {item: j for j, item in enumerate(dict.fromkeys(r["item"] for r in block))}
        vocabulary = sorted({r["term"] for r in block})
        vecs = cut(vectors(docs, vocabulary, id_col, text_col))
        docs_n, terms_n = vecs.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not docs_n or not vocabulary:
            continue
        df = np.zeros(len(vocabulary), dtype=np.int64)
        for r in vecs.select(F.explode("term").alias("t")).groupBy("t").count().collect():
            df[r["t"]] = r["count"]
        by_rank = np.lexsort((np.arange(len(df)), -df))
        order = np.empty(len(df), dtype=np.int64)
        order[by_rank] = np.arange(len(df))
        weight = np.array([math.floor(1000 * math.log((2 * docs_n + 2) / (2 * int(df[p]) + 1))) for p in by_rank])
        place, asked = {t: i for i, t in enumerate(vocabulary)}, [[] for _ in vocabulary]
        for r in block:
            asked[order[place[r["term"]]]].append(number[r["item"]])
        rows = _candidates(vecs, asked, order, weight, len(number), (docs_n, int(terms_n)), k)
        rows = _best(rows, ["block_item", F.pmod(F.xxhash64("id"), F.lit(SLICES))], k).drop("rank")
        names = spark.createDataFrame([(j, i) for i, j in number.items()], f"block_item int, item {item_type.simpleString()}")
        rows = _best(rows, ["block_item"], k).join(names, "block_item").select(
            F.col("item").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        return spark.createDataFrame([], f"`{item_col}` {item_type.simpleString()}, rank int, "
                                         f"`{id_col}` {id_type.simpleString()}, score long")
    return found
