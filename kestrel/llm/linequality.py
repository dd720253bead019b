"""Document quality from line labels of a conditional random field.

Every line with a word is measured (length, symbols, capitals, repeated and
frequent words, equal lines of the document ...) and each measure put in one of
eight bins.  A linear-chain random field (``crf``) labels the lines good or bad from
the bins of the line, of the one before and of the one after; its
forward-backward marginals, weighted by the lines' lengths, are the document's score.

The field learns from at most ``TEACH`` labelled documents of each class, those
whose ids hash lowest; all lines of one have its label, and both classes count
alike.  Only bins travel: the taught documents stay spread over the cluster and
every step of the descent sums gradients there.  All documents are scored.

Nulls and edge cases: a null, empty or blank text is one line without words and
gets the score of such a line.  Texts of any length are read whole.  Labels other
than 0 and 1, null ids and ids with both labels do not teach.  Without documents of both classes
every score is the share of label 1 (0.5 without any label).  Repeated documents
score alike, and all of their rows teach.  Only the named columns are read.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm import crf
from kestrel.llm.common import cut, ship, tidy
from kestrel.llm.hashing import chunks
from kestrel.llm.quality import STOP_WORDS

#: Labelled documents of each class that teach, at most.
TEACH = 2000
#: Steps of the descent, and the weight of the squared weights in the loss, per document.
STEPS, RIDGE = 25, 1e-4
#: A document with this score is predicted good.
THRESHOLD = 0.3
#: Bytes of text measured at a time, at about.
GROUP = 1 << 20
_STOP = frozenset(STOP_WORDS)

#: Measures of a line with the borders of their bins.
EDGES = {
    "words": (0.5, 1.5, 3.5, 8.5, 16.5, 40.5, 120.5),
    "word_chars": (2, 3, 4, 5, 6.5, 9, 14),
    "symbols_per_word": (0.001, 0.02, 0.1, 0.3, 0.8, 1.5, 2.5),
    "exclamations_per_word": (0.001, 0.03, 0.1, 0.3, 0.8, 1.2, 2.5),
    "bars_per_word": (0.001, 0.02, 0.05, 0.15, 0.3, 0.5, 0.9),
    "capital_words": (0.001, 0.05, 0.1, 0.3, 0.5, 0.8, 0.95),
    "digits_per_char": (0.001, 0.01, 0.03, 0.08, 0.2, 0.4, 0.7),
    "distinct_words": (0.1, 0.25, 0.4, 0.55, 0.7, 0.85, 0.97),
    "repeats_of_last_word": (0.001, 0.03, 0.08, 0.2, 0.4, 0.6, 0.9),
    "frequent_words": (0.001, 0.05, 0.12, 0.2, 0.3, 0.45, 0.7),
    "stops_per_word": (0.001, 0.03, 0.08, 0.15, 0.3, 0.6, 0.95),
    "equal_lines": (1.5, 2.5, 3.5, 5.5, 9.5, 20.5, 50.5),
    "words_of_letters": (0.05, 0.2, 0.4, 0.6, 0.75, 0.9, 0.98),
}
assert all(len(e) == crf.BINS - 1 for e in EDGES.values())


def lines(text: str | None) -> list[str]:
    """Lines with a word; one empty line where there is none."""
    return [x for x in (text or "").split("\n") if x and not x.isspace()] or [""]


def measure(line: str, equal: int) -> tuple[float, ...]:
    """The measures of EDGES, in order; ``equal`` counts the document's lines that equal this one."""
    words = line.split()
    n, count = len(words), line.count
    if not n:
        return (0.0,) * len(EDGES)
    chars = sum(map(len, words))
    return (
        n, chars / n, sum(map(count, "#*$%&<>")) / n, count("!") / n, count("|") / n, sum(map(str.isupper, words)) / n,
        sum(map(count, "0123456789")) / chars, len(set(words)) / n, sum(map(operator.eq, words, words[1:])) / n,
        sum(map(_STOP.__contains__, line.lower().split())) / n, sum(map(count, ".,;:?")) / n, equal,
        sum(map(str.isalpha, words)) / n)


def bins(texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per text: the (lines, measures) matrix of bins and the lines' lengths."""
    rows, sizes, lengths = [], [], []
    for t in texts:
        own = lines(t)
        equal = Counter(own)
        rows += [measure(x, equal[x]) for x in own]
        sizes.append(len(own))
        lengths.append(np.array([max(1, len(x)) for x in own], dtype=np.float64))
    if not rows:
        return [], []
    table = np.array(rows, dtype=np.float64)
    out = np.stack([np.searchsorted(e, table[:, j], side="right") for j, e in enumerate(EDGES.values())],
                   axis=1).astype(np.uint8)
    return np.split(out, np.cumsum(sizes)[:-1]), lengths


def held_out(row_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(row_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def taught(docs: DataFrame, labels: DataFrame, teach: int, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(label, bins): the documents that teach, as matrices of bins."""
    ship(docs.sparkSession)
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where(
        "label IN (0, 1) AND id IS NOT NULL").where(~held_out(F.col("id")))
    known = known.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most")
    known = known.join(docs.select(F.col(id_col).alias("id")).where("id IS NOT NULL").distinct(), "id", "left_semi")
    first = [known.where(F.col("label") == y).orderBy(F.xxhash64("id"), "id").limit(teach) for y in (0, 1)]
    chosen = F.broadcast(first[0].unionByName(first[1]).select("id", "label"))  # at most 2 * teach rows

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, _ = bins(b.column("t").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column("label"), pa.array([x.tobytes() for x in found], pa.binary())], names=["label", "bins"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).join(chosen, "id")
    return rows.select("label", "t").mapInArrow(run, "label int, bins binary")


def fit(docs: DataFrame, labels: DataFrame, teach: int = TEACH, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality") -> tuple[np.ndarray | None, float]:
    """Weights of the field (None: nothing to learn from) and the share of label 1 among the rows that may teach."""
    may = labels.where(~held_out(F.col(id_col)) & F.col(label_col).isin(0, 1)).agg(
        F.count(F.lit(1)), F.sum(F.col(label_col).cast("long"))).first()
    share = may[1] / may[0] if may[0] else 0.5
    rows = cut(taught(docs, labels, teach, id_col, text_col, label_col).repartition(8))
    n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(n) < 2:
        return None, share
    total = sum(n.values())
    weight = {y: total / (2 * k) for y, k in n.items()}
    measures = len(EDGES)

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        @tidy
        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if len(b):
                    found = [np.frombuffer(x, np.uint8).reshape(-1, measures) for x in b.column("bins").to_pylist()]
                    y = b.column("label").to_numpy()
                    value, grad = crf.Batch(found).loss(w, y, np.where(y == 1, weight[1], weight[0]))
                    yield pa.RecordBatch.from_arrays([pa.array([[value, *grad]], pa.list_(pa.float64()))], names=["g"])

        g = np.sum([np.array(r["g"]) for r in rows.mapInArrow(part, "g array<double>").collect()], axis=0)
        return float(g[0] / total + RIDGE * w @ w), g[1:] / total + 2 * RIDGE * w

    return crf.minimise(loss, np.zeros(crf.n_weights(measures)), STEPS), share


def score(docs: DataFrame, weights: np.ndarray | None, share: float, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(id_col, score, n_lines, n_bad): length-weighted marginals, and lines that are rather bad."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("t")
            size = [len(x) if x else 0 for x in column.cast(pa.binary()).to_pylist()]
            for a, b in chunks(size, GROUP):
                found, lengths = bins(column.slice(a, b - a).to_pylist())
                if weights is None:
                    good = [np.full(len(x), share) for x in found]
                else:
                    good = crf.Batch(found).marginals(weights)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("i").slice(a, b - a),
                     pa.array([round(min(1.0, max(0.0, float(p @ n / n.sum()))), 9) for p, n in zip(good, lengths)], pa.float64()),
                     pa.array([len(p) for p in good], pa.int64()),
                     pa.array([int((p < 0.5).sum()) for p in good], pa.int64())],
                    names=[id_col, "score", "n_lines", "n_bad"])

    return docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).mapInArrow(
        run, f"`{id_col}` {kind}, score double, n_lines long, n_bad long")


def quality(docs: DataFrame, labels: DataFrame, teach: int = TEACH, threshold: float = THRESHOLD,
            id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(id_col, held_out, score, predicted, n_lines, n_bad) for every row of ``docs``."""
    weights, share = fit(docs, labels, teach, id_col, text_col, label_col)
    s = score(docs, weights, share, id_col, text_col)
    return s.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted"), "n_lines", "n_bad")
