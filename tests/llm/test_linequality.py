import itertools
import zlib

import numpy as np
import pytest
from llm_cases import documents, empty, words

from kestrel.llm import crf, linequality

LABELS = "doc_id long, quality int, toxic int, text string, label int, id long"


def _sequences(seed, sizes, measures=5):
    r = np.random.default_rng(seed)
    return r, [r.integers(0, crf.BINS, (n, measures)).astype(np.uint8) for n in sizes]


def plain(x, w):
    """Marginals and log normaliser of one sequence over all labellings; rows of x are bins."""
    n, measures = x.shape
    table, move = w[:-4].reshape(3, measures, crf.BINS + 1), w[-4:].reshape(2, 2)
    gap = [crf.BINS] * measures
    node = [sum(table[k, m, row[m]] for k, row in enumerate((x[t], x[t - 1] if t else gap, x[t + 1] if t + 1 < n else gap))
                for m in range(measures)) for t in range(n)]
    total, good = 0.0, np.zeros(n)
    for y in itertools.product((0, 1), repeat=n):
        p = np.exp(sum(node[t] * y[t] for t in range(n)) + sum(move[a, b] for a, b in zip(y, y[1:])))
        total += p
        good += p * np.array(y)
    return good / total, np.log(total), node, move


def test_marginals_and_loss_match_all_labellings():
    r, seqs = _sequences(1, [1, 4, 7, 2, 7])
    w = r.normal(size=crf.n_weights(5)) * 0.5
    batch = crf.Batch(seqs)
    y, share = np.array([1, 0, 1, 0, 1]), np.array([1.0, 2.0, 0.5, 1.0, 1.0])
    want = 0.0
    for x, got, label, s in zip(seqs, batch.marginals(w), y, share):
        p, total, node, move = plain(x, w)
        assert np.allclose(got, p)
        want += s * (total - (sum(node) * label + (len(x) - 1) * move[label, label]))
    assert batch.loss(w, y, share)[0] == pytest.approx(want)


def test_gradient_matches_finite_differences():
    r, seqs = _sequences(2, [3, 1, 6, 4])
    w = r.normal(size=crf.n_weights(5)) * 0.3
    batch, y, share = crf.Batch(seqs), np.array([0, 1, 1, 0]), r.random(4) + 0.5
    _, g = batch.loss(w, y, share)
    for j in range(len(w)):
        e = np.zeros_like(w)
        e[j] = 1e-5
        assert (batch.loss(w + e, y, share)[0] - batch.loss(w - e, y, share)[0]) / 2e-5 == pytest.approx(g[j], abs=1e-6)


def test_minimise_finds_the_least_value():
    a = np.diag(np.arange(1.0, 9.0))
    f = lambda x: (float((x - 1) @ a @ (x - 1)), 2 * a @ (x - 1))
    assert np.allclose(crf.minimise(f, np.zeros(8), 60, enough=0), 1, atol=1e-4)


def test_measures_of_edge_lines():
    assert linequality.lines(None) == linequality.lines(" \n\t\n") == [""]
    assert linequality.lines("a\n\n b \n") == ["a", " b "]
    found, lengths = linequality.bins([None, "a a a\nA!! | 12", "x" * 100_000])
    assert [len(x) for x in found] == [1, 2, 1] == [len(x) for x in lengths]
    assert linequality.measure("a a b", 3)[:2] == (3, 1.0) and linequality.measure("a a b", 3)[8] == 1 / 3
    assert (found[0] == 0).all() and linequality.bins([]) == ([], [])


def test_held_out_accuracy_and_columns(spark):
    """Both kinds of documents are told apart where labels did not teach."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = {r["doc_id"]: r for r in linequality.quality(docs, labels).collect()}
    assert len(got) == docs.count()
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) and r["n_bad"] <= r["n_lines"]
    out = [(r["quality"], got[r["doc_id"]]) for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    assert np.mean([y == r["predicted"] for y, r in out]) >= 0.95
    good, bad = ([r["score"] for y, r in out if y == k] for k in (1, 0))
    assert np.mean([[a > b for b in bad] for a in good]) >= 0.97


def test_labels_of_held_out_ids_and_other_columns_do_not_matter(spark):
    docs = documents(spark)
    rows = [(i, int(i % 2 == 0), 0, "x", 5, 9) for i in (1, 2, 3, 4, 5, 6, 7, 8, 30, 31, 32, 40, 41, 42)]
    rows += [(None, 1, 1, "", 1, 1), (7, 0, 0, "", 0, 0), (7, 1, 0, "", 0, 0), (8, None, 1, "", 0, 0), (999, 1, 0, "", 0, 0)]
    one = linequality.quality(docs, spark.createDataFrame(rows, LABELS)).orderBy("doc_id", "score").collect()
    flipped = [(i, 1 - y if y is not None and i is not None and zlib.crc32(str(i).encode()) % 5 == 0 else y, *x)
               for i, y, *x in rows]
    changed = docs.selectExpr("doc_id", "text", "'zz' AS lang", "'other' AS source", "n_chars")
    two = linequality.quality(changed, spark.createDataFrame(flipped, LABELS)).orderBy("doc_id", "score").collect()
    assert [tuple(r) for r in one] == [tuple(r) for r in two] and len(one) == docs.count()
    blank = {r["score"] for r in one if r["doc_id"] in (1, 2, 3)}
    assert len(blank) == 1


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], LABELS)
    docs = documents(spark)
    assert {r["score"] for r in linequality.quality(docs, none).collect()} == {0.5}
    same = spark.createDataFrame([(i, 1, 0, "", 0, 0) for i in range(1, 9)], LABELS)
    assert {r["score"] for r in linequality.quality(docs, same).collect()} == {1.0}
    assert linequality.quality(empty(spark), none).collect() == []


def test_a_bad_half_lowers_the_score():
    """Marginals weigh by length: a long bad part counts more than a short one."""
    r, seqs = _sequences(4, [6])
    seqs[0][:3], seqs[0][3:] = 0, 7
    w = np.zeros(crf.n_weights(5))
    w[:9] = np.linspace(3, -3, 9)
    p = crf.Batch(seqs).marginals(w)[0]
    assert (p[:3] > 0.9).all() and (p[3:] < 0.2).all()
    assert words(1, 3).count(" ") == 2
