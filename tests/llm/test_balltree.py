import random

import numpy as np
import pytest

from kestrel.llm import balltree

SCHEMA = "vec_id long, embedding array<float>, score string, rank string, dim string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "a", "b", "c") for i, v in rows], SCHEMA)


def plain(rows, k=5, every=50):
    fine = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        w = tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)
        fine[i] = min(fine.get(i, w), w)
    out = []
    for q in fine:
        if q % every == 0:
            s = sorted(((-sum(a * b for a, b in zip(fine[q], v)), i) for i, v in fine.items()
                        if i != q and len(v) == len(fine[q])))[:k]
            out += [(q, n + 1, i, -x) for n, (x, i) in enumerate(s)]
    return sorted(out)


def run(df, **kw):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in balltree.top_k(df, **kw).collect())


@pytest.mark.parametrize("shard,leaf", [(4096, 128), (60, 5)])
def test_against_all_products(spark, monkeypatch, shard, leaf):
    monkeypatch.setattr(balltree, "LEAF", leaf)
    r = random.Random(1)
    rows = [(i, [r.gauss(0, 0.3) for _ in range(8)]) for i in range(600)]
    assert run(frame(spark, rows).repartition(5), shard=shard) == plain(rows)


def test_ties_repeats_and_bad_vectors(spark):
    rows = [(i, [1.0, 0.5]) for i in range(0, 130)] + [(200, [0.0, 0.0]), (250, None), (251, [1.0, None]),
            (252, [float("nan"), 1.0]), (253, [float("inf"), 0.0]), (None, [1.0, 1.0]), (300, [1.0]), (301, [2.0]),
            (350, []), (400, [-1.0, 0.25]), (400, [-1.0, 0.25]), (401, [9.0, 9.0]), (401, [8.0, 9.0])]
    assert run(frame(spark, rows), shard=40) == plain(rows)


def test_large_components_stay_exact(spark):
    rows = [(i, [3.0e5 + i, -2.0e5 + 3 * i, 1.0e6 - i]) for i in range(60)]
    assert run(frame(spark, rows)) == plain(rows)


def test_empty_and_few(spark):
    assert run(frame(spark, [])) == []
    assert run(frame(spark, [(50, [1.0]), (1, [2.0])])) == [(50, 1, 1, 131072)]


def test_real_vectors(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    assert run(d) == plain([(r["vec_id"], r["embedding"]) for r in d.collect()])
