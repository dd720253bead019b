import re

import pytest
from llm_cases import documents, empty

from kestrel.llm import mixing


def fill(sizes, weights, epochs=3):
    """Plain water-filling: clamp, share the excess by weight, until none is above."""
    total, cap = sum(sizes), [epochs * s for s in sizes]
    target, fixed = [0.0] * len(sizes), set()
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        rest, w = total - sum(target[i] for i in fixed), sum(weights[i] for i in free)
        for i in free:
            target[i] = rest * weights[i] / w
        over = [i for i in free if target[i] > cap[i]]
        if not over:
            return target
        for i in over:
            target[i] = cap[i]
            fixed.add(i)


@pytest.mark.parametrize("sizes", [[100, 5, 50, 1, 400, 3, 90], [10, 10, 10], [0, 7, 1000], [1]])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(f"s{i}" if i else None, s) for i, s in enumerate(sizes)], "source string, size long")
    names = sorted(f"s{i}" for i in range(1, len(sizes))) + [None]
    by = {(f"s{i}" if i else None): s for i, s in enumerate(sizes)}
    exp = dict(zip(names, fill([by[n] for n in names], [1 + k % 3 for k in range(len(names))])))
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    assert got == pytest.approx(exp)


def check(rows):
    per = {}
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        s = per.setdefault(r["source"], [0, 0, r["target"], r["source_size"], 0])
        s[0] += r["taken"]
        s[1] += r["size"]
        s[4] = max(s[4], r["size"])
    for taken, size, target, stated, largest in per.values():
        assert size == stated and abs(taken - target) <= largest
    return per


def test_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    a, b = mixing.plan_mix(d).collect(), mixing.plan_mix(d.repartition(7)).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))  # reruns agree
    per = check(a)
    assert sum(s[2] for s in per.values()) == pytest.approx(sum(s[1] for s in per.values()))
    text = {r["doc_id"]: r["text"] for r in d.collect()}
    assert all(r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", text[r["doc_id"]] or "")) for r in a)


def test_mix_repeats_rows(spark):
    d = documents(spark)
    rows = mixing.plan_mix(d).collect()
    assert len(rows) == d.count()
    mixed = mixing.mix(d)
    assert mixed.columns == d.columns
    assert mixed.count() == sum(r["copies"] for r in rows)


def test_no_python_and_empty(spark):
    p = mixing.plan_mix(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in p
    assert mixing.plan_mix(empty(spark)).count() == 0 and mixing.mix(empty(spark)).count() == 0


def test_many_sources_give_the_same(spark, monkeypatch):
    d = documents(spark)
    few = sorted(map(str, mixing.plan_mix(d).collect()))
    monkeypatch.setattr(mixing, "FEW_SOURCES", 1)
    assert sorted(map(str, mixing.plan_mix(d).collect())) == few
    assert mixing.mix(d).columns == d.columns
