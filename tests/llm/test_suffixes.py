import hashlib
import random

import numpy as np
import pytest
from llm_cases import documents, empty, words

from kestrel.llm import suffixes


def plain(texts):
    """texts in order of documents -> (n_bytes, n_removed, n_spans, kept)."""
    seen, out = set(), []
    for t in texts:
        b = (t or "").encode()
        keep = np.ones(len(b), bool)
        for p in range(len(b) - 99):
            w = b[p:p + 100]
            if w in seen:
                keep[p:p + 100] = False
            seen.add(w)
        runs = int((np.diff(np.concatenate([[1], keep.astype(int), [1]])) == -1).sum())
        out.append((len(b), int((~keep).sum()), runs, bytes(np.frombuffer(b, np.uint8)[keep])))
    return out


def corpus():
    r = random.Random(4)
    passages = [words(k, 40) for k in range(6)]
    rows = []
    for i in range(60):
        t = [words(100 + i, r.randint(0, 30))]
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            a = r.randint(0, 60)
            t += [p[a:a + r.choice([98, 99, 100, 101, 150])], words(r.random(), r.randint(0, 8))]
        rows.append((i * 3, " ".join(t)))
    rows += [(500, "ab" * 200), (501, "b" + "ab" * 120), (502, "x" * 99), (503, "x" * 100), (504, "x" * 101),
             (505, rows[7][1]), (506, "é" * 120), (507, "aé" * 80), (508, "aé" * 80), (509, None), (510, "")]
    return rows


@pytest.mark.parametrize("block", [700, 5000, 1 << 22])
def test_against_every_window(spark, monkeypatch, block):
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", block)
    monkeypatch.setattr(suffixes, "RANGE_NAMES", 500)
    rows = corpus()
    exp = {i: x for (i, _), x in zip(rows, plain([t for _, t in rows]))}
    random.Random(1).shuffle(rows)
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = suffixes.find_repeats(d).collect()
    assert len(got) == len(rows)
    for r in got:
        n, removed, spans, kept = exp[r["doc_id"]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (n, removed, spans), r["doc_id"]
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_cover_meets_every_shift():
    cover = set(suffixes.COVER)
    assert all(any((p + k) % 57 in cover and (q + k) % 57 in cover for k in range(57)) for p in range(57) for q in range(57))


def test_packing():
    r = np.random.default_rng(0)
    for n in (1, 2, 5, 1000):
        for top in (8, 40, 64):
            x = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64) >> np.uint64(64 - top))
            assert (suffixes.unpack(suffixes.pack(x)) == x).all()


def test_drop_repeats_and_edge_rows(spark):
    d = documents(spark)
    out = suffixes.drop_repeats(d)
    assert out.columns == d.columns
    rows = out.collect()
    assert len(rows) == d.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r["text"])
    assert by[30] == [words(1, 120)] and sorted(map(len, by[40]))[0] == 0 and by[1] == [""]
    assert by[5] == ["x"] and all(r["kept"] == "kept" and r["row"] == "row" for r in rows)
    assert suffixes.find_repeats(empty(spark)).count() == 0
    assert suffixes.drop_repeats(empty(spark)).count() == 0


def test_spans_of_real_output(spark):
    t = words(3, 60)
    d = spark.createDataFrame([(1, t), (2, "new " + t + " end")], "doc_id long, text string")
    r = {x["row"]["doc_id"]: x for x in suffixes.find_repeats(d, real=True).collect()}
    assert r[2]["spans"] == [[4, 4 + len(t)]] and bytes(r[2]["kept"]) == b"new  end" and r[1]["spans"] == []


def test_rounds_kept_apart_and_texts(spark, monkeypatch):
    """Each round as a job of its own gives the same rows; the text mode gives the kept bytes as text, in slices."""
    monkeypatch.setattr(suffixes, "SLICE_BYTES", 300)
    d = spark.createDataFrame(corpus(), "doc_id long, text string")
    one = sorted(map(tuple, suffixes.find_repeats(d).collect()))
    assert one == sorted(map(tuple, suffixes.find_repeats(d, apart=True).collect()))
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    real = {r["row"]["doc_id"]: bytes(r["kept"]).decode("utf-8", "ignore") for r in suffixes.find_repeats(d, real=True).collect()}
    assert real == {r["row"]["doc_id"]: r["text"] for r in suffixes.find_repeats(d, texts=True).collect()}


def test_a_block_holds_two_megabytes(spark):
    docs = spark.createDataFrame([(i, chr(97 + i % 26) * 250_000) for i in range(20)], "doc_id long, text string")
    blocks = suffixes._texts_to_blocks(docs, "doc_id", "text", ["doc_id"], 1).select("sizes").collect()
    assert sum(len(b.sizes) for b in blocks) == 20 and all(sum(b.sizes) <= 2 << 20 for b in blocks)
