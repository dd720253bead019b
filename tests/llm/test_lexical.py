import math
import random
import re
from collections import Counter

import numpy as np
from llm_cases import documents, empty

from kestrel.llm import fptree, lexical

TERM = re.compile(lexical.TERM)
FOLD = str.maketrans(lexical._UPPER, lexical._LOWER)
ITEMS = "item_id long, text string, doc_id string, rank string, term string"


def found(text):
    return TERM.findall((text or "").translate(FOLD))


def plain(docs, items, k=10):
    """Every document scored for every item."""
    vec = [(i, Counter(found(t))) for i, t in docs]
    vec = [(i, c, sum(c.values())) for i, c in vec if c]
    n_docs, n_terms = len(vec), sum(n for *_, n in vec)
    df = Counter(t for _, c, _ in vec for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(found(t))
    out = []
    for i, ts in asked.items():
        rows = []
        for d, c, n in vec:
            m = 100 - 90 + 90 * n * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in ts if c[t])
            if s > 0:
                rows.append((-s, d is None, d or 0, d))
        out += [(i, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(rows, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def check(docs, items):
    got = sorted((tuple(r) for r in lexical.search(docs, items).collect()), key=str)
    assert got == plain([(r["doc_id"], r["text"]) for r in docs.collect()],
                        [(r["item_id"], r["text"]) for r in items.collect()])
    return got


def test_terms_agree_with_the_pattern():
    for t in ["", "A-b_c9 Éé", "x\x00y\x7fz@`[{", "漢字 🙂ok", " a b", "İI"]:
        assert [x.decode() for x in lexical.terms(t.encode())] == found(t)


def test_edge_cases_match_plain_version(spark):
    docs = documents(spark)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = [(1, None), (2, ""), (3, "nothing of this is there"), (4, texts[30]), (4, "one two"), (5, "Ab AB ab"),
            (None, "漢 é one"), (6, texts[4]), (7, texts[40])]
    items = spark.createDataFrame([r + ("d", "r", "t") for r in rows], ITEMS)
    got = check(docs, items)
    assert {r[0] for r in got} == {4, 5, None, 6, 7}
    none = spark.createDataFrame([], ITEMS)
    assert lexical.search(empty(spark), items).collect() == [] == lexical.search(docs, none).collect()
    assert lexical.search(docs, none).columns == ["item_id", "rank", "doc_id", "score"]


def test_ties_blocks_and_small_trees(spark, monkeypatch):
    """Many equal scores, several blocks of items, and hundreds of equal documents."""
    monkeypatch.setattr(lexical, "BLOCK", 40)
    r = random.Random(3)
    voc = [f"w{i}" for i in range(30)]
    texts = [" ".join(r.choices(voc, k=r.randint(1, 12))) for _ in range(400)] + ["w1 w2 w3"] * 300
    docs = spark.createDataFrame([(1000 - i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    items = spark.createDataFrame([(i, " ".join(r.sample(voc, 6))) for i in range(25)], "item_id long, text string")
    check(docs, items)


def test_real_documents(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"),
          spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet"))


def test_bounds_hold_and_prune():
    """No score exceeds the bound of any node above it, and the search skips documents."""
    r = random.Random(5)
    n, terms = 600, 60
    common = [[t for t in range(terms) if r.random() < 1.5 / (t + 2)] or [0] for _ in range(n)]
    size = np.array([len(x) for x in common])
    tf = np.array([r.randint(1, 5) for x in common for _ in x])
    tree = fptree.Tree(list(range(n)), np.array([r.randint(10, 200) for _ in range(n)]), size,
                       np.array([t for x in common for t in x]), tf)
    asked = [r.sample(range(8), r.randint(0, 3)) for _ in range(terms)]
    items = fptree.Items(np.array([1 + 3 * t for t in range(terms)]), asked, 8)
    exact = tree.scores(0, n, items)
    seen, stack = 0, [(0, n)]
    while stack:
        lo, hi = stack.pop()
        assert (exact[lo:hi].max(axis=0) <= tree.bound(lo, hi, items)).all()
        kids = tree.children(lo, hi) if hi - lo > fptree.LEAF else []
        assert not kids or (kids[0][0] == lo and kids[-1][1] == hi and len(kids) > 1)
        stack += kids
        seen += 1
    assert seen > 40
    scored = []
    whole = tree.scores
    tree.scores = lambda lo, hi, items: scored.append(hi - lo) or whole(lo, hi, items)
    best = fptree.Best(8, 3)
    tree.search(items, best)
    assert sum(scored) < n
    for i in range(8):
        rows = sorted((-int(exact[d, i]), False, tree.ids[d]) for d in range(n) if exact[d, i] > 0)[:3]
        assert best.rows[i] == rows
