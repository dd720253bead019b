import random
import re

from llm_cases import documents, empty, words

from kestrel.llm import components, minhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows):
    """Components by comparing every pair."""
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets.setdefault(i, []).append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    flat = [(i, s) for i, x in sets.items() for s in x]
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(flat)):
        for b in range(a):
            (i, s), (j, t) = flat[a], flat[b]
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}, {i: sorted(len(s) for s in x) for i, x in sets.items()}


def same(df, rows):
    comp, sizes = plain([r for r in rows if r[0] is not None])
    got = df.collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == comp[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["component_id"])
            assert r["n_shingles"] in sizes[r["doc_id"]]


def edited(base, k, r):
    w = base.split(" ")
    for _ in range(k):
        w[r.randrange(len(w))] = words(r.random(), 1)
    return " ".join(w)


def test_against_all_pairs(spark):
    """Groups whose copies lie on both sides of the threshold, and links that miss the centre."""
    r = random.Random(8)
    rows, i = [], 0
    for g in range(6):
        base = words(50 + g, 100)
        for k in (0, 1, 2, 3, 4, 5, 6, 8, 3, 4, 5):
            t = edited(base, k, r)
            rows.append((i, t))
            rows.append((i + 1, edited(t, 2, r)))  # near its parent, often far from the centre
            i += 2
    rows += [(i + 1, "a b c"), (i + 2, "A b C"), (i + 3, None), (i + 4, " "), (i + 5, "a b d"), (i + 6, None)]
    r.shuffle(rows)
    d = spark.createDataFrame(rows, "doc_id long, text string")
    same(minhash.near_duplicates(d), rows)


def test_small_blocks_give_the_same(spark, monkeypatch):
    r = random.Random(9)
    base = words(77, 90)
    rows = [(k, edited(base, 1 + k % 9, r)) for k in range(120)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(minhash, "BLOCK", 1500)
    same(minhash.near_duplicates(d), rows)


def test_edge_rows(spark):
    d = documents(spark)
    same(minhash.near_duplicates(d), [(r["doc_id"], r["text"]) for r in d.collect()])
    kept = minhash.drop_near_duplicates(d)
    assert kept.columns == d.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 30 in ids and 31 not in ids and 32 not in ids and ids.count(None) == 2
    assert minhash.near_duplicates(empty(spark)).count() == 0
    assert minhash.drop_near_duplicates(empty(spark)).count() == 0


def test_real_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    same(minhash.near_duplicates(d), [(r["doc_id"], r["text"]) for r in d.collect()])


def test_components(spark):
    r = random.Random(2)
    e = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(100 + k, 101 + k) for k in range(30)] + [(5, 5)]
    root = {x: x for p in e for x in p}
    for _ in root:
        for a, b in e:
            root[a] = root[b] = min(root[a], root[b])
    df = spark.createDataFrame(e, "u long, v long")
    got = {x["node"]: x["component"] for x in components.components(df).collect()}
    assert got == {k: v for k, v in root.items() if any(k in p and p[0] != p[1] for p in e)}
