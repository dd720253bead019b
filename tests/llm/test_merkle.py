import hashlib
import zlib

import pytest
from llm_cases import documents, empty

from kestrel.llm import merkle


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row, n_chars):
    values = (row[0], row[1], row[2], n_chars, row[4])
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([H("".join(out[-1][i:i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def siblings(tree, i):
    for level in tree[:-1]:
        yield (level[i ^ 1] if i ^ 1 < len(level) else ""), i & 1
        i >>= 1


def plain(rows):
    """The contract, row by row; rows are (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[3])))
    trees = {g: levels([leaf(r, r[3]) for r in groups[g]]) for g in order}
    top = levels([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            proof = [*siblings(trees[g], i), *siblings(top, k)]
            bad = r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            h = leaf(r, r[3] + 1 if bad else r[3])
            for s, odd in proof:
                h = H(s + h if odd else h + s)
            out.append((r[0], leaf(r, r[3]), trees[g][-1][0], top[-1][0], H("".join(s for s, _ in proof)), h,
                        h == top[-1][0]))
    return sorted(out, key=str)


def check(docs):
    got = sorted((tuple(r) for r in merkle.digest(merkle.manifest(docs)).collect()), key=str)
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert got == plain(rows)
    return got


def test_edge_cases_match_plain_version(spark):
    assert len(check(documents(spark))) == 17


def test_empty_table(spark):
    assert merkle.digest(merkle.manifest(empty(spark))).collect() == []


@pytest.mark.parametrize("sizes", [{"x": 1}, {"x": 257, "": 2, "y": 3, None: 1, "z": 600, "a": 255, "b": 256}])
def test_sizes_around_blocks(spark, sizes):
    rows = [(1000 * k + i, "s", g, i, f"text {i}") for k, (g, n) in enumerate(sizes.items()) for i in range(n)]
    got = check(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"))
    bad = {r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 7 == 0}
    assert {r[0] for r in got if not r[6]} == bad


def test_many_groups_and_a_repeated_row(spark):
    """Three hundred groups of one row, and one row that is a third of the table."""
    rows = [(i, "s", f"g{i:03d}", 1, "t") for i in range(300)] + [(7, "s", "hot", None, "same")] * 150
    check(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"))


def test_real_documents(spark):
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
