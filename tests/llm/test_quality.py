import re
from collections import Counter

import pytest
from llm_cases import documents, empty

from kestrel.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    w = WORD.findall(text or "")
    n = Counter(zip(w, w[1:], w[2:]))
    covered = {j for i in range(len(w) - 2) if n[w[i], w[i + 1], w[i + 2]] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
            len(covered), failed)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_counts_match_plain_version(spark):
    docs = documents(spark).unionByName(spark.createDataFrame(
        [(100 + i, t, None, None, None) + (None,) * 10 for i, t in enumerate(
            ["a b c a b c", "a b c d a b c d", "a a a a a", "x\ny\nx\n\nx \nx", "#a *b\n#a *b <c>", "a b c\x0ba b c"])],
        documents(spark).schema))
    got = quality.quality_rules(docs)
    text = {(r["doc_id"], r["text"]) for r in docs.collect()}
    have = sorted((str(r["doc_id"]), tuple(r[c] for c in COUNTS)) for r in got.collect())
    assert len(have) == docs.count()
    assert set(have) == {(str(i), plain(t)) for i, t in text}


def test_real_documents_and_labels(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    q = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    text = {r["doc_id"]: r["text"] for r in d.collect()}
    rows = quality.quality_rules(d).collect()
    assert all(tuple(r[c] for c in COUNTS) == plain(text[r["doc_id"]]) for r in rows)
    judged = [(q[r["doc_id"]], r["kept"]) for r in rows if r["doc_id"] in q and not r["base_failed"]]
    assert sum(a == int(b) for a, b in judged) >= 0.98 * len(judged)


def test_one_projection_without_python(spark):
    df = quality.quality_rules(documents(spark))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_empty_table(spark):
    assert quality.quality_rules(empty(spark)).count() == 0


@pytest.mark.parametrize("rule,text", [("symbol_ratio", "# of the " * 15), ("stop_word_ratio", None)])
def test_threshold_table_rejects(spark, rule, text):
    text = text or " ".join(f"wqx{i}" for i in range(80))
    text += " ".join(f" u{i}" for i in range(80))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = quality.quality_rules(df).first()
    assert not r["base_failed"] and not r["kept"]
