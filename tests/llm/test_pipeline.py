import importlib.util

import pytest
from llm_cases import documents, empty

import corpus_pipeline
from kestrel.llm import mixing, pieces, queries, suffixes

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        docs = docs.checkpoint()
        assert 0 < docs.count() <= 3 * before


def test_run_against_stage_by_stage_plain_versions(spark):
    """The last three stages recomputed from what the second one kept."""
    from test_minhash import plain as components
    from test_suffixes import plain as repeats

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [tuple(r) for r in corpus_pipeline.toxicity_stage(spark, docs, SF).collect()]
    group, _ = components([(r[0], r[1]) for r in kept])
    kept = sorted(r for r in kept if group[r[0]] == r[0])
    cut = [(r[0], x[3].decode("utf-8", "ignore"), r[2], r[3]) for r, x in zip(kept, repeats([r[1] for r in kept]))]
    frame = spark.createDataFrame([(*r, len(r[1])) for r in cut], docs.schema)
    exp = [(r["doc_id"], r["text"]) for r in mixing.mix(frame).collect()]
    voc = pieces.vocabulary(queries.sentencepiece_model())
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r["doc_id"], r["ids"], r["decoded"]) for r in got) == sorted(
        (i, voc.library.encode(t), t) for i, t in exp)


@pytest.mark.parametrize("k", range(5))
def test_each_stage_takes_edge_rows(spark, k):
    name, stage = corpus_pipeline.STAGES[k]
    d = documents(spark)
    out = stage(spark, d, SF)
    if k < 4:
        assert out.columns == d.columns
    assert out.count() > 0
    assert stage(spark, empty(spark), SF).count() == 0


def test_entry_registers_all(spark):
    import __spark_entry__ as e
    names = e.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert set(e.oracle_sql()) <= set(names)


def test_entry_works_without_the_subpackage(monkeypatch):
    import __spark_entry__ as e
    real = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda n, *a: None if n == "kestrel.llm" else real(n, *a))
    assert "pipeline" not in e.queries() and "velocity" in e.queries()


def test_rowcounts_of_registered_queries(spark):
    for n, t, key in (("op10_quality_rules", "documents", "doc_id"), ("op6_mix_sources", "documents", "doc_id"),
                      ("op3_main_text", "pages", "page_id"), ("op2_warc_round_trip", "pages", "page_id")):
        table = spark.read.parquet(f"{SF}/{t}.parquet")
        got = queries.QUERIES[n](spark, SF)
        assert sorted(r[0] for r in got.select(key).collect()) == sorted(r[0] for r in table.select(key).collect())
    assert suffixes.LENGTH == 100


def test_the_driver_gives_memory_back_around_each_stage(monkeypatch):
    calls = []
    monkeypatch.setattr(corpus_pipeline, "release", lambda spark: calls.append("release"))
    monkeypatch.setattr(corpus_pipeline, "give_back", lambda: calls.append("give_back"))
    run = corpus_pipeline.settled(lambda spark, docs, sf_dir: calls.append("stage") or docs)
    assert run(None, 7, "") == 7
    assert calls == ["release", "give_back", "stage", "release", "give_back"]
    assert all(hasattr(stage, "__wrapped__") for _, stage in corpus_pipeline.STAGES)
