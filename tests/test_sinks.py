"""Sinks S5-S8 and the template completeness check."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F


def test_stage_config_embedding_roundtrip(spark):
    from kestrel.sources import sinks
    d = tempfile.mkdtemp(prefix="kestrel-sink-")
    df = spark.createDataFrame([(1, [0.5, 1.5]), (2, [2.0, 0.0])], "customer_id long, embedding array<double>")
    p = sinks.write_stage(df, os.path.join(d, "stage"))
    assert sinks.stage_exists(spark, p)
    # an existing stage is reused unless forced
    sinks.write_stage(df.limit(1), p)
    assert spark.read.parquet(p).count() == 2
    cfg = sinks.RunConfig(0.35, 0.0, 0.65, 0.3, [42, 123], {"main": 7}, ["a", "b"], 8)
    sinks.write_config(spark, cfg, os.path.join(d, "cfg"))
    assert sinks.read_config(spark, os.path.join(d, "cfg")) == cfg
    sinks.write_embeddings(df, os.path.join(d, "emb"))
    assert {r["customer_id"]: list(r["embedding"]) for r in sinks.read_embeddings(spark, os.path.join(d, "emb")).collect()} == {
        1: [0.5, 1.5], 2: [2.0, 0.0]}
    assert spark.read.parquet(os.path.join(d, "emb")).schema["embedding"].dataType.simpleString() == "array<float>"


def test_template_join_completeness(spark):
    from kestrel.sources import sinks
    template = spark.createDataFrame([(1,), (2,), (3,)], "event_id long")
    preds = spark.createDataFrame([(1, 0.3, 0.1), (2, 0.3, 0.2), (3, 0.3, 0.9)],
                                  "event_id long, alpha double, predict double")
    out = sinks.template_join(template, preds, ["alpha"])
    assert out.count() == 3
    with pytest.raises(sinks.IncompleteSubmission):
        sinks.template_join(template, preds.filter(F.col("event_id") < 3), ["alpha"])
    d = tempfile.mkdtemp(prefix="kestrel-csv-")
    sinks.write_submission(out, os.path.join(d, "sub"))
    back = spark.read.option("header", True).csv(os.path.join(d, "sub"))
    assert back.count() == 3 and "alpha" in back.columns


def test_parts_of_several_files(spark):
    from kestrel.sources.union import read_parts
    d = tempfile.mkdtemp(prefix="kestrel-parts-")
    for k, n in enumerate((30, 50)):
        spark.range(n).withColumnRenamed("id", "event_id").repartition(4).write.parquet(os.path.join(d, f"p{k}"))
    paths = [os.path.join(d, f"p{k}") for k in range(2)]
    got = read_parts(spark, paths, ["event_id"], with_part=True).groupBy("part_id").count().collect()
    assert {r["part_id"]: r["count"] for r in got} == {0: 30, 1: 50}
    assert read_parts(spark, paths, ["event_id"]).columns == ["event_id"]


def test_stage_is_read_with_pruned_columns(spark):
    from kestrel.sources.sinks import stage
    s = stage(spark.range(10).selectExpr("id", "id * 2 AS b", "'x' AS c"), "test")
    df = s.select("b")
    assert "ReadSchema: struct<b:bigint>" in df._jdf.queryExecution().executedPlan().toString() and df.count() == 10


def test_unfinished_or_incomplete_config_is_an_error(spark):
    from kestrel.sources import sinks
    d = os.path.join(tempfile.mkdtemp(prefix="kestrel-cfg-"), "cfg")
    with pytest.raises(FileNotFoundError):
        sinks.read_config(spark, d)
    sinks.write_config(spark, sinks.RunConfig(0.35, 0.0, 0.65, None, [42], {}, [], 8), d)
    with pytest.raises(ValueError):
        sinks.read_config(spark, d)


def test_killed_stage_is_written_anew_and_a_finished_one_is_kept(spark):
    """Kill and resume: a folder without _SUCCESS is no stage; inputs and parameters name the stage."""
    from kestrel.sources import sinks
    d = tempfile.mkdtemp(prefix="kestrel-cache-")
    source = os.path.join(d, "in")
    spark.range(10).write.parquet(source)
    built = []

    def run(params):
        def build():
            built.append(params)
            return spark.read.parquet(source).selectExpr(f"id * {params['k']} AS x")
        return sinks.cached_stage(spark, d, "times", [source], params, build)

    def total(df):
        return df.agg(F.sum("x")).first()[0]

    path = f"{d}/times-{sinks.fingerprint(spark, [source], {'k': 2})}"
    spark.range(1000).selectExpr("id AS x").write.parquet(path)  # what a killed run left
    os.remove(os.path.join(path, "_SUCCESS"))
    assert not sinks.stage_exists(spark, path) and total(run({"k": 2})) == 90 and len(built) == 1
    assert total(run({"k": 2})) == 90 and len(built) == 1  # kept
    assert total(run({"k": 3})) == 135 and len(built) == 2  # other parameters
    spark.range(1).selectExpr("id + 100 AS id").write.mode("append").parquet(source)
    assert total(run({"k": 2})) == 290 and len(built) == 3  # other inputs
