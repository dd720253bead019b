"""Registered model queries: which rows and how many trees their fits get."""

import random
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

SOURCE_TREES, SOURCE_LEAST = 5000, 300


@pytest.fixture(scope="module")
def features(spark):
    """Sampled train rows of 2024-01-15 to 23, one without a time, and test rows."""
    r = random.Random(3)
    rows = []
    for i in range(600):
        target = r.choice([-1, -1, 0, 1])
        test = i % 5 == 4
        ts = datetime(2024, 1, 28 if test else 15 + i % 9, i % 24) + timedelta(seconds=i)
        bad = i == 7
        target = 1 if bad else target
        rows.append((i, i % 25, None if bad else ts, None if bad else ts.day, not test, test, None if test else target,
                     None if test else int(target == 1), not test, None if test else 10.0 if target == 1 else 1.0,
                     None if test else 6.0 if target != -1 else 1.2, None if test else int(target != -1),
                     r.random() + (target == 1), r.random() + 0.5 * (target != -1), r.choice([1, 2, 3]), r.random()))
    df = spark.createDataFrame(rows, "event_id long, customer_id long, event_ts timestamp, event_day_number int, is_train_sample boolean, "
                               "is_test boolean, train_target_raw int, target_bin int, in_recent boolean, w_main double, w_susp double, "
                               "y_susp int, amt double, cnt_1h double, mcc_code_i int, cust_prev_red_lbl_rate double").cache()
    yield df
    df.unpersist()


@pytest.fixture
def fits(monkeypatch, features):
    """Every fit that a query asks for, as (rows' ids, most trees, validation column); two trees are fitted."""
    from kestrel.operators import models as Mo
    from kestrel.plans import queries_models
    asked, real = [], Mo.fit_gbt

    def fit(df, label, weight, val_col, params=None, features="features"):
        asked.append(({x["event_id"] for x in df.select("event_id").collect()}, dict(Mo.DEFAULT_PARAMS, **(params or {}))["maxIter"], val_col))
        return real(df, label, weight, val_col, dict(params or {}, maxIter=2), features)

    monkeypatch.setattr(queries_models, "_features", lambda spark, sf_dir: features)
    monkeypatch.setattr(Mo, "fit_gbt", fit)
    return asked


def _ids(df):
    return {r["event_id"] for r in df.select("event_id").collect()}


def _first_fit_ids(features):
    """Rows before the window, and in it those of the day that is drawn for their customer."""
    from kestrel.operators.sampling import random_day_validation
    return _ids(random_day_validation(features).where("is_train_sample AND (in_train_part OR is_val)"))


def test_importance_is_refitted_on_all_sampled_rows(spark, features, fits):
    from kestrel.plans.catalog import QUERIES
    import kestrel.plans.queries_models  # noqa: F401
    out = QUERIES["gbt_importance"](spark, "").collect()
    assert sum(r["share"] for r in out) == pytest.approx(1)
    sampled, known = _ids(features.where("is_train_sample")), _first_fit_ids(features)
    assert len(known) < len(sampled)
    (first, first_trees, first_val), (refit, refit_trees, refit_val) = fits
    assert (first, first_trees, first_val) == (known, SOURCE_TREES, "is_val")
    assert (refit, refit_trees, refit_val) == (sampled, SOURCE_LEAST, None)


def test_prepared_rows_are_imputed_by_all_train_rows(spark, features, monkeypatch):
    from kestrel.plans import queries_models
    gaps = features.withColumn("amt", F.when(F.col("is_test"), F.lit(None)).when(F.col("event_ts") < "2024-01-19", 1.0)
                               .when(F.col("is_train_sample"), 2.0))
    monkeypatch.setattr(queries_models, "_features", lambda spark, sf_dir: gaps)
    frame, cols = queries_models._prepared(spark, "")
    assert frame.count() == features.count()
    late = gaps.where("is_train_sample AND amt = 2").count()
    assert late > gaps.where("is_train_sample AND amt = 1").count()  # so the median of all train rows is 2
    got = {r["features"][cols.index("amt")] for r in frame.where("is_test").select("features").collect()}
    assert got == {2.0}


def test_scores_are_those_of_whole_fits(spark, features, fits):
    from kestrel.plans.catalog import QUERIES
    import kestrel.plans.queries_models  # noqa: F401
    out = QUERIES["gbt_scores"](spark, "").collect()
    known = _first_fit_ids(features)
    assert {r["event_id"] for r in out} < known and all(0 < r["predict"] <= 1 for r in out)
    assert [(t, v) for _, t, v in fits] == [(SOURCE_TREES, "is_val")] * 5
    assert max(len(ids) for ids, _, _ in fits) == len(known) and all(ids <= known for ids, _, _ in fits)


def test_run_is_of_whole_fits(spark, features, fits, tmp_path):
    from kestrel.plans.catalog import QUERIES
    import kestrel.plans.queries_models  # noqa: F401
    folder = tmp_path / uuid.uuid4().hex
    raw = features.where("event_ts IS NOT NULL").select(
        "event_id", F.col("event_ts").alias("ts"), F.col("customer_id").alias("user_id"),
        F.when(F.col("event_id") % 2 == 0, "error").otherwise("purchase").alias("event_type"),
        F.lit(10.0).alias("value"), F.concat(F.lit('{"k": '), (F.col("event_id") % 97).cast("string"), F.lit("}")).alias("props"))
    raw.write.parquet(f"{folder}/events.parquet")
    out = QUERIES["refit_run"](spark, str(folder)).collect()
    assert {r["event_id"] for r in out} == _ids(features.where("is_test"))
    first, refits = [x for x in fits if x[2]], [x for x in fits if not x[2]]
    assert [(t, v) for _, t, v in first] == [(SOURCE_TREES, "is_val")] * 5
    assert [t for _, t, _ in refits] == [SOURCE_LEAST] * 15
    sampled = features.where("is_train_sample AND (train_target_raw <> -1 OR event_id % 3 = 0)")
    assert max((ids for ids, _, _ in refits), key=len) == _ids(sampled)


def test_training_rows_meet_in_few_partitions(spark):
    from kestrel.operators import models as Mo
    many = spark.range(0, 70_000, 1, 40).withColumn("x", F.col("id") * 2)
    got = Mo.dealt(many)
    assert got.rdd.getNumPartitions() == 3 and got.agg(F.sum("x")).first()[0] == 69_999 * 70_000
    assert Mo.dealt(many.limit(0)).rdd.getNumPartitions() <= 1
