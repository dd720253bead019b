"""Registered whole-pipeline and model queries (rows-only checks: assembled
features, M1-M4, M15, Q5, Q8).  Every operator inside them has its own
SQL-checked query; these check that the pieces compose."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import models as Mo
from kestrel.operators import scoring as S
from kestrel.plans import queries_features  # noqa: F401  (registers the oracles of the blocks)
from kestrel.plans.catalog import ORACLES, register
from kestrel.plans.features import build_features, cut
from kestrel.plans.oracle import with_base
from kestrel.plans.queries_timeline import WC, _d, _i
from kestrel.sources.timeline import fixture_timeline


def _features(spark, sf_dir):
    return build_features(fixture_timeline(spark, sf_dir, by_customer=False))


@register("features")
def q_features(spark, sf_dir):
    """Full feature build: sampled train + test rows with every W/F/R/D/A/P column."""
    return _features(spark, sf_dir)


#: Queries whose oracles cover the build's columns block by block.
_BLOCKS = ("parse_rows", "cust_counts", "cust_lags", "cust_amounts", "cust_session_day", "markov", "moving_avg",
           "feedback", "rolling", "device", "interactions", "prior_join")
_PROFILE = ("txn_count", "amt_mean", "amt_std", "amt_median", "amt_max", "amt_p95", "n_unique_mcc", "hour_mean",
            "avg_daily_txns")

FEATURES_META_SQL = with_base("SELECT event_id, customer_id, " + ", ".join([
    _i("target", "target"), _i("idx", "cust_event_idx"), _i("pets", "prev_ets"), _d("pamt", "prev_amt"),
    _i("coalesce(pses, -1)", "prev_session_id"),
    _i("period = 'train' AND train_target_raw = 1", "is_red_lbl"),
    _i("period = 'train' AND train_target_raw = 0", "is_yellow_lbl"),
    _i("period = 'train' AND train_target_raw IN (0, 1)", "is_labeled_fb"),
    _i("""period = 'train' AND train_target_raw = -1 AND (
      (event_ts >= TIMESTAMP '2024-01-17 00:00:00' AND (event_id * 1000003 + customer_id * 7919 + 42) % 5 = 0)
      OR (event_ts < TIMESTAMP '2024-01-17 00:00:00' AND (event_id * 1000003 + customer_id * 7919 + 59) % 15 = 0))""",
       "keep_green")]) + " FROM l", f"""
l AS (SELECT *, row_number() OVER ({WC}) AS idx, lag(ets) OVER ({WC}) AS pets, lag(amt) OVER ({WC}) AS pamt,
        lag(session_id) OVER ({WC}) AS pses FROM t)""")

FEATURES_SQL = (
    "SELECT b.* EXCLUDE (" + ", ".join(f"profile_{c}" for c in _PROFILE) + "), "
    + ", ".join(f"coalesce(profile_{c}, 0) AS profile_{c}" for c in _PROFILE)
    + f" FROM (SELECT * FROM ({FEATURES_META_SQL}) JOIN ({ORACLES['null_flags']}) n USING (event_id) "
    + " ".join(f"JOIN (SELECT * {'EXCLUDE (null_device_count) ' if k == 'parse_rows' else ''}FROM ({ORACLES[k]})) USING (event_id)"
               for k in _BLOCKS)
    + f" LEFT JOIN ({ORACLES['profile']}) USING (customer_id)) b")


@register("features_checked", FEATURES_SQL)
def q_features_checked(spark, sf_dir):
    """Every column of the full build but the two raw times, against the oracles of all blocks."""
    return _features(spark, sf_dir).drop("event_ts", "event_date")


def _prepared(spark, sf_dir):
    """All sampled train rows and the test rows, imputed by the train rows and assembled; and the feature names.

    ``in_fit`` marks the rows of the first fits: the part before the validation window and the drawn days (``is_val``).
    The window's other rows are in refits only.
    """
    from kestrel.operators.sampling import random_day_validation
    df = random_day_validation(_features(spark, sf_dir))
    df = df.withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in ("is_val", "in_train_part")})
    df = df.withColumn("in_fit", F.col("is_train_sample") & (F.col("in_train_part") | F.col("is_val")))
    cols = Mo.feature_columns(df, with_feedback=True)
    prepared = Mo.prepare(df, cols, train_ref=df.filter("is_train_sample"))
    prepared = prepared.withColumns({c: F.col(c).cast("boolean") for c in ("is_val", "in_fit")})
    # boosting makes one pass per tree: train from a materialised frame
    frame = cut(prepared.select("event_id", "customer_id", "train_target_raw", "target_bin", "in_recent", "w_main", "w_susp",
                                "y_susp", "is_val", "in_fit", "is_test", "is_train_sample", "features", "features_fb"), True)
    return frame, [c for c in cols if c not in Mo.FB_COLS]


def _model_frame(spark, sf_dir):
    """All sampled train rows in partitions for boosting, and the feature names."""
    frame, cols = _prepared(spark, sf_dir)
    return Mo.dealt(frame.filter(F.col("is_train_sample"))), cols


@register("gbt_scores")
def q_gbt_scores(spark, sf_dir):
    """The five weighted GBTs with early stopping, validation scores, the
    product score, the searched blend, and the injection of the feedback ranks."""
    df, _ = _model_frame(spark, sf_dir)
    df = df.filter("in_fit")
    val = cut(Mo.score_family(Mo.fit_family(df), df.filter(F.col("is_val"))).drop("features", "features_fb"), True)
    w, _ = S.search_blend(val, "target_bin", ["s_main", "s_recent", "s_prod"])
    val = val.withColumn("s_blend", S.linear_blend(list(w), [F.col("s_main"), F.col("s_recent"), F.col("s_prod")]))
    val = S.average_rank(S.average_rank(val, "s_blend", "r_cb"), "s_fb", "r_fb")
    val = cut(S.history_flag(val, df.filter((F.col("train_target_raw") != -1) & ~F.col("is_val")), "hist"), True)
    alpha, _ = S.best_alpha(S.alpha_ap(val, "target_bin", "r_cb", "r_fb", "hist"))
    val = val.withColumn("predict", S.inject(F.col("r_cb"), F.col("r_fb"), F.col("hist"), alpha))
    return val.select("event_id", "target_bin", "s_main", "s_recent", "s_susp", "s_rg", "s_fb", "s_prod", "s_blend",
                      "predict")


@register("gbt_importance")
def q_gbt_importance(spark, sf_dir):
    """M2 + M15: refit MAIN on all sampled rows with its early-stopped size, importance share by group."""
    df, cols = _model_frame(spark, sf_dir)
    model = Mo.refit_gbt(df, "target_bin", "w_main", Mo.fit_gbt(df.filter("in_fit"), "target_bin", "w_main", "is_val"))
    rows = Mo.importance_by_group(model, cols)
    imp = spark.createDataFrame(rows, "feature string, grp string, importance double")
    tot = imp.agg(F.sum("importance").alias("_t"))
    from kestrel.functions.scalars import attach_row
    return attach_row(imp.groupBy("grp").agg(F.sum("importance").alias("importance"),
                                              F.count(F.lit(1)).alias("n_features")), tot) \
        .select("grp", "n_features", "importance", (F.col("importance") / F.col("_t")).alias("share"))


@register("w2v_embeddings")
def q_w2v_embeddings(spark, sf_dir):
    """Q5 + Q8: Word2Vec customer embeddings joined to the test events (missing -> 0)."""
    from kestrel.operators import sequences as Q
    from kestrel.sources.fixture import raw_events
    seqs = Q.last_n_sequences(Q.sequence_source(raw_events(spark, sf_dir)))
    emb = Mo.word2vec_embeddings(seqs, size=16)
    test = fixture_timeline(spark, sf_dir).filter(F.col("period") == "test").select(
        "event_id", "customer_id")
    out = Mo.join_embeddings(test, emb, 16)
    return out.select("event_id", "customer_id",
                      F.array_join(F.transform("embedding", lambda x: F.round(x, 3).cast("string")),
                                   ",").alias("embedding"))


@register("refit_run")
def q_refit_run(spark, sf_dir):
    """Entry C on fitted models (L2, M2-M6, M8-M11, M13, S7, S8, J8, J9): five models fitted and kept, blend and
    alpha searched, customer vectors written and read, fifteen refits on the second-stage sample, submission."""
    import uuid

    from kestrel.operators import sequences as Q
    from kestrel.plans.refit import first_stage, second_stage
    from kestrel.session import checkpoint_dir
    from kestrel.sources.fixture import labels_from_raw, raw_events
    from kestrel.sources.sinks import write_embeddings
    root = f"{checkpoint_dir(spark).rstrip('/')}/run-{uuid.uuid4().hex}"
    frame, cols = _prepared(spark, sf_dir)
    train, test = Mo.dealt(frame.filter(F.col("is_train_sample"))), frame.filter(F.col("is_test"))
    first_stage(train.filter("in_fit"), root, cols, vector_size=8)
    raw = raw_events(spark, sf_dir)
    write_embeddings(Mo.word2vec_embeddings(Q.last_n_sequences(Q.sequence_source(raw)), size=8), f"{root}/vectors")
    return second_stage(spark, root, train, test, labels_from_raw(raw), test.select("event_id"))


VECTORS_SQL = with_base("SELECT event_id, customer_id, " + ", ".join([
    _i("coalesce(len(v.embedding), (SELECT max(len(embedding)) FROM embeddings))", "size"),
    _d("coalesce(CAST(v.embedding[1] AS DOUBLE), 0)", "first"),
    _d("coalesce(CAST(v.embedding[len(v.embedding)] AS DOUBLE), 0)", "last")])
    + " FROM t LEFT JOIN embeddings v ON v.vec_id = t.customer_id WHERE period = 'test'")


@register("vectors_joined", VECTORS_SQL)
def q_vectors_joined(spark, sf_dir):
    """S8 + Q8: the given vectors written as customers' vectors, read back and joined to the test events."""
    import uuid

    from kestrel.session import checkpoint_dir
    from kestrel.sources.fixture import read_table
    from kestrel.sources.sinks import read_embeddings, write_embeddings
    path = f"{checkpoint_dir(spark).rstrip('/')}/vectors-{uuid.uuid4().hex}"
    given = read_table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("customer_id"), "embedding")
    write_embeddings(given, path)
    size = given.agg(F.max(F.size("embedding"))).first()[0]
    test = fixture_timeline(spark, sf_dir, by_customer=False).filter(F.col("period") == "test")
    out = Mo.join_embeddings(test.select("event_id", "customer_id"), read_embeddings(spark, path), size)
    return out.select("event_id", "customer_id", F.size("embedding").alias("size"),
                      F.element_at("embedding", 1).cast("double").alias("first"),
                      F.element_at("embedding", -1).cast("double").alias("last"))
