"""Causality (no look-ahead) and partition-count invariance."""

from pyspark.sql import functions as F

from conftest import SF001

FEATURES = ["cust_prev_events", "cnt_prev_same_mcc", "sec_since_prev_event", "cust_prev_amt_mean",
            "cust_prev_max_amt", "events_before_today", "markov_mcc_prob", "amt_avg_5",
            "cust_prev_red_lbl_cnt", "sec_since_prev_red_lbl", "cnt_1h", "cnt_24h", "amt_sum_24h",
            "unique_mcc_24h", "tz_change_cnt_24h"]
DEVICE = ["device_prev_ops", "device_prev_unique_customers", "device_prev_same_customer",
          "cust_prev_mean_amt_same_device"]


def _feats(tl):
    from kestrel.operators.device import device_features
    from kestrel.plans.features import timeline_block
    blk = timeline_block(tl).select("event_id", *FEATURES)
    dev = device_features(tl, materialize=False).select("event_id", *DEVICE)
    return blk.join(dev, "event_id")


def _rows(df):
    return {r["event_id"]: tuple(r[c] for c in FEATURES + DEVICE) for r in df.collect()}


def test_truncation_does_not_change_the_past(spark):
    """Features of rows before a cut-off are identical whether or not later rows exist."""
    from kestrel.sources.timeline import fixture_timeline
    tl = fixture_timeline(spark, SF001).cache()
    cut = tl.select(F.expr("percentile_approx(ets, 0.6)")).first()[0]
    full = _rows(_feats(tl).join(tl.filter(F.col("ets") <= cut).select("event_id"), "event_id"))
    part = _rows(_feats(tl.filter(F.col("ets") <= cut)))
    assert full.keys() == part.keys() and len(full) > 100
    tl.unpersist()
    assert full == part


def test_partition_count_invariance(spark):
    from kestrel.sources.timeline import fixture_timeline
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        a = _rows(_feats(fixture_timeline(spark, SF001)))
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        b = _rows(_feats(fixture_timeline(spark, SF001).repartition(5)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b
