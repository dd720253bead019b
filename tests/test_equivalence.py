"""Equivalence of the scale-oriented forms with their naive definitions."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF001


@pytest.fixture(scope="module")
def tl(spark):
    from kestrel.sources.timeline import fixture_timeline
    df = fixture_timeline(spark, SF001).cache()
    yield df
    df.unpersist()  # other modules look at plans over the same rows


def _hot(tl):
    """Hour-truncated times (many ties) and half the rows on one device."""
    return (tl.withColumn("ets", F.floor(F.col("ets") / 3600) * 3600)
              .withColumn("event_ts", F.timestamp_seconds("ets"))
              .withColumn("device_fp_i", F.when(F.col("event_id") % 2 == 0, F.lit(7))
                          .otherwise(F.col("device_fp_i"))))


@pytest.mark.parametrize("split", [{"bucket_seconds": 7200}, {"bucket_rows": 40}, {}])
def test_two_level_prefix_matches_naive(tl, split):
    from kestrel.operators.prefix import PrefixSpec, exclusive_prefix
    df = _hot(tl)
    specs = [PrefixSpec("ops", None, F.lit(1)), PrefixSpec("same_c", "customer_id", F.lit(1)),
             PrefixSpec("amt_c", "customer_id", F.col("amt_abs").cast("decimal(38,6)"),
                        "decimal(38,6)"),
             PrefixSpec("uc", None, None, distinct_of="customer_id")]
    got = exclusive_prefix(df, ["device_fp_i"], specs, **split)
    w = Window.partitionBy("device_fp_i").orderBy("ets", "event_id")
    wc = Window.partitionBy("device_fp_i", "customer_id").orderBy("ets", "event_id")
    naive = df.select("event_id", "device_fp_i", "ets", (F.row_number().over(w) - 1).alias("ops_n"),
                      (F.row_number().over(wc) - 1).alias("same_n"),
                      F.coalesce(F.sum(F.col("amt_abs").cast("decimal(38,6)")).over(
                          wc.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("amt_n"),
                      (F.row_number().over(wc) == 1).cast("int").alias("_first"))
    naive = naive.withColumn("uc_n", F.coalesce(F.sum("_first").over(
        w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    j = got.join(naive.drop("device_fp_i", "ets"), "event_id")
    bad = j.filter((F.col("ops") != F.col("ops_n")) | (F.col("same_c") != F.col("same_n"))
                   | (F.col("amt_c") != F.col("amt_n")) | (F.col("uc") != F.col("uc_n")))
    assert j.count() == df.count() and bad.count() == 0


def test_delta_rolling_matches_frames(tl):
    from kestrel.operators import customer as C
    from kestrel.operators.rolling import rolling_features
    df = C.lag_block(_hot(tl))
    live = F.col("period") != "pretrain"
    cols = ["cnt_15min", "cnt_1h", "cnt_6h", "cnt_24h", "cnt_7d", "amt_sum_1h", "amt_sum_24h",
            "voip_cnt_15min", "tz_change_cnt_24h"]
    a = rolling_features(df, "frame", live).select("event_id", *cols)
    b = rolling_features(df, "delta", live).select("event_id", *[F.col(c).alias(c + "_d") for c in cols])
    j = a.join(b, "event_id")
    cond = None
    for c in cols:
        e = F.abs(F.col(c) - F.col(c + "_d")) > 1e-9
        cond = e if cond is None else cond | e
    assert j.count() == df.count() and j.filter(cond).count() == 0


def test_stacked_priors_match_per_key(tl):
    from kestrel.operators.priors import PRIOR_KEYS, prior_source, stacked_priors
    src = prior_source(tl)
    st = stacked_priors(src)
    for k in PRIOR_KEYS[:4]:
        one = src.groupBy(k).agg(F.count(F.lit(1)).alias("cnt"), F.count("target").alias("lbl"),
                                 F.coalesce(F.sum("target"), F.lit(0)).alias("red"))
        a = sorted((r[0], r[1], r[2], r[3]) for r in one.collect())
        b = sorted((r["key_value"], r["cnt"], r["lbl"], r["red"]) for r in
                   st.filter(F.col("key_name") == k).collect())
        assert a == b


def test_rank_and_ap_vs_brute_force(spark):
    from kestrel.operators.scoring import average_precision, average_rank
    rng = np.random.default_rng(7)
    s = np.round(rng.random(400), 2)          # many ties
    y = (rng.random(400) < 0.2).astype(int)
    df = spark.createDataFrame([(i, float(a), int(b)) for i, (a, b) in enumerate(zip(s, y))],
                               "id int, s double, y int")
    # brute force average-tie ranks
    ranks = np.array([(np.sum(s < v) + (np.sum(s == v) + 1) / 2) / len(s) for v in s])
    got = {r["id"]: r["r"] for r in average_rank(df, "s", "r").collect()}
    assert np.allclose([got[i] for i in range(len(s))], ranks)
    # brute force step-wise AP over distinct thresholds
    ap = 0.0
    for v in sorted(set(s), reverse=True):
        sel = s >= v
        ap += y[s == v].sum() * (y[sel].sum() / sel.sum())
    ap /= y.sum()
    assert average_precision(df, "s", "y").first()["ap"] == pytest.approx(ap)


def test_exact_quantiles_vs_numpy(spark):
    from kestrel.operators.profiling import exact_quantiles
    rng = np.random.default_rng(3)
    v = np.round(rng.exponential(100, 1001), 1)
    df = spark.createDataFrame([(int(i % 3), float(x)) for i, x in enumerate(v)], "g int, x double")
    got = {(r["g"], r["q"]): r["value_q"] for r in exact_quantiles(df, "x", ["g"], [0.5, 0.95, 0.99]).collect()}
    for g in range(3):
        arr = np.array([x for i, x in enumerate(v) if i % 3 == g])
        for q in (0.5, 0.95, 0.99):
            assert got[(g, q)] == pytest.approx(np.percentile(arr, q * 100))


def test_last_n_sequences_vs_rank(spark, tl):
    from kestrel.operators import sequences as Q
    from kestrel.sources.fixture import raw_events
    src = Q.sequence_source(raw_events(spark, SF001))
    got = Q.last_n_sequences(src, n=7, bucket_seconds=3600)
    w = Window.partitionBy("customer_id").orderBy(F.col("ets").desc(), F.col("event_id").desc())
    ref = (src.withColumn("r", F.row_number().over(w)).filter("r <= 7")
              .groupBy("customer_id").agg(F.sort_array(F.collect_list(
                  F.struct("ets", "event_id", "mcc"))).alias("s"))
              .select("customer_id", F.transform("s", lambda x: x["mcc"]).alias("ref")))
    j = got.join(ref, "customer_id")
    assert j.count() == ref.count() and j.filter(F.col("mcc_seq") != F.col("ref")).count() == 0


def test_hot_key_is_split(tl):
    from kestrel.operators.prefix import time_buckets
    df = _hot(tl)
    b = time_buckets(df, ["device_fp_i"], "ets", "_b", bucket_rows=40, bucket_seconds=None)
    per_key = b.groupBy("device_fp_i").agg(F.countDistinct("_b").alias("nb"), F.count(F.lit(1)).alias("n"))
    hot = per_key.filter(F.col("n") > 40).collect()
    cold = per_key.filter(F.col("n") <= 40).collect()
    assert hot and all(r["nb"] >= r["n"] // 80 for r in hot)   # ~n / bucket_rows buckets
    assert all(r["nb"] == 1 for r in cold)                     # cold keys stay whole


@pytest.mark.parametrize("bucket_rows", [25, None])
def test_split_velocity_matches_windows_with_hot_customer(tl, bucket_rows):
    """Half of all rows on one customer (a hot key), hour-truncated times (ties)."""
    from kestrel.plans.velocity import velocity_table, velocity_table_split
    hot = (_hot(tl).withColumn("customer_id", F.when(F.col("event_id") % 2 == 0, F.lit(1))
                                 .otherwise(F.col("customer_id"))))
    cols = ["cust_prev_events", "cnt_prev_same_mcc", "sec_since_prev_event", "cnt_1h", "cnt_24h",
            "amt_sum_24h", "burst_ratio_1h_24h"]
    a = velocity_table(hot).select("event_id", *cols)
    split = velocity_table_split(hot, bucket_rows=bucket_rows)
    b = split.select(
        "event_id", *[F.col(c).alias(c + "_s") for c in cols])
    j = a.join(b, "event_id")
    cond = None
    for c in cols:
        e = ~F.col(c).eqNullSafe(F.col(c + "_s")) & (F.abs(F.col(c) - F.col(c + "_s")) > 1e-6)
        e = e | (F.col(c).isNull() != F.col(c + "_s").isNull())
        cond = e if cond is None else cond | e
    assert j.count() == a.count() and j.filter(cond).count() == 0


def test_plans_agree_on_null_times_long_decimals_and_large_ids(spark):
    """Every velocity plan and both rolling forms, on rows that used to tell them apart."""
    from kestrel.operators.rolling import COUNT_WINDOWS, SUM_WINDOWS, rolling_features
    from kestrel.plans.velocity import velocity_table, velocity_table_split

    rows = [(1 + k % 3, 2**63 - 1 - k, None if k % 5 == 0 else 1_000_000 + 600 * (k // 2), 0.000000001 * (k + 1) + k % 4)
            for k in range(60)]
    tl = spark.createDataFrame(rows, "customer_id long, event_id long, ets long, amt_abs double")
    tl = tl.withColumns({"event_ts": F.timestamp_seconds("ets"), "period": F.lit("train"),
                         "mcc_code_i": (F.col("event_id") % 2).cast("int"), "phone_voip_call_state": F.lit(1),
                         "tz_changed": F.lit(1)})
    plans = [velocity_table(tl), velocity_table_split(tl), velocity_table_split(tl, bucket_rows=5)]
    a, b, c = (sorted(map(tuple, p.collect())) for p in plans)
    assert a == b == c and len(a) == 60
    null_ids = {r[1] for r in rows if r[2] is None}
    assert all(r[4] == 0 and r[5] == 0 and r[6] == 0.0 for r in a if r[0] in null_ids)
    cols = ["event_id", *[n for n, _ in COUNT_WINDOWS + SUM_WINDOWS]]
    frame, delta = (sorted(map(tuple, rolling_features(tl, m).select(*cols).collect())) for m in ("frame", "delta"))
    assert frame == delta and all(sum(r[1:]) == 0 for r in frame if r[0] in null_ids)


def test_many_reds_in_one_category(spark):
    from kestrel.operators.profiling import red_concentration
    tr = spark.range(3_000).selectExpr("cast(id % 7 AS int) AS mcc_code_i", "'RED' AS cls")
    got = {r["top_n"]: (r["cum_red"], round(r["share_pct"], 6)) for r in red_concentration(tr).collect()}
    assert got[1] == (429, 14.3) and got[50] == (3000, 100.0)


def test_epoch_views_are_uniform_and_independent(spark):
    """Starts fill their range evenly, and views, epochs and customers do not follow one another."""
    from kestrel.operators import sequences as Q
    n, room = 4000, 20
    seqs = spark.range(n).select(F.col("id").alias("customer_id"), F.sequence(F.lit(0), F.lit(room + 9)).alias("mcc_seq"))
    got = {(r["customer_id"], r["epoch"], r["view"]): r for r in Q.epoch_views(seqs, 2, fields=["mcc"], sub_len=10).collect()}
    assert len(got) == 4 * n and all(r["mcc_seq"] == list(range(r["start"], r["start"] + 10)) for r in got.values())
    starts = {k: np.array([got[(c, *k)]["start"] for c in range(n)]) for k in ((0, 1), (0, 2), (1, 1), (1, 2))}
    for x in starts.values():
        counts = np.bincount(x, minlength=room)
        assert len(counts) == room and ((counts - n / room) ** 2).sum() / (n / room) < 45  # chi-square, 19 degrees
        assert abs(np.corrcoef(x[1:], x[:-1])[0, 1]) < 0.07
    for a in starts:
        for b in starts:
            if a < b:
                assert abs(np.corrcoef(starts[a], starts[b])[0, 1]) < 0.07
                assert len(set((starts[a] - starts[b]).tolist())) > room  # no constant shift
    short = spark.createDataFrame([(1, [5, 6])], "customer_id long, mcc_seq array<int>")
    assert {(r["start"], tuple(r["mcc_seq"])) for r in Q.epoch_views(short, 2, fields=["mcc"]).collect()} == {(0, (5, 6))}


def test_production_sampling_hash(tl):
    """L1: the kept negatives are those that xxHash64 of (event, customer, seed) picks, computed apart from Spark."""
    import struct

    import xxhash

    from kestrel.sources import fixture
    from kestrel.sources.timeline import SEED, sample_flags

    def mixed(event, customer, seed):
        h = xxhash.xxh64(struct.pack("<q", event), seed=42).intdigest()
        h = xxhash.xxh64(struct.pack("<q", customer), seed=h).intdigest()
        h = xxhash.xxh64(struct.pack("<i", seed), seed=h).intdigest()
        return h - (1 << 64) if h >= 1 << 63 else h

    base = tl.select("event_id", "customer_id", "period", "target", "event_ts")
    rows = sample_flags(base, hash_kind="xxhash").collect()
    border = fixture.NEG_SAMPLE_BORDER
    for r in rows:
        negative = r["period"] == "train" and r["target"] is None
        late = str(r["event_ts"]) >= border
        n, seed = (5, SEED) if late else (15, SEED + 17)
        assert r["keep_green"] == (negative and mixed(r["event_id"], r["customer_id"], seed) % n == 0)
    kept = sum(r["keep_green"] for r in rows)
    assert 10 < kept < len(rows) / 4
