"""Hand-computed micro-timelines, one per semantic trap."""

import pytest

from micro import by_id, timeline


def test_edge_window_left_closed(spark):
    from kestrel.operators import customer as C
    from kestrel.operators.rolling import rolling_features
    tl = timeline(spark, [{"t": 0}, {"t": 900}, {"t": 900}, {"t": 901}, {"t": 3600}])
    df = rolling_features(C.lag_block(tl))
    got = by_id(df, "cnt_15min", "cnt_1h")
    # [t-900, t): t-p is in, ties at t are out
    assert got == {1: (0, 0), 2: (1, 1), 3: (1, 1), 4: (2, 3), 5: (0, 4)}
    delta = by_id(rolling_features(C.lag_block(tl), method="delta"), "cnt_15min", "cnt_1h")
    assert delta == got


def test_null_amount_mean(spark):
    from kestrel.operators import customer as C
    tl = timeline(spark, [{"operaton_amt": 10.0}, {"operaton_amt": None},
                          {"operaton_amt": 30.0}, {"operaton_amt": 50.0}])
    got = by_id(C.customer_features(tl, blocks=("amount",)), "cust_prev_amt_mean")
    # null row -> null; the null row counts in the denominator
    assert got[1] == 0.0 and got[2] is None
    assert got[3] == pytest.approx(10.0 / 2) and got[4] == pytest.approx(40.0 / 3)


def test_first_row_change_flags(spark):
    from kestrel.operators import customer as C
    a = C.lag_block(timeline(spark, [{"mcc_code": "5", "customer_id": 1},
                                     {"mcc_code": None, "customer_id": 2}]))
    got = by_id(a, "mcc_changed", "tz_changed", "os_changed")
    assert got[1] == (1, 0, 0)   # compares with -1: a present MCC counts as change (T10)
    assert got[2] == (0, 0, 0)   # missing MCC (-1) equals the -1 sentinel


def test_weekend_includes_friday(spark):
    days = ["2024-01-11 10:00:00", "2024-01-12 10:00:00", "2024-01-14 10:00:00",
            "2024-01-15 10:00:00"]  # Thu, Fri, Sun, Mon
    tl = timeline(spark, [{"event_dttm": d} for d in days])
    assert by_id(tl, "is_weekend") == {1: 0, 2: 1, 3: 1, 4: 0}


def test_impossible_travel(spark):
    from kestrel.operators import customer as C
    rows = [{"customer_id": 1, "t": 0, "timezone": 2}, {"customer_id": 1, "t": 3599, "timezone": 8},
            {"customer_id": 2, "t": 0, "timezone": 2}, {"customer_id": 2, "t": 3600, "timezone": 8},
            {"customer_id": 3, "t": 0, "timezone": 2}, {"customer_id": 3, "t": 0, "timezone": 8}]
    got = by_id(C.lag_block(timeline(spark, rows)), "impossible_travel")
    assert (got[2], got[4], got[6]) == (1, 0, 0)


def test_markov(spark):
    from kestrel.operators import customer as C
    tl = timeline(spark, [{"mcc_code": m} for m in ["1", "2", "1", "2", "1"]])
    got = by_id(C.customer_features(tl, blocks=("lag", "markov")), "markov_mcc_prob")
    # prev: -1,1,2,1,2 ; pair counts before: 0,0,0,1,1 ; prev counts before: 0,0,0,1,1
    assert [got[i] for i in range(1, 6)] == [0.0, 0.0, 0.0, 1.0, 1.0]


def test_feedback_excludes_current(spark):
    from kestrel.operators import customer as C
    tl = timeline(spark, [{"target": 1}, {"target": None}, {"target": 0}, {"target": 1}])
    got = by_id(C.customer_features(tl, blocks=("feedback",)),
                "cust_prev_red_lbl_cnt", "cust_prev_yellow_lbl_cnt", "sec_since_prev_red_lbl")
    assert got[1] == (0, 0, -1)
    assert got[2] == (1, 0, 60)
    assert got[3] == (1, 0, 120)
    assert got[4] == (1, 1, 180)


def test_device_share(spark):
    from kestrel.operators.device import device_features
    rows = [{"customer_id": c, "t": 60 * i} for i, c in enumerate([1, 2, 1, 3, 2])]
    got = by_id(device_features(timeline(spark, rows), materialize=False),
                "device_prev_ops", "device_prev_unique_customers", "device_prev_same_customer")
    assert got == {1: (0, 0, 0), 2: (1, 1, 0), 3: (2, 2, 1), 4: (3, 2, 0), 5: (4, 3, 1)}


def test_quantile_nearest_rank(spark):
    from kestrel.operators.priors import customer_profiles
    rows = [{"operaton_amt": float(v), "period": "pretrain"} for v in range(1, 11)]
    p = customer_profiles(timeline(spark, rows)).first()
    assert p["profile_amt_p95"] == 10.0          # sorted[round(9 * .95)] = sorted[9]
    assert p["profile_amt_median"] == 5.5


def test_ap_with_ties(spark):
    from kestrel.operators.scoring import average_precision
    df = spark.createDataFrame([(0.9, 1), (0.5, 0), (0.5, 1), (0.1, 0)], "s double, y int")
    assert average_precision(df, "s", "y").first()["ap"] == pytest.approx(1 / 2 + 1 / 3)


def test_average_rank_ties(spark):
    from kestrel.operators.scoring import average_rank
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 2.0), (4, 3.0)], "id int, s double")
    got = {r["id"]: r["r"] for r in average_rank(df, "s", "r").collect()}
    assert got == {1: 0.25, 2: 0.625, 3: 0.625, 4: 1.0}


def test_fingerprint_floor_mod(spark):
    tl = timeline(spark, [{"screen_size": None, "operating_system_type": None,
                           "accept_language": None}])
    assert tl.first()["device_fp_i"] == -100100001   # pmod(-1, 1000) = 999 (T4)


def test_unparsable_inputs(spark):
    tl = timeline(spark, [{"mcc_code": "n/a", "battery": "x", "event_dttm": "bad"}])
    r = tl.select("mcc_code_i", "battery_pct", "event_ts").first()
    assert (r["mcc_code_i"], r["battery_pct"], r["event_ts"]) == (-1, -1, None)


def test_sample_flags(spark):
    tl = timeline(spark, [{"target": 1}, {"period": "test"}])
    got = by_id(tl, "is_train_sample", "is_test", "train_target_raw")
    assert got[1] == (True, False, 1) and got[2] == (False, True, None)


def test_midnight_resets_day_and_hour(spark):
    from kestrel.operators import customer as C
    tl = timeline(spark, [{"event_dttm": "2024-01-15 23:59:58", "operaton_amt": 100.0},
                          {"event_dttm": "2024-01-15 23:59:59", "operaton_amt": 300.0},
                          {"event_dttm": "2024-01-16 00:00:00", "operaton_amt": 200.0}])
    got = by_id(C.customer_features(tl, blocks=("session_day",)),
                "events_before_today", "events_before_hour", "today_total_amount", "today_max_amount")
    assert got[2] == (1, 1, 100.0, 100.0)
    assert got[3] == (0, 0, 0.0, 0.0)      # new calendar day and new hour: both reset


def test_device_scope_part(spark):
    from pyspark.sql import functions as F
    from kestrel.operators.device import device_features
    rows = [{"customer_id": c, "t": 60 * i} for i, c in enumerate([1, 2, 3, 4])]
    tl = timeline(spark, rows).withColumn("part_id", F.when(F.col("customer_id") <= 2, 1).otherwise(2))
    got = by_id(device_features(tl, scope="part", materialize=False), "device_prev_ops")
    assert got == {1: 0, 2: 1, 3: 0, 4: 1}   # each part sees only its own customers
