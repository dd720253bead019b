"""Registered timeline queries: parsing, customer windows, rolling, feedback."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.plans.catalog import register
from kestrel.plans.oracle import on_variant, r6, with_base
from kestrel.plans.velocity import velocity_block, velocity_table, velocity_table_split
from kestrel.sources.timeline import fixture_timeline

# --------------------------------------------------------------------------
# velocity (flagship): W1, W2, W6, R1 (1h, 24h), R2 (24h), R7 burst ratio

VELOCITY_SQL = with_base("""
SELECT f.event_id,
       CAST(f.cust_prev_events AS BIGINT) AS cust_prev_events,
       CAST(f.cnt_prev_same_mcc AS BIGINT) AS cnt_prev_same_mcc,
       CAST(coalesce(f.gap, -1) AS BIGINT) AS sec_since_prev_event,
       CAST(r.cnt_1h AS BIGINT) AS cnt_1h,
       CAST(r.cnt_24h AS BIGINT) AS cnt_24h,
       {} AS amt_sum_24h,
       {}
         AS burst_ratio_1h_24h
FROM f JOIN r USING (event_id)
""".format(r6("r.amt_sum_24h"), r6("CASE WHEN r.cnt_24h > 0 THEN r.cnt_1h / r.cnt_24h ELSE 0 END")),
    extra_ctes="""
f AS (
  SELECT event_id, customer_id, ets, amt_abs, period,
         row_number() OVER (PARTITION BY customer_id ORDER BY event_ts, event_id) - 1
           AS cust_prev_events,
         row_number() OVER (PARTITION BY customer_id, mcc_code_i ORDER BY event_ts, event_id) - 1
           AS cnt_prev_same_mcc,
         ets - lag(ets) OVER (PARTITION BY customer_id ORDER BY event_ts, event_id) AS gap
  FROM t),
r AS (
  SELECT q.event_id,
         count(p.event_id) FILTER (WHERE p.ets >= q.ets - 3600) AS cnt_1h,
         count(p.event_id) AS cnt_24h,
         coalesce(sum(p.amt_abs), 0) AS amt_sum_24h
  FROM f q LEFT JOIN f p
    ON p.customer_id = q.customer_id AND p.period <> 'pretrain'
   AND p.ets >= q.ets - 86400 AND p.ets < q.ets
  WHERE q.period <> 'pretrain'
  GROUP BY q.event_id)
""")


@register("velocity", VELOCITY_SQL)
def q_velocity(spark, sf_dir):
    """Flagship per-event velocity table; customers above the task bound are split by time."""
    return velocity_block(fixture_timeline(spark, sf_dir))


@register("velocity_split", VELOCITY_SQL)
def q_velocity_split(spark, sf_dir):
    """The same table with every customer of over 20 events split into time buckets."""
    return velocity_table_split(fixture_timeline(spark, sf_dir), bucket_rows=20)


@register("velocity_windows", VELOCITY_SQL)
def q_velocity_windows(spark, sf_dir):
    """Flagship per-event velocity table, plain per-customer windows."""
    return velocity_table(fixture_timeline(spark, sf_dir))


def _velocity_variant(variant: str, plan: str, fn):
    @register(f"velocity_{plan}_{variant}", on_variant(VELOCITY_SQL, variant))
    def query(spark, sf_dir):
        return fn(fixture_timeline(spark, sf_dir, variant=variant))
    query.__doc__ = f"The velocity table by its {plan} plan on the {variant} variant of the timeline."


for _v in ("bad", "dense"):
    _velocity_variant(_v, "windows", velocity_table)
    _velocity_variant(_v, "split", lambda tl: velocity_table_split(tl, bucket_rows=50))




# --------------------------------------------------------------------------
# Shared SQL fragments

WC = "PARTITION BY customer_id ORDER BY event_ts, event_id"
WP = WC + " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


def _wk(*keys: str, frame: str = "") -> str:
    return ("PARTITION BY customer_id, " + ", ".join(keys)
            + " ORDER BY event_ts, event_id" + (" " + frame if frame else ""))


def _i(expr: str, name: str) -> str:
    return f"CAST({expr} AS BIGINT) AS {name}"


def _d(expr: str, name: str) -> str:
    return f"{r6(expr)} AS {name}"


def _timeline(spark, sf_dir):
    return fixture_timeline(spark, sf_dir)


# --------------------------------------------------------------------------
# parse_rows: S1-S3, P1-P14, P20, L1 (mix-hash variant), L5, L7

@register("parse_rows", with_base("""
SELECT event_id, period,
  """ + ",\n  ".join([
    _i("ets", "ets"), _d("amt", "amt"), _i("session_id", "session_id"),
    _i("event_type_nm", "event_type_nm"), _i("event_desc", "event_desc"),
    _i("channel_indicator_type", "channel_indicator_type"),
    _i("channel_indicator_sub_type", "channel_indicator_sub_type"),
    _i("currency_iso_cd", "currency_iso_cd"), _i("pos_cd", "pos_cd"),
    _i("timezone", "timezone"), _i("operating_system_type", "operating_system_type"),
    _i("phone_voip_call_state", "phone_voip_call_state"),
    _i("web_rdp_connection", "web_rdp_connection"), _i("mcc_code_i", "mcc_code_i"),
    _i("developer_tools_i", "developer_tools_i"), _i("compromised_i", "compromised_i"),
    _i("accept_language_i", "accept_language_i"), _i("browser_language_i", "browser_language_i"),
    _i("battery_pct", "battery_pct"), _i("os_ver_major", "os_ver_major"),
    _i("screen_w", "screen_w"), _i("screen_h", "screen_h"),
    _i("accept_language_missing", "accept_language_missing"),
    _i("lang_mismatch", "lang_mismatch"), _i("device_fp_i", "device_fp_i"),
    _i("hour", "hour"), _i("isodow(event_ts)", "weekday"), _i("day(event_ts)", "day"),
    _i("month(event_ts)", "month"), _i("dayofyear(event_ts)", "day_of_year"),
    _i("floor(ets / 86400)", "event_day_number"),
    _i("isodow(event_ts) >= 5", "is_weekend"),
    _i("hour >= 22 OR hour < 6", "is_night"), _i("hour < 6", "is_night_early"),
    _d("sin(hour * 2 * pi() / 24)", "hour_sin"), _d("cos(hour * 2 * pi() / 24)", "hour_cos"),
    _d("ln(1 + amt_abs)", "amt_log_abs"), _d("amt_abs", "amt_abs"),
    _i("amt < 0", "amt_is_negative"),
    _i("least(greatest(floor(ln(1 + amt_abs) * 4), 0), 63)", "amt_bucket"),
    _i("amt_abs % 1000 = 0 OR amt_abs % 500 = 0", "is_round_amount"),
    _i("screen_w * screen_h", "screen_pixels"),
    _d("CASE WHEN screen_h > 0 AND screen_w > 0 THEN screen_w / screen_h ELSE 0 END", "screen_ratio"),
    _i("phone_voip_call_state = 1 AND web_rdp_connection = 1", "voip_rdp_combo"),
    _i("phone_voip_call_state = 1 OR web_rdp_connection = 1 OR compromised_i = 1 "
       "OR developer_tools_i = 1", "any_risk_flag"),
    _i("compromised_i = 1 AND developer_tools_i = 1", "compromised_devtools"),
    _i("null_device_count", "null_device_count"),
    _i("train_target_raw", "train_target_raw"),
    _i("is_train_sample", "is_train_sample"),
    _i("CASE WHEN is_train_sample THEN train_target_raw = 1 END", "target_bin"),
    _i("period = 'test'", "is_test"),
    _d("CASE WHEN is_train_sample THEN CASE train_target_raw WHEN 1 THEN 10.0 "
       "WHEN 0 THEN 2.5 ELSE 1.0 END END", "w_main"),
    _d("CASE WHEN is_train_sample THEN CASE WHEN train_target_raw <> -1 THEN 6.0 "
       "ELSE 1.2 END END", "w_susp"),
    _i("CASE WHEN is_train_sample THEN train_target_raw <> -1 END", "y_susp"),
    _i("is_train_sample AND (event_ts >= TIMESTAMP '2024-01-15 00:00:00' "
       "OR train_target_raw <> -1)", "in_recent"),
  ]) + """
FROM s
""", extra_ctes="""
s AS (
  SELECT *,
    (screen_w = -1)::INT + (screen_h = -1)::INT + (battery_pct = -1)::INT + (os_ver_major = -1)::INT
    + (phone_voip_call_state = -1)::INT + (web_rdp_connection = -1)::INT + (timezone = -1)::INT
    + (operating_system_type = -1)::INT + (developer_tools_i = -1)::INT + (compromised_i = -1)::INT
      AS null_device_count,
    coalesce(period = 'train' AND (train_target_raw <> -1 OR (train_target_raw = -1 AND (
      (event_ts >= TIMESTAMP '2024-01-17 00:00:00'
         AND (event_id * 1000003 + customer_id * 7919 + 42) % 5 = 0)
      OR (event_ts < TIMESTAMP '2024-01-17 00:00:00'
         AND (event_id * 1000003 + customer_id * 7919 + 59) % 15 = 0)))), false)
      AS is_train_sample
  FROM t)
"""))
def q_parse_rows(spark, sf_dir):
    """Typed timeline with every per-row feature, sample flags and weights."""
    from kestrel.functions.parse import null_pattern_columns
    from kestrel.operators.sampling import training_columns
    tl = _timeline(spark, sf_dir)
    tl = tl.withColumns({**null_pattern_columns(), **training_columns()})
    keep = ["event_id", "period", "ets", "amt", "session_id", "event_type_nm", "event_desc",
            "channel_indicator_type", "channel_indicator_sub_type", "currency_iso_cd", "pos_cd",
            "timezone", "operating_system_type", "phone_voip_call_state", "web_rdp_connection",
            "mcc_code_i", "developer_tools_i", "compromised_i", "accept_language_i",
            "browser_language_i", "battery_pct", "os_ver_major", "screen_w", "screen_h",
            "accept_language_missing", "lang_mismatch", "device_fp_i", "hour", "weekday", "day",
            "month", "day_of_year", "event_day_number", "is_weekend", "is_night",
            "is_night_early", "hour_sin", "hour_cos", "amt_log_abs", "amt_abs",
            "amt_is_negative", "amt_bucket", "is_round_amount", "screen_pixels", "screen_ratio",
            "voip_rdp_combo", "any_risk_flag", "compromised_devtools", "null_device_count",
            "train_target_raw", "is_train_sample", "target_bin", "is_test",
            "w_main", "w_susp", "y_susp", "in_recent"]
    return tl.select(*keep)


# --------------------------------------------------------------------------
# cust_counts: W1-W4 (oracle: correlated counts over a customer self-join)

_COUNT_KEYS = [
    ("cnt_prev_same_type", "event_type_nm"), ("cnt_prev_same_desc", "event_desc"),
    ("cnt_prev_same_mcc", "mcc_code_i"), ("cnt_prev_same_subtype", "channel_indicator_sub_type"),
    ("cnt_prev_same_session", "session_id"), ("cust_prev_same_device", "device_fp_i"),
    ("cust_prev_same_timezone", "timezone"), ("cust_prev_same_os", "operating_system_type"),
    ("cnt_prev_same_currency", "currency_iso_cd"),
    ("cust_prev_same_channel_type", "channel_indicator_type"),
]
_LOG_ONLY = ["pos_cd", "developer_tools_i", "compromised_i", "phone_voip_call_state",
             "web_rdp_connection"]
_LOG_ALL = ["event_type_nm", "event_desc", "channel_indicator_type",
            "channel_indicator_sub_type", "currency_iso_cd", "mcc_code_i", "pos_cd", "timezone",
            "session_id", "operating_system_type", "developer_tools_i", "compromised_i",
            "phone_voip_call_state", "web_rdp_connection"]
_NOVELTY = [("is_new_device_for_customer", "cust_prev_same_device"),
            ("is_new_desc_for_customer", "cnt_prev_same_desc"),
            ("is_new_mcc_for_customer", "cnt_prev_same_mcc"),
            ("is_new_timezone_for_customer", "cust_prev_same_timezone"),
            ("is_new_subtype_for_customer", "cnt_prev_same_subtype"),
            ("is_new_os_for_customer", "cust_prev_same_os")]
_EARLIER = "(p.event_ts < q.event_ts OR (p.event_ts = q.event_ts AND p.event_id < q.event_id))"

_cnt_exprs = ["count(p.event_id) AS cust_prev_events"]
_cnt_exprs += [f"count(p.event_id) FILTER (WHERE p.{k} = q.{k}) AS {n}" for n, k in _COUNT_KEYS]
_cnt_exprs += [f"count(p.event_id) FILTER (WHERE p.{k} = q.{k}) AS c_{k}" for k in _LOG_ONLY]
_cnt_exprs += ["count(p.event_id) FILTER (WHERE p.channel_indicator_sub_type = "
               "q.channel_indicator_sub_type AND p.operating_system_type = "
               "q.operating_system_type) AS c_combo"]
_cnt_src = dict((k, n) for n, k in _COUNT_KEYS)
_cnt_out = ["q_id AS event_id", _i("cust_prev_events", "cust_prev_events")]
_cnt_out += [_i(n, n) for n, _ in _COUNT_KEYS]
_cnt_out += [_d(f"ln(1 + {_cnt_src.get(k, 'c_' + k)})", f"{k}_log_cnt") for k in _LOG_ALL]
_cnt_out += [_d("ln(1 + c_combo)", "ch_dev_combo_log_cnt")]
_cnt_out += [_i(f"{c} = 0", n) for n, c in _NOVELTY]

CUST_COUNTS_SQL = with_base(
    "SELECT " + ",\n  ".join(_cnt_out) + "\nFROM c",
    extra_ctes="c AS (SELECT q.event_id AS q_id, " + ", ".join(_cnt_exprs)
    + f" FROM t q LEFT JOIN t p ON p.customer_id = q.customer_id AND {_EARLIER}"
    + " GROUP BY q.event_id)")


@register("cust_counts", CUST_COUNTS_SQL)
def q_cust_counts(spark, sf_dir):
    """Prior counts per customer x key, log counts, novelty flags."""
    from kestrel.operators import customer as C
    df = C.counts_block(_timeline(spark, sf_dir))
    cols = (["event_id", "cust_prev_events"] + [n for n, _ in _COUNT_KEYS]
            + [f"{k}_log_cnt" for k in _LOG_ALL] + ["ch_dev_combo_log_cnt"]
            + [n for n, _ in _NOVELTY])
    return df.select(*cols)


# --------------------------------------------------------------------------
# cust_lags: W5-W9, W19, W20

_SINCE = [("sec_since_prev_same_type", "event_type_nm"), ("sec_since_prev_same_desc", "event_desc"),
          ("sec_since_prev_same_mcc", "mcc_code_i"), ("sec_since_prev_same_device", "device_fp_i"),
          ("sec_since_prev_same_currency", "currency_iso_cd"),
          ("sec_since_prev_same_channel_type", "channel_indicator_type")]

CUST_LAGS_SQL = with_base("""
SELECT event_id,
  """ + ",\n  ".join([
    _i("coalesce(p_mcc, -1)", "prev_mcc_code_i"),
    _i("coalesce(ets - p_ets, -1)", "sec_since_prev_event"),
    _d("amt - coalesce(p_amt, 0)", "amt_delta_prev"),
    _i("mcc_code_i <> coalesce(p_mcc, -1)", "mcc_changed"),
    _i("session_id <> coalesce(p_sess, -1)", "session_changed"),
    _i("coalesce(operating_system_type <> p_os, false)", "os_changed"),
    _i("coalesce(screen_w <> p_sw, false)", "screen_changed"),
    _i("coalesce(timezone <> p_tz, false)", "tz_changed"),
    _i("coalesce(abs(timezone - p_tz), 0)", "tz_jump_magnitude"),
    _i("coalesce(abs(timezone - p_tz), 0) > 2 AND coalesce(ets - p_ets, -1) > 0 "
       "AND coalesce(ets - p_ets, -1) < 3600", "impossible_travel"),
  ] + [_i(f"coalesce(ets - p_{k}, -1)", n) for n, k in _SINCE]) + """
FROM l
""", extra_ctes="l AS (SELECT *, " + ", ".join(
    [f"lag(ets) OVER ({WC}) AS p_ets", f"lag(amt) OVER ({WC}) AS p_amt",
     f"lag(mcc_code_i) OVER ({WC}) AS p_mcc", f"lag(session_id) OVER ({WC}) AS p_sess",
     f"lag(operating_system_type) OVER ({WC}) AS p_os", f"lag(screen_w) OVER ({WC}) AS p_sw",
     f"lag(timezone) OVER ({WC}) AS p_tz"]
    + [f"lag(ets) OVER ({_wk(k)}) AS p_{k}" for _, k in _SINCE]) + " FROM t)")


@register("cust_lags", CUST_LAGS_SQL)
def q_cust_lags(spark, sf_dir):
    """Lags, gaps, change flags, timezone jumps."""
    from kestrel.operators import customer as C
    df = C.lag_block(_timeline(spark, sf_dir))
    return df.select("event_id", "prev_mcc_code_i", "sec_since_prev_event", "amt_delta_prev",
                     "mcc_changed", "session_changed", "os_changed", "screen_changed",
                     "tz_changed", "tz_jump_magnitude", "impossible_travel",
                     *[n for n, _ in _SINCE])


# --------------------------------------------------------------------------
# cust_amounts: W10-W14

_DEC = "CAST(amt AS DECIMAL(28,6))"
CUST_AMOUNTS_SQL = with_base("""
SELECT event_id,
  """ + ",\n  ".join([
    _d("m", "cust_prev_amt_mean"), _d("sd", "cust_prev_amt_std"),
    _d("CASE WHEN abs(m) > 0.01 THEN amt / m ELSE 0 END", "amt_to_prev_mean"),
    _d("CASE WHEN sd > 1 THEN (amt - m) / sd ELSE 0 END", "amt_zscore"),
    _d("mx", "cust_prev_max_amt"),
    _d("CASE WHEN mx > 0.01 THEN amt_abs / mx ELSE 0 END", "amt_vs_prev_max"),
    _d("dm", "cust_prev_mean_amt_same_desc"),
    _d("CASE WHEN abs(dm) > 0.01 THEN amt_abs / dm ELSE 0 END", "amt_vs_same_desc_mean"),
  ]) + """
FROM g2
""", extra_ctes=f"""
g AS (
  SELECT *,
    row_number() OVER ({WC}) AS idx,
    CAST(coalesce(sum({_DEC}) OVER ({WP}), 0) AS DOUBLE) AS s1,
    CAST(coalesce(sum({_DEC} * {_DEC}) OVER ({WP}), 0) AS DOUBLE) AS s2,
    max(amt_abs) OVER ({WP}) AS pmax,
    lag(amt_abs) OVER ({WC}) AS prev_abs,
    CAST(coalesce(sum({_DEC}) OVER ({_wk('event_desc', frame='ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING')}), 0) AS DOUBLE) AS dsum,
    row_number() OVER ({_wk('event_desc')}) - 1 AS dcnt
  FROM t),
g1 AS (
  SELECT *,
    CASE WHEN idx > 1 THEN CASE WHEN amt IS NULL THEN NULL ELSE s1 / (idx - 1) END ELSE 0 END AS m,
    CASE WHEN prev_abs IS NULL THEN 0 ELSE pmax END AS mx,
    CASE WHEN dcnt > 0 THEN CASE WHEN amt IS NULL THEN NULL ELSE dsum / dcnt END ELSE 0 END AS dm
  FROM g),
g2 AS (
  SELECT *,
    CASE WHEN idx > 2 THEN CASE WHEN amt IS NULL THEN NULL
         ELSE sqrt(greatest(s2 / (idx - 1) - m * m, 0)) END ELSE 0 END AS sd
  FROM g1)
""")


@register("cust_amounts", CUST_AMOUNTS_SQL)
def q_cust_amounts(spark, sf_dir):
    """Expanding mean / std / max and same-desc mean of amounts."""
    from kestrel.operators import customer as C
    df = C.customer_features(_timeline(spark, sf_dir), blocks=("amount",))
    return df.select("event_id", "cust_prev_amt_mean", "cust_prev_amt_std", "amt_to_prev_mean",
                     "amt_zscore", "cust_prev_max_amt", "amt_vs_prev_max",
                     "cust_prev_mean_amt_same_desc", "amt_vs_same_desc_mean")


# --------------------------------------------------------------------------
# cust_session_day: W15-W18 (oracle: correlated self-join aggregates)

CUST_SESSION_DAY_SQL = with_base("""
SELECT event_id,
  """ + ",\n  ".join([
    _d("CASE WHEN amt IS NULL THEN NULL ELSE sess_sum END", "session_amt_before"),
    _i("ets - sess_first", "sec_since_session_start"),
    _i("day_n", "events_before_today"),
    _d("CASE WHEN amt IS NULL THEN NULL ELSE day_sum END", "today_total_amount"),
    _d("day_max", "today_max_amount"),
    _d("CASE WHEN amt IS NOT NULL AND day_sum > 1 THEN amt_abs / day_sum ELSE 1 END",
       "today_amt_vs_daily_norm"),
    _i("hour_n", "events_before_hour"),
    _d("(ets - first_ets) / 86400.0", "days_since_first_event"),
    _d("CASE WHEN floor((ets - first_ets) / 86400) > 0 THEN (n_prev + 1) / floor((ets - first_ets) / 86400) ELSE 1 END",
       "cust_events_per_day"),
  ]) + """
FROM a
""", extra_ctes=f"""
a AS (
  SELECT q.event_id, any_value(q.amt) AS amt, any_value(q.amt_abs) AS amt_abs, any_value(q.ets) AS ets,
    count(p.event_id) AS n_prev,
    coalesce(sum(p.amt) FILTER (WHERE p.session_id = q.session_id), 0) AS sess_sum,
    least(any_value(q.ets), coalesce(min(p.ets) FILTER (WHERE p.session_id = q.session_id), any_value(q.ets))) AS sess_first,
    count(p.event_id) FILTER (WHERE p.event_date = q.event_date) AS day_n,
    coalesce(sum(p.amt_abs) FILTER (WHERE p.event_date = q.event_date), 0) AS day_sum,
    coalesce(max(p.amt_abs) FILTER (WHERE p.event_date = q.event_date), 0) AS day_max,
    count(p.event_id) FILTER (WHERE date_trunc('hour', p.event_ts) = date_trunc('hour', q.event_ts)) AS hour_n,
    least(any_value(q.ets), coalesce(min(p.ets), any_value(q.ets))) AS first_ets
  FROM t q LEFT JOIN t p ON p.customer_id = q.customer_id AND {_EARLIER}
  GROUP BY q.event_id)
""")


@register("cust_session_day", CUST_SESSION_DAY_SQL)
def q_cust_session_day(spark, sf_dir):
    """Session / day / hour accumulations, tenure and event rate."""
    from kestrel.operators import customer as C
    df = C.customer_features(_timeline(spark, sf_dir), blocks=("session_day",))
    return df.select("event_id", "session_amt_before", "sec_since_session_start",
                     "events_before_today", "today_total_amount", "today_max_amount",
                     "today_amt_vs_daily_norm", "events_before_hour", "days_since_first_event",
                     "cust_events_per_day")


# --------------------------------------------------------------------------
# markov: W21

MARKOV_SQL = with_base("""
SELECT event_id,
  """ + ",\n  ".join([
    _d("pair_n / greatest(prev_n, 1)", "markov_mcc_prob"),
    _d("-ln(greatest(pair_n / greatest(prev_n, 1), 1e-6))", "markov_mcc_surprise"),
  ]) + """
FROM m2
""", extra_ctes=f"""
m1 AS (SELECT *, coalesce(lag(mcc_code_i) OVER ({WC}), -1) AS pm FROM t),
m2 AS (
  SELECT q.event_id,
    count(p.event_id) FILTER (WHERE p.pm = q.pm) AS prev_n,
    count(p.event_id) FILTER (WHERE p.pm = q.pm AND p.mcc_code_i = q.mcc_code_i) AS pair_n
  FROM m1 q LEFT JOIN m1 p ON p.customer_id = q.customer_id AND {_EARLIER}
  GROUP BY q.event_id)
""")


@register("markov", MARKOV_SQL)
def q_markov(spark, sf_dir):
    """Per-customer MCC transition probability and surprise."""
    from kestrel.operators import customer as C
    df = C.customer_features(_timeline(spark, sf_dir), blocks=("markov",))
    return df.select("event_id", "markov_mcc_prob", "markov_mcc_surprise")


# --------------------------------------------------------------------------
# moving_avg: W22, W23 (oracle: ordinal self-join on the customer index)

MOVING_AVG_SQL = with_base("""
SELECT event_id,
  """ + ",\n  ".join([_d(f"a{n}", f"amt_avg_{n}") for n in (5, 10, 50, 100)] + [
    _d("coalesce(a5, 0) - coalesce(a50, 0)", "amt_momentum"), _d("h5", "hour_mean_5")]) + """
FROM mv
""", extra_ctes=f"""
ix AS (SELECT event_id, customer_id, amt, hour, row_number() OVER ({WC}) AS i FROM t),
mv AS (
  SELECT q.event_id,
  """ + ",\n  ".join(
    [f"CASE WHEN count(p.amt) FILTER (WHERE p.i >= q.i - {n}) = {n} "
     f"THEN avg(p.amt) FILTER (WHERE p.i >= q.i - {n}) END AS a{n}" for n in (5, 10, 50, 100)]
    + ["CASE WHEN count(p.hour) FILTER (WHERE p.i >= q.i - 5) = 5 "
       "THEN avg(p.hour) FILTER (WHERE p.i >= q.i - 5) END AS h5"]) + """
  FROM ix q LEFT JOIN ix p ON p.customer_id = q.customer_id AND p.i < q.i AND p.i >= q.i - 100
  GROUP BY q.event_id)
""")


@register("moving_avg", MOVING_AVG_SQL)
def q_moving_avg(spark, sf_dir):
    """Count-based moving averages of amount and hour, momentum."""
    from kestrel.operators import customer as C
    df = C.customer_features(_timeline(spark, sf_dir), blocks=("moving_avg",))
    return df.select("event_id", "amt_avg_5", "amt_avg_10", "amt_avg_50", "amt_avg_100",
                     "amt_momentum", "hour_mean_5")


# --------------------------------------------------------------------------
# device: D1-D6 (oracle: naive device windows in global time order)

_WD = "PARTITION BY device_fp_i ORDER BY event_ts, event_id"


def _wd(*keys):
    return "PARTITION BY device_fp_i, " + ", ".join(keys) + " ORDER BY event_ts, event_id"


DEVICE_SQL = with_base("""
SELECT event_id,
  """ + ",\n  ".join([
    _i("ops", "device_prev_ops"), _i("uc", "device_prev_unique_customers"),
    _i("us", "device_prev_unique_sessions"),
    _d("ln(1 + ops)", "device_prev_ops_log"), _d("ln(1 + uc)", "device_prev_unique_customers_log"),
    _d("ln(1 + us)", "device_prev_unique_sessions_log"),
    _d("CASE WHEN ops > 0 THEN uc / (ops + 1e-6) ELSE 0 END", "device_customer_diversity"),
    _i("sc", "device_prev_same_customer"), _i("sd", "device_prev_same_desc"),
    _i("sm", "device_prev_same_mcc"), _i("stz", "device_prev_same_timezone"),
    _i("sst", "device_prev_same_subtype"),
    _d("dm", "cust_prev_mean_amt_same_device"),
    _d("CASE WHEN abs(dm) > 0.01 THEN amt_abs / dm ELSE 0 END", "amt_vs_same_device_mean"),
  ]) + """
FROM d2
""", extra_ctes=f"""
d1 AS (
  SELECT *,
    row_number() OVER ({_WD}) - 1 AS ops,
    row_number() OVER ({_wd('customer_id')}) - 1 AS sc,
    row_number() OVER ({_wd('session_id')}) - 1 AS ss,
    row_number() OVER ({_wd('event_desc')}) - 1 AS sd,
    row_number() OVER ({_wd('mcc_code_i')}) - 1 AS sm,
    row_number() OVER ({_wd('timezone')}) - 1 AS stz,
    row_number() OVER ({_wd('channel_indicator_sub_type')}) - 1 AS sst,
    coalesce(sum(CAST(amt_abs AS DECIMAL(38,6))) OVER ({_wd('customer_id')}
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS dsum
  FROM t),
d2 AS (
  SELECT *,
    coalesce(sum(CAST(sc = 0 AS INTEGER)) OVER ({_WD} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS uc,
    coalesce(sum(CAST(ss = 0 AS INTEGER)) OVER ({_WD} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS us,
    CASE WHEN sc > 0 THEN CASE WHEN amt IS NULL THEN NULL ELSE CAST(dsum AS DOUBLE) / sc END ELSE 0 END AS dm
  FROM d1)
""")


@register("device", DEVICE_SQL)
def q_device(spark, sf_dir):
    """Cross-customer device statistics via the two-level prefix scan."""
    from kestrel.operators.device import device_features
    df = device_features(_timeline(spark, sf_dir)).drop("customer_id")
    return df.select("event_id", "device_prev_ops", "device_prev_unique_customers",
                     "device_prev_unique_sessions", "device_prev_ops_log",
                     "device_prev_unique_customers_log", "device_prev_unique_sessions_log",
                     "device_customer_diversity", "device_prev_same_customer",
                     "device_prev_same_desc", "device_prev_same_mcc",
                     "device_prev_same_timezone", "device_prev_same_subtype",
                     "cust_prev_mean_amt_same_device", "amt_vs_same_device_mean")


# --------------------------------------------------------------------------
# feedback: F1-F5

FEEDBACK_SQL = with_base("""
SELECT event_id,
  """ + ",\n  ".join([
    _i("r", "cust_prev_red_lbl_cnt"), _i("y", "cust_prev_yellow_lbl_cnt"),
    _i("r + y", "cust_prev_labeled_cnt"),
    _d("(r + 0.1) / (r + y + 1.0)", "cust_prev_red_lbl_rate"),
    _d("(y + 0.1) / (r + y + 1.0)", "cust_prev_yellow_lbl_rate"),
    _d("(r + y + 0.1) / (n + 1.0)", "cust_prev_susp_lbl_rate"),
    _i("r > 0", "cust_prev_any_red_flag"), _i("y > 0", "cust_prev_any_yellow_flag"),
    _i("coalesce(ets - rts, -1)", "sec_since_prev_red_lbl"),
    _i("coalesce(ets - yts, -1)", "sec_since_prev_yellow_lbl"),
    _i("dr + dy", "cnt_prev_labeled_same_desc"), _i("dr", "cnt_prev_red_same_desc_lbl"),
    _i("dy", "cnt_prev_yellow_same_desc_lbl"),
    _d("(dr + 0.1) / (dr + dy + 1.0)", "red_rate_prev_same_desc_lbl"),
  ]) + """
FROM fb
""", extra_ctes=f"""
fb AS (
  SELECT q.event_id, any_value(q.ets) AS ets,
    count(p.event_id) AS n,
    count(p.event_id) FILTER (WHERE p.train_target_raw = 1) AS r,
    count(p.event_id) FILTER (WHERE p.train_target_raw = 0) AS y,
    count(p.event_id) FILTER (WHERE p.train_target_raw = 1 AND p.event_desc = q.event_desc) AS dr,
    count(p.event_id) FILTER (WHERE p.train_target_raw = 0 AND p.event_desc = q.event_desc) AS dy,
    max(p.ets) FILTER (WHERE p.train_target_raw = 1) AS rts,
    max(p.ets) FILTER (WHERE p.train_target_raw = 0) AS yts
  FROM t q LEFT JOIN t p ON p.customer_id = q.customer_id AND {_EARLIER}
  GROUP BY q.event_id)
""")


@register("feedback", FEEDBACK_SQL)
def q_feedback(spark, sf_dir):
    """Label-history counts, smoothed rates, flags, time since last label."""
    from kestrel.operators import customer as C
    df = C.customer_features(_timeline(spark, sf_dir), blocks=("feedback",))
    return df.select("event_id", "cust_prev_red_lbl_cnt", "cust_prev_yellow_lbl_cnt",
                     "cust_prev_labeled_cnt", "cust_prev_red_lbl_rate",
                     "cust_prev_yellow_lbl_rate", "cust_prev_susp_lbl_rate",
                     "cust_prev_any_red_flag", "cust_prev_any_yellow_flag",
                     "sec_since_prev_red_lbl", "sec_since_prev_yellow_lbl",
                     "cnt_prev_labeled_same_desc", "cnt_prev_red_same_desc_lbl",
                     "cnt_prev_yellow_same_desc_lbl", "red_rate_prev_same_desc_lbl")


# --------------------------------------------------------------------------
# target_encoding: F6 (causal target encoding of MCC within the customer)

TARGET_ENCODING_SQL = with_base("""
SELECT q.event_id,
  """ + r6("(coalesce(sum(p.y), 0) + 10.0 * any_value(coalesce(g.p, 0))) / (count(p.y) + 10.0)") + """ AS te_mcc_code_i
FROM ty q LEFT JOIN g ON g.day = CAST(q.event_ts AS DATE)
LEFT JOIN ty p ON p.customer_id = q.customer_id AND p.mcc_code_i = q.mcc_code_i
  AND (p.event_ts < q.event_ts OR (p.event_ts = q.event_ts AND p.event_id < q.event_id))
GROUP BY q.event_id
""", extra_ctes="""
ty AS (SELECT *, CAST(train_target_raw = 1 AS DOUBLE) AS y FROM t),
days AS (SELECT DISTINCT CAST(event_ts AS DATE) AS day FROM ty),
g AS (SELECT d.day, avg(e.y) AS p FROM days d LEFT JOIN ty e ON CAST(e.event_ts AS DATE) < d.day GROUP BY d.day)
""")


@register("target_encoding", TARGET_ENCODING_SQL)
def q_target_encoding(spark, sf_dir):
    """expanding smoothed RED rate per (customer, MCC), current row excluded."""
    from kestrel.operators.customer import target_encoding
    tl = _timeline(spark, sf_dir).withColumn(
        "y_red", (F.col("train_target_raw") == 1).cast("double"))
    df = target_encoding(tl, "mcc_code_i", target="y_red", alpha=10.0, name="te_mcc_code_i")
    return df.select("event_id", "te_mcc_code_i")


# --------------------------------------------------------------------------
# null_flags (P14) and median_fill (P18, A8: exact median)

from kestrel.functions.parse import NULL_DEVICE_COLS  # noqa: E402

NULL_FLAGS_SQL = with_base("SELECT event_id, " + ", ".join(
    [_i(f"{c} = -1", f"null_{c}") for c in NULL_DEVICE_COLS]
    + [_i(" + ".join(f"CAST({c} = -1 AS INTEGER)" for c in NULL_DEVICE_COLS), "null_device_count")]) + " FROM t")


@register("null_flags", NULL_FLAGS_SQL)
def q_null_flags(spark, sf_dir):
    """The ten missing-device flags and their sum."""
    from kestrel.functions.parse import null_pattern_columns
    flags = null_pattern_columns()
    return fixture_timeline(spark, sf_dir, by_customer=False).withColumns(flags).select("event_id", *flags)


MEDIAN_SQL = with_base("SELECT event_id, " + _d("coalesce(amt, (SELECT median(amt) FROM t))", "amt") + ", "
                       + _d("coalesce(b, (SELECT median(b) FROM m))", "battery") + " FROM m", extra_ctes="""
m AS (SELECT *, CASE WHEN battery_pct >= 0 THEN battery_pct END AS b FROM t)""")


@register("median_fill", MEDIAN_SQL)
def q_median_fill(spark, sf_dir):
    """Nulls filled with the exact median of their column."""
    from kestrel.operators.priors import fill_with_median
    tl = fixture_timeline(spark, sf_dir, by_customer=False).select(
        "event_id", "amt", F.when(F.col("battery_pct") >= 0, F.col("battery_pct")).alias("battery"))
    return fill_with_median(tl, ["amt", "battery"])
