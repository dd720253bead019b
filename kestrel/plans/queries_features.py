"""Registered queries: rolling velocity, profiles, priors, assembled features."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.plans.catalog import register
from kestrel.plans.oracle import on_variant, with_base
from kestrel.plans.queries_timeline import WC, _d, _i
from kestrel.sources.timeline import fixture_timeline

_ROLL_COLS = ["cnt_15min", "cnt_1h", "cnt_6h", "cnt_24h", "cnt_7d", "amt_sum_15min",
              "amt_sum_1h", "amt_sum_24h", "max_amt_last_24h", "voip_cnt_15min",
              "had_voip_before_txn", "unique_mcc_1h", "unique_mcc_24h", "mcc_scatter_ratio",
              "tz_change_cnt_24h", "amt_ratio_24h", "burst_ratio_1h_24h",
              "spend_concentration_1h", "burst_ratio_15m_1h", "amt_vs_1h_sum", "amt_vs_24h_sum"]

# rolling: R1-R7 (oracle: self-join on the customer with [t - p, t) bounds)
_win = {"15min": 900, "1h": 3600, "6h": 21600, "24h": 86400, "7d": 604800}


def _in(p: int) -> str:
    return f"p.ets >= q.ets - {p}"


ROLLING_SQL = with_base("""
SELECT event_id,
  """ + ",\n  ".join(
    [_i(f"cnt_{k}", f"cnt_{k}") for k in _win]
    + [_d(f"s_{k}", f"amt_sum_{k}") for k in ("15min", "1h", "24h")]
    + [_d("mx", "max_amt_last_24h"), _i("voip", "voip_cnt_15min"),
       _i("voip > 0", "had_voip_before_txn"), _i("u1", "unique_mcc_1h"),
       _i("u24", "unique_mcc_24h"),
       _d("CASE WHEN u24 > 0 THEN u1 / u24 ELSE 0 END", "mcc_scatter_ratio"),
       _i("tzc", "tz_change_cnt_24h"),
       _d("CASE WHEN s_24h > 1 THEN amt_abs / s_24h ELSE 1 END", "amt_ratio_24h"),
       _d("CASE WHEN cnt_24h > 0 THEN cnt_1h / cnt_24h ELSE 0 END", "burst_ratio_1h_24h"),
       _d("CASE WHEN s_24h > 1 THEN s_1h / s_24h ELSE 0 END", "spend_concentration_1h"),
       _d("CASE WHEN cnt_1h > 0 THEN cnt_15min / cnt_1h ELSE 0 END", "burst_ratio_15m_1h"),
       _d("CASE WHEN s_1h > 1 THEN amt_abs / (s_1h + 1) ELSE 0 END", "amt_vs_1h_sum"),
       _d("CASE WHEN s_24h > 1 THEN amt_abs / (s_24h + 1) ELSE 0 END", "amt_vs_24h_sum")]) + """
FROM rr
""", extra_ctes=f"""
tz AS (
  SELECT *, CAST(coalesce(timezone <> lag(timezone) OVER ({WC}), false) AS INTEGER) AS tzch
  FROM t),
live AS (SELECT * FROM tz WHERE period <> 'pretrain'),
rr AS (
  SELECT q.event_id, any_value(q.amt_abs) AS amt_abs,
  """ + ",\n  ".join(
    [f"count(p.event_id) FILTER (WHERE {_in(v)}) AS cnt_{k}" for k, v in _win.items()]
    + [f"CAST(coalesce(sum(CAST(p.amt_abs AS DECIMAL(38,6))) FILTER (WHERE {_in(_win[k])}), 0)"
       f" AS DOUBLE) AS s_{k}"
       for k in ("15min", "1h", "24h")]
    + [f"max(p.amt_abs) FILTER (WHERE {_in(86400)}) AS mx",
       f"count(p.event_id) FILTER (WHERE {_in(900)} AND p.phone_voip_call_state = 1) AS voip",
       f"count(DISTINCT p.mcc_code_i) FILTER (WHERE {_in(3600)}) AS u1",
       f"count(DISTINCT p.mcc_code_i) FILTER (WHERE {_in(86400)}) AS u24",
       f"coalesce(sum(p.tzch) FILTER (WHERE {_in(86400)}), 0) AS tzc"]) + """
  FROM live q LEFT JOIN live p
    ON p.customer_id = q.customer_id AND p.ets < q.ets AND p.ets >= q.ets - 604800
  GROUP BY q.event_id)
""")


def _rolling(spark, sf_dir, method, variant=None):
    from kestrel.operators import customer as C
    from kestrel.operators.rolling import rolling_features
    tl = fixture_timeline(spark, sf_dir, variant=variant)
    df = C.customer_features(tl, blocks=("lag",))
    df = rolling_features(df, method=method, live=F.col("period") != "pretrain")
    return df.filter(F.col("period") != "pretrain").select("event_id", *_ROLL_COLS)


@register("rolling", ROLLING_SQL)
def q_rolling(spark, sf_dir):
    """R1-R7 with RANGE frames over epoch seconds."""
    return _rolling(spark, sf_dir, "frame")


@register("rolling_delta", ROLLING_SQL)
def q_rolling_delta(spark, sf_dir):
    """R1-R7 with the linear-time delta-event form for counts and sums."""
    return _rolling(spark, sf_dir, "delta")


def _rolling_variant(variant: str, method: str):
    @register(f"rolling_{method}_{variant}", on_variant(ROLLING_SQL, variant))
    def query(spark, sf_dir):
        return _rolling(spark, sf_dir, method, variant)
    query.__doc__ = f"R1-R7 ({method} form) on the {variant} variant of the timeline."


for _v in ("bad", "dense"):
    for _m in ("frame", "delta"):
        _rolling_variant(_v, _m)


# --------------------------------------------------------------------------
# profile: A1, A2 (pretrain profile per customer)

PROFILE_SQL = with_base("""
SELECT customer_id,
  """ + ",\n  ".join([
    _i("n_rows", "profile_txn_count"), _d("mean_amt", "profile_amt_mean"),
    _d("coalesce(sd, 0)", "profile_amt_std"), _d("med", "profile_amt_median"),
    _d("mx", "profile_amt_max"),
    _d("CASE WHEN n_amt > 0 THEN amts[CAST(round((n_amt - 1) * 0.95) AS BIGINT) + 1] END",
       "profile_amt_p95"),
    _i("n_mcc", "profile_n_unique_mcc"), _d("coalesce(hm, 12)", "profile_hour_mean"),
    _d("n_rows / 365.0", "profile_avg_daily_txns")]) + """
FROM pa
""", extra_ctes="""
pa AS (
  SELECT customer_id, count(*) AS n_rows, avg(amt) AS mean_amt, stddev_samp(amt) AS sd,
         median(amt) AS med, max(amt) AS mx, count(amt) AS n_amt,
         list_sort(list(amt) FILTER (WHERE amt IS NOT NULL)) AS amts,
         count(DISTINCT mcc_code_i) AS n_mcc, avg(hour) AS hm
  FROM t WHERE period = 'pretrain' GROUP BY customer_id)
""")


@register("profile", PROFILE_SQL)
def q_profile(spark, sf_dir):
    """A1-A2: per-customer pretrain profile with exact median and nearest-rank p95."""
    from kestrel.operators.priors import customer_profiles
    tl = fixture_timeline(spark, sf_dir)
    return customer_profiles(tl.filter(F.col("period") == "pretrain"))


# --------------------------------------------------------------------------
# priors: A4 + A6 (one stacked aggregation; oracle = one GROUP BY per key)

_PK = ["event_desc", "mcc_code_i", "timezone", "operating_system_type",
       "channel_indicator_sub_type", "event_type_nm", "pos_cd", "accept_language_i",
       "device_fp_i"]
_FULL_PK = ["event_desc", "mcc_code_i", "event_type_nm", "pos_cd", "timezone",
            "accept_language_i", "device_fp_i"]
_PAIRS = [("mcc_code_i", "event_type_nm"), ("event_desc", "channel_indicator_sub_type"),
          ("pos_cd", "event_type_nm"), ("mcc_code_i", "channel_indicator_sub_type")]


def _prior_sql(keys, border: bool) -> str:
    where = "period = 'train'" + (" AND event_ts < TIMESTAMP '2024-01-19 00:00:00'"
                                  if border else "")
    parts = [f"""SELECT '{k}' AS key_name, CAST({k} AS BIGINT) AS key_value,
  count(*) AS cnt, count(target) AS lbl, coalesce(sum(target), 0) AS red
FROM t WHERE {where} GROUP BY {k}""" for k in keys]
    return with_base("""
SELECT key_name, """ + ", ".join([
        _i("key_value", "key_value"), _i("cnt", "cnt"), _i("lbl", "lbl"), _i("red", "red"),
        _d("(red + 1.0) / (cnt + 200.0)", "red_rate"),
        _d("(red + 1.0) / (lbl + 2.0)", "red_share")]) + "\nFROM (\n"
        + "\nUNION ALL\n".join(parts) + "\n) u")


@register("priors", _prior_sql(_PK, True))
def q_priors(spark, sf_dir):
    """A4 + A6: smoothed RED priors for 9 keys, train rows before the border."""
    from kestrel.operators.priors import prior_source, stacked_priors
    return stacked_priors(prior_source(fixture_timeline(spark, sf_dir, by_customer=False)))


@register("priors_full", _prior_sql(_FULL_PK, False))
def q_priors_full(spark, sf_dir):
    """Full-train prior variant (no border, 7 keys)."""
    from kestrel.operators.priors import FULL_PRIOR_KEYS, prior_source, stacked_priors
    return stacked_priors(prior_source(fixture_timeline(spark, sf_dir, by_customer=False), None), FULL_PRIOR_KEYS)


PAIR_PRIORS_SQL = with_base("""
SELECT pair_name, """ + ", ".join([
    _i("a_value", "a_value"), _i("b_value", "b_value"), _i("cnt", "cnt"), _i("lbl", "lbl"),
    _i("red", "red"), _d("(red + 1.0) / (cnt + 200.0)", "red_rate"),
    _d("(red + 1.0) / (lbl + 2.0)", "red_share")]) + "\nFROM (\n" + "\nUNION ALL\n".join(
    f"""SELECT '{a}x{b}' AS pair_name, CAST({a} AS BIGINT) AS a_value, CAST({b} AS BIGINT) AS b_value,
  count(*) AS cnt, count(target) AS lbl, coalesce(sum(target), 0) AS red
FROM t WHERE period = 'train' AND event_ts < TIMESTAMP '2024-01-19 00:00:00' GROUP BY {a}, {b}"""
    for a, b in _PAIRS) + "\n) u")


@register("pair_priors", PAIR_PRIORS_SQL)
def q_pair_priors(spark, sf_dir):
    """A5: interaction priors of 4 key pairs in one aggregation."""
    from kestrel.operators.priors import prior_source, stacked_pair_priors
    return stacked_pair_priors(prior_source(fixture_timeline(spark, sf_dir, by_customer=False)))


# --------------------------------------------------------------------------
# prior_join: J5, J6, P17, P18 on the sampled rows

def _prior_join_sql() -> str:
    border = "period = 'train' AND event_ts < TIMESTAMP '2024-01-19 00:00:00'"
    ctes = [f"""
nv AS (
  SELECT event_id, customer_id, event_desc, mcc_code_i, timezone, operating_system_type,
    channel_indicator_sub_type, event_type_nm, pos_cd, accept_language_i, device_fp_i, period,
    train_target_raw, event_ts,
    CAST(row_number() OVER (PARTITION BY customer_id, event_desc ORDER BY event_ts, event_id) = 1 AS INTEGER) AS nd,
    CAST(row_number() OVER (PARTITION BY customer_id, timezone ORDER BY event_ts, event_id) = 1 AS INTEGER) AS ntz,
    CAST(row_number() OVER (PARTITION BY customer_id, mcc_code_i ORDER BY event_ts, event_id) = 1 AS INTEGER) AS nm,
    CAST(row_number() OVER (PARTITION BY customer_id, device_fp_i ORDER BY event_ts, event_id) = 1 AS INTEGER) AS ndv
  FROM t),
smp AS (
  SELECT * FROM nv WHERE period = 'test' OR (period = 'train' AND (train_target_raw <> -1 OR (
      (event_ts >= TIMESTAMP '2024-01-17 00:00:00' AND (event_id * 1000003 + customer_id * 7919 + 42) % 5 = 0)
      OR (event_ts < TIMESTAMP '2024-01-17 00:00:00' AND (event_id * 1000003 + customer_id * 7919 + 59) % 15 = 0)))))"""]
    sel = ["s.event_id"]
    joins = []
    cols = []
    for k in _PK:
        ctes.append(f"""
p_{k} AS (
  SELECT {k} AS kv, count(*) AS cnt, (coalesce(sum(target), 0) + 1.0) / (count(*) + 200.0) AS rr,
         (coalesce(sum(target), 0) + 1.0) / (count(target) + 2.0) AS rs
  FROM t WHERE {border} GROUP BY {k})""")
        joins.append(f"LEFT JOIN p_{k} ON p_{k}.kv = s.{k}")
        sel += [f"p_{k}.cnt AS prior_{k}_cnt", f"p_{k}.rr AS prior_{k}_red_rate",
                f"p_{k}.rs AS prior_{k}_red_share"]
        cols += [f"prior_{k}_cnt", f"prior_{k}_red_rate", f"prior_{k}_red_share"]
    for a, b in _PAIRS:
        nm = f"{a}x{b}"
        ctes.append(f"""
q_{nm} AS (
  SELECT {a} AS av, {b} AS bv, (coalesce(sum(target), 0) + 1.0) / (count(*) + 200.0) AS rr,
         (coalesce(sum(target), 0) + 1.0) / (count(target) + 2.0) AS rs
  FROM t WHERE {border} GROUP BY {a}, {b})""")
        joins.append(f"LEFT JOIN q_{nm} ON q_{nm}.av = s.{a} AND q_{nm}.bv = s.{b}")
        sel += [f"q_{nm}.rr AS prior_{nm}_red_rate", f"q_{nm}.rs AS prior_{nm}_red_share"]
        cols += [f"prior_{nm}_red_rate", f"prior_{nm}_red_share"]
    sel += ["s.nd", "s.ntz", "s.nm", "s.ndv"]
    ctes.append("j AS (SELECT " + ", ".join(sel) + " FROM smp s " + " ".join(joins) + ")")
    ctes.append("mu AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}" for c in cols) + " FROM j)")
    ctes.append("f AS (SELECT j.event_id, j.nd, j.ntz, j.nm, j.ndv, " + ", ".join(
        f"coalesce(CAST({c} AS DOUBLE), m_{c}) AS {c}" for c in cols) + " FROM j CROSS JOIN mu)")
    out = ["event_id"] + [_d(c, c) for c in cols] + [
        _d("prior_event_desc_red_rate * (1 + nd)", "risk_new_desc_x_prior"),
        _d("prior_timezone_red_rate * (1 + ntz)", "risk_new_tz_x_prior"),
        _d("prior_mcc_code_i_red_rate * (1 + nm)", "risk_new_mcc_x_prior"),
        _d("prior_device_fp_i_red_rate * (1 + ndv)", "risk_new_device_x_prior")]
    return with_base("SELECT " + ",\n  ".join(out) + "\nFROM f", ",".join(c.strip().rstrip(",") for c in ctes))


@register("prior_join", _prior_join_sql())
def q_prior_join(spark, sf_dir):
    """Priors joined to the sampled rows, mean-filled, risk products."""
    from kestrel.operators import customer as C
    from kestrel.operators.priors import RISK_PRODUCTS, attach_priors, prior_source
    tl = fixture_timeline(spark, sf_dir)
    df = C.customer_features(tl, blocks=("counts",))
    rows = df.filter(F.col("is_train_sample") | F.col("is_test"))
    out = attach_priors(rows, prior_source(tl))
    cols = [c for c in out.columns if c.startswith("prior_")] + [r[2] for r in RISK_PRODUCTS]
    return out.select("event_id", *cols)




# --------------------------------------------------------------------------
# interactions: A3, R8, P16 on the sampled rows (oracle composed from
# independent SQL pieces: windows, rolling self-join, device windows, profile)

_SMP_WHERE = ("period = 'test' OR (period = 'train' AND (train_target_raw <> -1 OR ("
              "(event_ts >= TIMESTAMP '2024-01-17 00:00:00' AND (event_id * 1000003 + customer_id * 7919 + 42) % 5 = 0)"
              " OR (event_ts < TIMESTAMP '2024-01-17 00:00:00' AND (event_id * 1000003 + customer_id * 7919 + 59) % 15 = 0))))")
_DEC = "CAST(amt AS DECIMAL(28,6))"
_WP = WC + " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
_W5 = WC + " ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING"

INTERACTIONS_SQL = with_base("""
SELECT z.event_id, """ + ",\n  ".join([
    _d("CASE WHEN abs(pm) > 0.01 THEN amt / pm ELSE 0 END", "amt_over_profile_mean"),
    _d("CASE WHEN abs(pp) > 0.01 THEN amt / pp ELSE 0 END", "amt_over_profile_p95"),
    _d("CASE WHEN ps > 1 THEN (amt - pm) / ps ELSE 0 END", "amt_profile_zscore"),
    _d("coalesce(a5, 0) - coalesce(m, 0)", "amt_drift_5"),
    _d("abs(coalesce(h5, 12) - coalesce(ph, 12))", "hour_drift"),
    _d("CASE WHEN pd > 0.1 THEN coalesce(c1, 0) / pd ELSE 0 END", "velocity_ratio_1h"),
    _d("CASE WHEN pn > 0 THEN coalesce(u24, 0) / pn ELSE 0 END", "mcc_diversity_ratio"),
    _d("nd * CASE WHEN ops > 0 THEN uc / (ops + 1e-6) ELSE 0 END", "new_device_diversity_risk"),
    _d("risk * CASE WHEN c24 > 0 THEN c1 / c24 ELSE 0 END", "risk_velocity_interaction"),
    _d("risk * CASE WHEN s24 > 1 THEN s1 / s24 ELSE 0 END", "risk_spend_concentration"),
    _i("ntz = 1 AND coalesce(tzc, 0) > 0 AND gap > 0 AND gap < 3600", "rapid_timezone_switch"),
]) + """
FROM z
""", extra_ctes=f"""
cw AS (
  SELECT *,
    row_number() OVER ({WC}) AS idx,
    CAST(coalesce(sum({_DEC}) OVER ({_WP}), 0) AS DOUBLE) AS s1p,
    CASE WHEN count(amt) OVER ({_W5}) = 5 THEN avg(amt) OVER ({_W5}) END AS a5,
    CASE WHEN count(hour) OVER ({_W5}) = 5 THEN avg(hour) OVER ({_W5}) END AS h5,
    CAST(row_number() OVER (PARTITION BY customer_id, device_fp_i ORDER BY event_ts, event_id) = 1 AS INTEGER) AS nd,
    CAST(row_number() OVER (PARTITION BY customer_id, timezone ORDER BY event_ts, event_id) = 1 AS INTEGER) AS ntz,
    ets - lag(ets) OVER ({WC}) AS gap,
    CAST(coalesce(timezone <> lag(timezone) OVER ({WC}), false) AS INTEGER) AS tzch,
    CAST(phone_voip_call_state = 1 OR web_rdp_connection = 1 OR compromised_i = 1 OR developer_tools_i = 1 AS DOUBLE) AS risk
  FROM t),
cm AS (SELECT *, CASE WHEN idx > 1 THEN CASE WHEN amt IS NULL THEN NULL ELSE s1p / (idx - 1) END ELSE 0 END AS m FROM cw),
lv AS (SELECT * FROM cm WHERE period <> 'pretrain'),
rr AS (
  SELECT q.event_id,
    count(p.event_id) FILTER (WHERE p.ets >= q.ets - 3600) AS c1,
    count(p.event_id) AS c24,
    CAST(coalesce(sum(CAST(p.amt_abs AS DECIMAL(38,6))) FILTER (WHERE p.ets >= q.ets - 3600), 0) AS DOUBLE) AS s1,
    CAST(coalesce(sum(CAST(p.amt_abs AS DECIMAL(38,6))), 0) AS DOUBLE) AS s24,
    count(DISTINCT p.mcc_code_i) AS u24,
    coalesce(sum(p.tzch), 0) AS tzc
  FROM lv q LEFT JOIN lv p ON p.customer_id = q.customer_id AND p.ets < q.ets AND p.ets >= q.ets - 86400
  GROUP BY q.event_id),
dv AS (
  SELECT event_id, ops, coalesce(sum(CAST(sc = 0 AS INTEGER)) OVER (PARTITION BY device_fp_i ORDER BY event_ts, event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS uc
  FROM (SELECT *, row_number() OVER (PARTITION BY device_fp_i ORDER BY event_ts, event_id) - 1 AS ops,
          row_number() OVER (PARTITION BY device_fp_i, customer_id ORDER BY event_ts, event_id) - 1 AS sc FROM t)),
pf AS (
  SELECT customer_id, avg(amt) AS pm, coalesce(stddev_samp(amt), 0) AS ps,
    CASE WHEN count(amt) > 0 THEN list_sort(list(amt) FILTER (WHERE amt IS NOT NULL))[CAST(round((count(amt) - 1) * 0.95) AS BIGINT) + 1] END AS pp,
    coalesce(avg(hour), 12) AS ph, count(DISTINCT mcc_code_i) AS pn, count(*) / 365.0 AS pd
  FROM t WHERE period = 'pretrain' GROUP BY customer_id),
z AS (
  SELECT cm.event_id, cm.amt, cm.a5, cm.m, cm.h5, cm.nd, cm.ntz, cm.gap, cm.risk,
    coalesce(pf.pm, 0) AS pm, coalesce(pf.ps, 0) AS ps, coalesce(pf.pp, 0) AS pp, coalesce(pf.ph, 0) AS ph,
    coalesce(pf.pn, 0) AS pn, coalesce(pf.pd, 0) AS pd,
    rr.c1, rr.c24, rr.s1, rr.s24, rr.u24, rr.tzc, dv.ops, dv.uc
  FROM cm LEFT JOIN pf USING (customer_id) LEFT JOIN rr USING (event_id) LEFT JOIN dv USING (event_id)
  WHERE {_SMP_WHERE})
""")


# build on duplicated ids (T1, J4): each id once, the higher-priority period wins

FEATURES_DUP_SQL = on_variant(with_base("""
SELECT event_id, period, CAST(prev AS BIGINT) AS cust_prev_events, CAST(ops AS BIGINT) AS device_prev_ops
FROM n WHERE period = 'test' OR """ + _SMP_WHERE.replace("cm.", "") + """
""", extra_ctes="""
u AS (
  SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY
    CASE period WHEN 'test' THEN 0 WHEN 'train' THEN 1 WHEN 'pretest' THEN 2 ELSE 3 END, customer_id) = 1),
n AS (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY event_ts, event_id) - 1 AS prev,
    row_number() OVER (PARTITION BY device_fp_i ORDER BY event_ts, event_id) - 1 AS ops
  FROM u)
"""), "dup")


@register("features_dup", FEATURES_DUP_SQL)
def q_features_dup(spark, sf_dir):
    """The build on a timeline in which every test event also is a pretest event."""
    from kestrel.plans.features import build_features
    df = build_features(fixture_timeline(spark, sf_dir, variant="dup"))
    return df.select("event_id", "period", "cust_prev_events", "device_prev_ops")


@register("interactions", INTERACTIONS_SQL)
def q_interactions(spark, sf_dir):
    """Profile-relative, profile-velocity and interaction features of the build."""
    from kestrel.plans.features import build_features, interaction_columns
    df = build_features(fixture_timeline(spark, sf_dir), columns=tuple(interaction_columns()))
    return df.select("event_id", "amt_over_profile_mean", "amt_over_profile_p95",
                     "amt_profile_zscore", "amt_drift_5", "hour_drift", "velocity_ratio_1h",
                     "mcc_diversity_ratio", "new_device_diversity_risk",
                     "risk_velocity_interaction", "risk_spend_concentration",
                     "rapid_timezone_switch")


# --------------------------------------------------------------------------
# green_sample: L6 (deterministic 1-in-m sample of unlabelled train rows)

GREEN_SQL = with_base("SELECT event_id, " + _d("amt_abs", "amt_abs") + """
FROM t WHERE period = 'train' AND train_target_raw = -1
  AND ((event_id * 1000003 + 42) % 20 + 20) % 20 = 0""")


@register("green_sample", GREEN_SQL)
def q_green_sample(spark, sf_dir):
    """1-in-20 deterministic hash sample of GREEN rows (the sample is the feature)."""
    from kestrel.operators.sampling import mix_fraction_sample
    tl = fixture_timeline(spark, sf_dir).filter(
        (F.col("period") == "train") & (F.col("train_target_raw") == -1))
    return mix_fraction_sample(tl, 20).select("event_id", "amt_abs")


# --------------------------------------------------------------------------
# orders_timeline: the same timeline operators on a second source with real
# ties (whole-day order dates): W1, W6, W10, R1, R2 over ``orders``

ORDERS_SQL = """
WITH o AS (
  SELECT o_custkey AS customer_id, o_orderkey AS event_id, o_totalprice AS amt,
         CAST(epoch(o_orderdate) AS BIGINT) AS ets FROM orders),
w AS (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY ets, event_id) - 1 AS n_prev,
         ets - lag(ets) OVER (PARTITION BY customer_id ORDER BY ets, event_id) AS gap,
         CAST(coalesce(sum(CAST(amt AS DECIMAL(38,6))) OVER (PARTITION BY customer_id ORDER BY ets, event_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS s_prev
  FROM o),
r AS (
  SELECT q.event_id,
    count(p.event_id) FILTER (WHERE p.ets >= q.ets - 604800) AS c7,
    count(p.event_id) AS c90,
    CAST(coalesce(sum(CAST(p.amt AS DECIMAL(38,6))), 0) AS DOUBLE) AS s90
  FROM o q LEFT JOIN o p ON p.customer_id = q.customer_id AND p.ets < q.ets AND p.ets >= q.ets - 7776000
  GROUP BY q.event_id)
SELECT w.event_id, CAST(n_prev AS BIGINT) AS prior_orders, CAST(coalesce(gap, -1) AS BIGINT) AS sec_since_prev,
  (round(CAST(CASE WHEN n_prev > 0 THEN s_prev / n_prev ELSE 0 END AS DOUBLE) * 1000000) / 1000000 + 0.0) AS prev_mean_price,
  CAST(c7 AS BIGINT) AS orders_7d, CAST(c90 AS BIGINT) AS orders_90d,
  (round(CAST(s90 AS DOUBLE) * 1000000) / 1000000 + 0.0) AS price_sum_90d
FROM w JOIN r USING (event_id)
"""


@register("orders_timeline", ORDERS_SQL)
def q_orders_timeline(spark, sf_dir):
    """W1, W6, W10, R1, R2 on ``orders`` (real ties on the order date)."""
    from kestrel.functions.windows import prior, since, wc, wr
    from kestrel.sources.fixture import read_table
    o = read_table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("event_id"),
        F.col("o_totalprice").alias("amt"),
        F.col("o_orderdate").cast("timestamp").alias("event_ts")).withColumn(
        "ets", F.unix_seconds("event_ts")).repartition("customer_id")
    dec = F.col("amt").cast("decimal(38,6)")
    n = F.row_number().over(wc()) - 1
    df = o.select("event_id", n.alias("prior_orders"),
                  since(F.col("ets"), F.lag("ets").over(wc())).alias("sec_since_prev"),
                  F.coalesce(F.sum(dec).over(prior(wc())), F.lit(0)).cast("double").alias("_s"),
                  F.count(F.lit(1)).over(wr(604800)).alias("orders_7d"),
                  F.count(F.lit(1)).over(wr(7776000)).alias("orders_90d"),
                  F.coalesce(F.sum(dec).over(wr(7776000)).cast("double"), F.lit(0.0)).alias("price_sum_90d"))
    return df.select("event_id", "prior_orders", "sec_since_prev",
                     F.when(F.col("prior_orders") > 0, F.col("_s") / F.col("prior_orders"))
                     .otherwise(F.lit(0.0)).alias("prev_mean_price"),
                     "orders_7d", "orders_90d", "price_sum_90d")
