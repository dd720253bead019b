"""Registered profiling (E1-E16) and device-sharing (G1-G6) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import profiling as E
from kestrel.plans.catalog import register
from kestrel.plans.oracle import with_base
from kestrel.plans.queries_timeline import _d, _i
from kestrel.sources.fixture import labels_from_raw, raw_events
from kestrel.sources.timeline import fixture_timeline

BASE_COLS = ["customer_id", "event_id", "event_dttm", "event_type_nm", "event_desc",
             "channel_indicator_type", "channel_indicator_sub_type", "operaton_amt",
             "currency_iso_cd", "mcc_code", "pos_cd", "timezone", "session_id",
             "operating_system_type", "battery", "device_system_version", "screen_size",
             "developer_tools", "phone_voip_call_state", "web_rdp_connection", "compromised",
             "accept_language", "browser_language"]

TR = """tr AS (SELECT *, CASE WHEN train_target_raw = 1 THEN 'RED' WHEN train_target_raw = 0
  THEN 'YELLOW' ELSE 'GREEN' END AS cls FROM t WHERE period = 'train')"""


def _tr(spark, sf_dir):
    return E.train_rows(fixture_timeline(spark, sf_dir, by_customer=False))


# E1 ---------------------------------------------------------------------------
NULLS_SQL = with_base("SELECT period, \"column\", " + ", ".join([
    _i("n_rows", "n_rows"), _i("n_null", "n_null"), _d("100.0 * n_null / n_rows", "pct_null")])
    + " FROM (" + " UNION ALL ".join(
        f"SELECT period, '{c}' AS \"column\", count(*) AS n_rows, count(*) - count({c}) AS n_null "
        f"FROM raw GROUP BY period" for c in BASE_COLS) + ")")


@register("eda_nulls", NULLS_SQL)
def q_eda_nulls(spark, sf_dir):
    """Null count and % per raw column per period file."""
    return E.null_profile(raw_events(spark, sf_dir), "period", BASE_COLS)


# E2 ---------------------------------------------------------------------------
CLASSES_SQL = with_base("SELECT cls, " + ", ".join([
    _i("n", "n"),
    _d("CASE WHEN cls <> 'GREEN' THEN n / sum(n) FILTER (WHERE cls <> 'GREEN') OVER () END",
       "share_labelled"),
    _d("n / sum(n) OVER ()", "share_all")]) + " FROM (SELECT cls, count(*) AS n FROM tr GROUP BY cls)",
    TR)


@register("eda_classes", CLASSES_SQL)
def q_eda_classes(spark, sf_dir):
    """RED / YELLOW / GREEN counts and shares."""
    return E.class_distribution(_tr(spark, sf_dir))


# E3 ---------------------------------------------------------------------------
AMOUNTS_SQL = with_base("SELECT cls, " + ", ".join([
    _d("avg(amt_abs)", "mean"), _d("min(amt_abs)", "min"), _d("max(amt_abs)", "max"),
    _i("count(amt_abs)", "n"), _d("quantile_cont(amt_abs, 0.5)", "median"),
    _d("quantile_cont(amt_abs, 0.95)", "p95"), _d("quantile_cont(amt_abs, 0.99)", "p99")])
    + " FROM tr WHERE amt_abs IS NOT NULL GROUP BY cls", TR)


@register("eda_amounts", AMOUNTS_SQL)
def q_eda_amounts(spark, sf_dir):
    """Amount statistics per class with exact linear percentiles."""
    return E.amount_stats(_tr(spark, sf_dir))


# E4 ---------------------------------------------------------------------------
P99 = """top AS (SELECT max(p) AS top FROM (SELECT quantile_cont(amt_abs, 0.99) AS p FROM tr
  WHERE amt_abs IS NOT NULL GROUP BY cls))"""
HIST_SQL = with_base("SELECT cls, " + ", ".join([
    _i("bin", "bin"), _i("n", "n"), _d("n / (sum(n) OVER (PARTITION BY cls) * (top / 79.0))", "density")])
    + """ FROM (SELECT cls, least(floor(amt_abs / (top / 79.0)), 78) AS bin, count(*) AS n, any_value(top) AS top
      FROM tr, top WHERE amt_abs IS NOT NULL AND amt_abs >= 0 AND amt_abs <= top GROUP BY 1, 2)""",
    TR + "," + P99)


@register("eda_hist", HIST_SQL)
def q_eda_hist(spark, sf_dir):
    """Density histogram, 79 equal bins up to the largest class p99."""
    return E.density_histogram(_tr(spark, sf_dir))


# E5 ---------------------------------------------------------------------------
LOGHIST_SQL = with_base("SELECT cls, " + ", ".join([_i("bin", "bin"), _i("count(*)", "n")]) + """
FROM (SELECT cls, CASE WHEN hi - lo > 0 THEN least(floor((log10(amt_abs) - lo) / (hi - lo) * 79), 78)
                  ELSE 0 END AS bin
      FROM tr JOIN rg USING (cls)
      WHERE amt_abs > 0 AND log10(amt_abs) >= lo AND log10(amt_abs) <= hi)
GROUP BY cls, bin""", TR + """,
rg AS (SELECT cls, log10(greatest(min(amt_abs), 1.0)) AS lo, log10(max(amt_abs)) AS hi
       FROM tr WHERE amt_abs > 0 GROUP BY cls)""")


@register("eda_loghist", LOGHIST_SQL)
def q_eda_loghist(spark, sf_dir):
    """E5: log-spaced histogram of positive amounts per class."""
    return E.log_histogram(_tr(spark, sf_dir))


# E6 ---------------------------------------------------------------------------
BOX_SQL = with_base("SELECT cls, " + ", ".join([
    _d("q1", "q1"), _d("med", "median"), _d("q3", "q3"),
    _d("min(a) FILTER (WHERE a >= q1 - 1.5 * (q3 - q1))", "whisker_lo"),
    _d("max(a) FILTER (WHERE a <= q3 + 1.5 * (q3 - q1))", "whisker_hi")])
    + " FROM cl JOIN qs USING (cls) GROUP BY cls, q1, med, q3", TR + "," + P99 + """,
cl AS (SELECT cls, least(greatest(amt_abs, 0), top) AS a FROM tr, top WHERE amt_abs IS NOT NULL),
qs AS (SELECT cls, quantile_cont(a, 0.25) AS q1, quantile_cont(a, 0.5) AS med,
              quantile_cont(a, 0.75) AS q3 FROM cl GROUP BY cls)""")


@register("eda_box", BOX_SQL)
def q_eda_box(spark, sf_dir):
    """Box-plot statistics of clipped amounts (quartiles, 1.5 IQR whiskers)."""
    return E.box_stats(_tr(spark, sf_dir))


# E7 ---------------------------------------------------------------------------
CDF_SQL = with_base("SELECT cls, " + _d("amt_abs", "a") + ", " + _d(
    "sum(n) OVER (PARTITION BY cls ORDER BY amt_abs) / sum(n) OVER (PARTITION BY cls)", "cdf")
    + " FROM (SELECT cls, amt_abs, count(*) AS n FROM tr WHERE amt_abs IS NOT NULL GROUP BY 1, 2)", TR)


@register("eda_cdf", CDF_SQL)
def q_eda_cdf(spark, sf_dir):
    """Empirical CDF per class at every distinct amount."""
    return E.empirical_cdf(_tr(spark, sf_dir))


# E8-E10 -----------------------------------------------------------------------
CAT = """cat AS (SELECT mcc_code_i, count(*) FILTER (WHERE cls = 'RED') AS red,
  count(*) FILTER (WHERE cls = 'YELLOW') AS yellow, count(*) AS total FROM tr GROUP BY mcc_code_i)"""
TOP_RED_SQL = with_base("SELECT " + ", ".join([
    _i("mcc_code_i", "mcc_code_i"), _i("red", "red"), _i("yellow", "yellow"), _i("total", "total"),
    _d("100.0 * red / total", "red_rate_pct")])
    + " FROM cat WHERE red > 0 ORDER BY red DESC, mcc_code_i LIMIT 20", TR + "," + CAT)


@register("eda_top_red", TOP_RED_SQL)
def q_eda_top_red(spark, sf_dir):
    """Top-20 MCC by RED count."""
    return E.top_by_red(_tr(spark, sf_dir))


TOP_RATE_SQL = with_base("SELECT " + ", ".join([
    _i("mcc_code_i", "mcc_code_i"), _i("red", "red"), _i("yellow", "yellow"), _i("total", "total"),
    _d("100.0 * red / total", "red_rate_pct")])
    + " FROM cat WHERE red + yellow > 0 AND total >= 100 "
      "ORDER BY 100.0 * red / total DESC, mcc_code_i LIMIT 20", TR + "," + CAT)


@register("eda_top_rate", TOP_RATE_SQL)
def q_eda_top_rate(spark, sf_dir):
    """Top-20 labelled MCC by RED rate with at least 100 rows."""
    return E.top_by_rate(_tr(spark, sf_dir))


CONC_SQL = with_base("SELECT " + ", ".join([
    _i("top_n", "top_n"), _i("cum_red", "cum_red"), _d("100.0 * cum_red / all_red", "share_pct")])
    + """ FROM (SELECT unnest([1, 3, 5, 10, 20, 50]) AS top_n) k
  JOIN rk ON rk.rnk = least(k.top_n, rk.n_cat)""", TR + "," + CAT + """,
rk AS (SELECT row_number() OVER (ORDER BY red DESC, mcc_code_i) AS rnk,
              sum(red) OVER (ORDER BY red DESC, mcc_code_i) AS cum_red,
              sum(red) OVER () AS all_red, count(*) OVER () AS n_cat
       FROM cat WHERE red > 0)""")


@register("eda_concentration", CONC_SQL)
def q_eda_concentration(spark, sf_dir):
    """Share of RED in the top 1/3/5/10/20/50 MCC."""
    return E.red_concentration(_tr(spark, sf_dir))


# E11, E12 ---------------------------------------------------------------------
OVERLAP_SQL = with_base("SELECT metric, " + ", ".join([
    _i("n", "n"), _d("100.0 * n / (SELECT count(*) FROM tc)", "pct")]) + """ FROM (
  SELECT 'any_label' AS metric, count(*) AS n FROM tc WHERE customer_id IN (SELECT customer_id FROM lab)
  UNION ALL SELECT 'red', count(*) FROM tc WHERE customer_id IN (SELECT customer_id FROM lab WHERE target = 1)
  UNION ALL SELECT 'yellow', count(*) FROM tc WHERE customer_id IN (SELECT customer_id FROM lab WHERE target = 0)
  UNION ALL SELECT 'pretrain', count(*) FROM tc WHERE customer_id IN (SELECT customer_id FROM t WHERE period = 'pretrain')
  UNION ALL SELECT 'train', count(*) FROM tc WHERE customer_id IN (SELECT customer_id FROM t WHERE period = 'train')
  UNION ALL SELECT 'no_label', count(*) FROM tc WHERE customer_id NOT IN (SELECT customer_id FROM lab))""",
    "tc AS (SELECT DISTINCT customer_id FROM t WHERE period = 'test')")


@register("eda_overlap", OVERLAP_SQL)
def q_eda_overlap(spark, sf_dir):
    """Test-customer overlap with label history and earlier periods."""
    tl = fixture_timeline(spark, sf_dir, by_customer=False)
    return E.customer_overlap(tl, labels_from_raw(raw_events(spark, sf_dir)))


COVERAGE_SQL = with_base("SELECT " + ", ".join([
    _i("h", "has_history"), _i("count(*)", "n_events"),
    _d("100.0 * count(*) / sum(count(*)) OVER ()", "pct")]) + """
FROM (SELECT customer_id IN (SELECT customer_id FROM lab) AS h FROM t WHERE period = 'test') GROUP BY h""")


@register("eda_coverage", COVERAGE_SQL)
def q_eda_coverage(spark, sf_dir):
    """Test events from customers with / without label history."""
    tl = fixture_timeline(spark, sf_dir, by_customer=False)
    return E.event_coverage(tl, labels_from_raw(raw_events(spark, sf_dir)))


# E13 --------------------------------------------------------------------------
_E13_KEYS = ["event_type_nm", "channel_indicator_type", "pos_cd", "timezone"]
VALUE_RATES_SQL = with_base("SELECT key_name, " + ", ".join([
    _i("key_value", "key_value"), _i("count(*)", "n"), _i("count(*) FILTER (WHERE cls = 'RED')", "red"),
    _d("avg(CAST(cls = 'RED' AS DOUBLE))", "red_rate")]) + " FROM (" + " UNION ALL ".join(
    f"SELECT '{k}' AS key_name, CAST({k} AS BIGINT) AS key_value, cls FROM tr" for k in _E13_KEYS)
    + ") GROUP BY key_name, key_value", TR)


@register("eda_value_rates", VALUE_RATES_SQL)
def q_eda_value_rates(spark, sf_dir):
    """RED rate per feature value with volume, four keys in one aggregate."""
    return E.value_red_rates(_tr(spark, sf_dir), _E13_KEYS)


# E14 --------------------------------------------------------------------------
BURST_SQL = with_base("SELECT cls, " + ", ".join([
    _i("count(*)", "n_gaps"), _d("avg(CAST(gap <= 3600 AS DOUBLE))", "share_1h"),
    _d("avg(CAST(gap <= 86400 AS DOUBLE))", "share_24h"), _d("quantile_cont(gap, 0.5)", "median_gap")])
    + """ FROM (SELECT cls, ets - lag(ets) OVER (PARTITION BY customer_id, cls ORDER BY event_ts, event_id) AS gap
      FROM tr WHERE cls IN ('RED', 'GREEN')) WHERE gap IS NOT NULL GROUP BY cls""", TR)


@register("eda_burstiness", BURST_SQL)
def q_eda_burstiness(spark, sf_dir):
    """Consecutive same-class gaps: share within 1h / 24h, median gap."""
    return E.burstiness(_tr(spark, sf_dir))


# E15 --------------------------------------------------------------------------
TREND_SQL = with_base("SELECT strftime(date_trunc('month', event_ts), '%Y-%m-%d') AS period_start, " + ", ".join([
    _i("count(*)", "n"), _i("count(*) FILTER (WHERE cls = 'RED')", "red"),
    _d("avg(CAST(cls = 'RED' AS DOUBLE))", "red_share")]) + " FROM tr GROUP BY 1", TR)


@register("eda_trend", TREND_SQL)
def q_eda_trend(spark, sf_dir):
    """Monthly RED share."""
    df = E.red_trend(_tr(spark, sf_dir), "month")
    return df.withColumn("period_start", F.date_format("period_start", "yyyy-MM-dd"))


# E16 --------------------------------------------------------------------------
PERIODS_SQL = with_base("SELECT period, " + ", ".join([
    _i("count(*)", "n_rows"), _i("count(DISTINCT customer_id)", "n_customers"),
    _i("min(ets)", "first_ts"), _i("max(ets)", "last_ts"),
    _d("100.0 * avg(CAST(device_fp_i <> -100100001 AS DOUBLE))", "pct_device")])
    + " FROM t GROUP BY period")


@register("eda_periods", PERIODS_SQL)
def q_eda_periods(spark, sf_dir):
    """Per-period rows, customers, time span and device coverage."""
    df = E.period_summary(fixture_timeline(spark, sf_dir, by_customer=False))
    return df.withColumns({"first_ts": F.unix_seconds("first_ts"), "last_ts": F.unix_seconds("last_ts")})


# G1 ---------------------------------------------------------------------------
VD = "vd AS (SELECT * FROM t WHERE device_fp_i <> -100100001)"
SHARING_SQL = with_base("SELECT " + ", ".join([
    _i("(SELECT count(*) FROM dv)", "n_devices"), _i("(SELECT count(*) FROM dv WHERE k >= 2)", "n_shared"),
    _d("100.0 * (SELECT count(*) FROM dv WHERE k >= 2) / (SELECT count(*) FROM dv)", "pct_shared"),
    _i("(SELECT count(DISTINCT customer_id) FROM vd)", "n_customers"),
    _i("(SELECT count(DISTINCT customer_id) FROM vd WHERE device_fp_i IN (SELECT device_fp_i FROM dv WHERE k >= 2))",
       "n_cust_shared"),
    _d("100.0 * (SELECT count(DISTINCT customer_id) FROM vd WHERE device_fp_i IN "
       "(SELECT device_fp_i FROM dv WHERE k >= 2)) / (SELECT count(DISTINCT customer_id) FROM vd)",
       "pct_cust_shared"),
    _i("(SELECT device_fp_i FROM dv ORDER BY k DESC, device_fp_i LIMIT 1)", "top_device"),
    _i("(SELECT max(k) FROM dv)", "top_device_customers")]),
    VD + ", dv AS (SELECT device_fp_i, count(DISTINCT customer_id) AS k FROM vd GROUP BY device_fp_i)")


@register("device_sharing", SHARING_SQL)
def q_device_sharing(spark, sf_dir):
    """G1: device sharing shares and the top shared device."""
    return E.device_sharing(fixture_timeline(spark, sf_dir, by_customer=False))


# G2 ---------------------------------------------------------------------------
LIFT_SQL = with_base("SELECT " + ", ".join([
    _i("count(*)", "n"), _i("count(*) FILTER (WHERE oth)", "n_exposed"),
    _d("avg(y)", "base_rate"), _d("avg(y) FILTER (WHERE oth)", "exposed_rate"),
    _d("(avg(y) FILTER (WHERE oth)) / avg(y)", "lift")]) + " FROM x", VD + f""",
tv AS (SELECT *, CAST(train_target_raw = 1 AS DOUBLE) AS y FROM vd WHERE period = 'train'),
x AS (
  SELECT q.event_id, any_value(q.y) AS y,
    coalesce(sum(p.y) FILTER (WHERE p.customer_id <> q.customer_id), 0) > 0 AS oth
  FROM tv q LEFT JOIN tv p ON p.device_fp_i = q.device_fp_i
    AND (p.event_ts < q.event_ts OR (p.event_ts = q.event_ts AND p.event_id < q.event_id))
  GROUP BY q.event_id)""")


@register("device_lift", LIFT_SQL)
def q_device_lift(spark, sf_dir):
    """Causal cross-customer RED lift on shared devices."""
    return E.cross_customer_lift(fixture_timeline(spark, sf_dir, by_customer=False))


# G3 ---------------------------------------------------------------------------
CLUSTER_SQL = with_base("SELECT " + ", ".join([
    _i("count(*)", "n_shared"), _d("100.0 * avg(has_red)", "observed_pct"),
    _d("100.0 * avg(1 - pow(1 - (SELECT avg(r) FROM cr), k))", "expected_pct")])
    + " FROM dv WHERE k >= 2", VD + """,
tv AS (SELECT * FROM vd WHERE period = 'train'),
cr AS (SELECT customer_id, max(CAST(train_target_raw = 1 AS INTEGER)) AS r FROM tv GROUP BY customer_id),
dv AS (SELECT device_fp_i, count(*) AS k, max(r) AS has_red
       FROM (SELECT DISTINCT device_fp_i, customer_id FROM tv) JOIN cr USING (customer_id)
       GROUP BY device_fp_i)""")


@register("device_clustering", CLUSTER_SQL)
def q_device_clustering(spark, sf_dir):
    """RED clustering on shared devices vs independence."""
    return E.fraud_clustering(fixture_timeline(spark, sf_dir, by_customer=False))


# G4 ---------------------------------------------------------------------------
MERCHANT_SQL = with_base("SELECT " + ", ".join([
    _i("event_desc", "event_desc"), _i("n", "n"), _i("red", "red"), _d("red / n", "rate"),
    _d("(red / n) / (SELECT avg(CAST(cls = 'RED' AS DOUBLE)) FROM tr)", "ratio")])
    + """ FROM (SELECT event_desc, count(*) AS n, count(*) FILTER (WHERE cls = 'RED') AS red
      FROM tr GROUP BY event_desc)
  WHERE red / n > 3 * (SELECT avg(CAST(cls = 'RED' AS DOUBLE)) FROM tr)""", TR)


@register("merchant_signal", MERCHANT_SQL)
def q_merchant_signal(spark, sf_dir):
    """Event descriptions with RED rate above 3x the baseline."""
    return E.merchant_signal(_tr(spark, sf_dir))


@register("merchant_signal_any", MERCHANT_SQL.replace("red / n > 3 *", "red / n > 1 *"))
def q_merchant_signal_any(spark, sf_dir):
    """G4 with factor 1: all event descriptions above the baseline (the fixture has none above 3x)."""
    return E.merchant_signal(_tr(spark, sf_dir), factor=1.0)


# G5 ---------------------------------------------------------------------------
DEVCOV_SQL = with_base("SELECT period, cls, " + ", ".join([
    _i("count(*)", "n"), _d("100.0 * avg(CAST(device_fp_i <> -100100001 AS DOUBLE))", "pct_valid")])
    + """ FROM (SELECT *, CASE WHEN period <> 'train' THEN 'ALL' WHEN train_target_raw = 1 THEN 'RED'
                WHEN train_target_raw = 0 THEN 'YELLOW' ELSE 'GREEN' END AS cls FROM t)
  GROUP BY period, cls""")


@register("device_coverage", DEVCOV_SQL)
def q_device_coverage(spark, sf_dir):
    """Valid-fingerprint coverage by period and class."""
    return E.device_coverage(fixture_timeline(spark, sf_dir, by_customer=False))


# G6 ---------------------------------------------------------------------------
PRECEDE_SQL = with_base("SELECT " + ", ".join([
    _i("count(*)", "n_assoc"), _d("100.0 * avg(CAST(other_first < first_red AS DOUBLE))",
                                  "pct_sharing_first")]) + """
FROM (
  SELECT a.device_fp_i, a.customer_id, a.first_red,
    (SELECT min(b.first_ets) FROM pc b WHERE b.device_fp_i = a.device_fp_i AND b.customer_id <> a.customer_id)
      AS other_first
  FROM pc a WHERE a.first_red IS NOT NULL
    AND (SELECT count(*) FROM pc b WHERE b.device_fp_i = a.device_fp_i) >= 2)""", VD + """,
pc AS (SELECT device_fp_i, customer_id, min(ets) AS first_ets,
              min(ets) FILTER (WHERE period = 'train' AND train_target_raw = 1) AS first_red
       FROM vd GROUP BY device_fp_i, customer_id)""")


@register("device_precedence", PRECEDE_SQL)
def q_device_precedence(spark, sf_dir):
    """% of device-RED associations where sharing precedes the first RED."""
    return E.sharing_precedes_label(fixture_timeline(spark, sf_dir, by_customer=False))
