"""Profiling and reporting queries (inventory E1-E16) and device-sharing
analyses (G1-G6): the numbers behind the source's plots and prose.

Class of an event (train period): RED (label 1), YELLOW (label 0), GREEN
(no label).  Exact percentiles never collect a group's values: values are
reduced to distinct (value, count) rows and positions are found with the
range-bucketed cumulative scan (``kestrel.operators.scoring.ordered_cumsum``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.functions.scalars import attach_row
from kestrel.operators.prefix import PrefixSpec, exclusive_prefix
from kestrel.operators.scoring import ordered_cumsum

MISSING_DEVICE = -100100001  # fingerprint of an event without device data
# Histogram edges, concentration cut-offs, thresholds.
HIST_EDGES = 80
TOP_K = 20
MIN_ROWS_FOR_RATE = 100
CONCENTRATION_TOPS = [1, 3, 5, 10, 20, 50]
MERCHANT_FACTOR = 3.0


def event_class() -> Column:
    raw = F.col("train_target_raw")
    return F.when(raw == 1, "RED").when(raw == 0, "YELLOW").otherwise("GREEN")


def train_rows(tl: DataFrame) -> DataFrame:
    return tl.filter(F.col("period") == "train").withColumn("cls", event_class())


# ---------------------------------------------------------------- quantiles

def exact_quantiles(df: DataFrame, value: str, keys: list[str], qs: list[float]) -> DataFrame:
    """Linear-interpolation percentiles (numpy default) per ``keys``: ``(keys, q, value_q)``."""
    keys = list(keys)
    d = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    c = ordered_cumsum(d, value, ["n"], keys)
    tot = d.groupBy(*keys).agg(F.sum("n").alias("_N"))
    targets = []
    for q in qs:
        h = (F.col("_N") - 1) * q
        lo = F.floor(h)
        targets.append(F.struct(F.lit(q).alias("q"), lo.alias("lo"),
                                F.least(lo + 1, F.col("_N") - 1).alias("hi"),
                                (h - lo).alias("frac")))
    tot = tot.select(*keys, F.array(*targets).alias("_tg"))
    c = c.join(F.broadcast(tot), keys, "inner") if keys else attach_row(c, tot)
    ex = c.select(*keys, value, "cum_n", "n", F.explode("_tg").alias("t"))
    inside = lambda k: (F.col("cum_n") <= k) & (k < F.col("cum_n") + F.col("n"))
    ex = ex.filter(inside(F.col("t.lo")) | inside(F.col("t.hi")))
    agg = ex.groupBy(*keys, F.col("t.q").alias("q")).agg(
        F.max(F.when(inside(F.col("t.lo")), F.col(value))).alias("_xl"),
        F.max(F.when(inside(F.col("t.hi")), F.col(value))).alias("_xh"),
        F.max("t.frac").alias("_f"))
    return agg.select(*keys, "q", (F.col("_xl") + F.col("_f") * (F.col("_xh") - F.col("_xl")))
                      .alias("value_q"))


# ---------------------------------------------------------------- E1-E3

def null_profile(df: DataFrame, group: str, cols: list[str]) -> DataFrame:
    """Null count and percentage per column per group (one aggregate + unpivot)."""
    agg = df.groupBy(group).agg(F.count(F.lit(1)).alias("n_rows"),
                                *[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    long = agg.unpivot([group, "n_rows"], cols, "column", "n_null")
    return long.withColumn("pct_null", 100.0 * F.col("n_null") / F.col("n_rows"))


def class_distribution(tr: DataFrame) -> DataFrame:
    """Counts and shares of RED / YELLOW / GREEN."""
    c = tr.groupBy("cls").agg(F.count(F.lit(1)).alias("n"))
    tot = c.agg(F.sum("n").alias("_all"),
                F.sum(F.when(F.col("cls") != "GREEN", F.col("n"))).alias("_lbl"))
    c = attach_row(c, tot)
    return c.select("cls", "n",
                    F.when(F.col("cls") != "GREEN", F.col("n") / F.col("_lbl")).alias("share_labelled"),
                    (F.col("n") / F.col("_all")).alias("share_all"))


def amount_stats(tr: DataFrame) -> DataFrame:
    """Mean, median, min, max, p95, p99 of |amount| per class (exact)."""
    a = tr.select("cls", F.col("amt_abs").alias("a")).filter(F.col("a").isNotNull())
    base = a.groupBy("cls").agg(F.avg("a").alias("mean"), F.min("a").alias("min"),
                                F.max("a").alias("max"), F.count(F.lit(1)).alias("n"))
    q = exact_quantiles(a, "a", ["cls"], [0.5, 0.95, 0.99])
    piv = q.groupBy("cls").pivot("q", [0.5, 0.95, 0.99]).agg(F.first("value_q"))
    piv = piv.toDF("cls", "median", "p95", "p99")
    return base.join(piv, "cls")


# ---------------------------------------------------------------- E4-E7

def _p99_max(tr: DataFrame) -> DataFrame:
    a = tr.select("cls", F.col("amt_abs").alias("a")).filter(F.col("a").isNotNull())
    return (exact_quantiles(a, "a", ["cls"], [0.99])
            .agg(F.max("value_q").alias("_top")))


def density_histogram(tr: DataFrame, edges: int = HIST_EDGES) -> DataFrame:
    """``edges - 1`` equal bins on [0, max class p99]; last bin right-closed;
    density = n / (n_in_range * width)."""
    nb = edges - 1
    a = tr.select("cls", F.col("amt_abs").alias("a")).filter(F.col("a").isNotNull())
    a = attach_row(a, _p99_max(tr))
    w = F.col("_top") / nb
    a = a.filter((F.col("a") >= 0) & (F.col("a") <= F.col("_top")))
    a = a.withColumn("bin", F.least(F.floor(F.col("a") / w), F.lit(nb - 1)).cast("int"))
    h = a.groupBy("cls", "bin").agg(F.count(F.lit(1)).alias("n"), F.first("_top").alias("_top"))
    tot = h.groupBy("cls").agg(F.sum("n").alias("_n"))
    h = h.join(F.broadcast(tot), "cls")
    return h.select("cls", "bin", "n",
                    (F.col("n") / (F.col("_n") * (F.col("_top") / nb))).alias("density"))


def log_histogram(tr: DataFrame, edges: int = HIST_EDGES) -> DataFrame:
    """E5: log-spaced bins per class on positive amounts, from max(1, min) to max."""
    nb = edges - 1
    a = tr.select("cls", F.col("amt_abs").alias("a")).filter(F.col("a") > 0)
    rng = a.groupBy("cls").agg(F.log10(F.greatest(F.min("a"), F.lit(1.0))).alias("_lo"),
                               F.log10(F.max("a")).alias("_hi"))
    a = a.join(F.broadcast(rng), "cls").withColumn("_l", F.log10("a"))
    a = a.filter((F.col("_l") >= F.col("_lo")) & (F.col("_l") <= F.col("_hi")))
    span = F.col("_hi") - F.col("_lo")
    a = a.withColumn("bin", F.when(span > 0, F.least(
        F.floor((F.col("_l") - F.col("_lo")) / span * nb), F.lit(nb - 1))).otherwise(F.lit(0)).cast("int"))
    return a.groupBy("cls", "bin").agg(F.count(F.lit(1)).alias("n"))


def box_stats(tr: DataFrame) -> DataFrame:
    """Quartiles and 1.5-IQR whiskers of |amount| clipped to [0, max class p99]."""
    a = tr.select("cls", F.col("amt_abs").alias("a")).filter(F.col("a").isNotNull())
    a = attach_row(a, _p99_max(tr))
    a = a.withColumn("a", F.least(F.greatest(F.col("a"), F.lit(0.0)), F.col("_top"))).drop("_top")
    q = exact_quantiles(a, "a", ["cls"], [0.25, 0.5, 0.75])
    piv = q.groupBy("cls").pivot("q", [0.25, 0.5, 0.75]).agg(F.first("value_q")).toDF(
        "cls", "q1", "median", "q3")
    j = a.join(F.broadcast(piv), "cls")
    iqr = F.col("q3") - F.col("q1")
    lo_lim, hi_lim = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    return j.groupBy("cls", "q1", "median", "q3").agg(
        F.min(F.when(F.col("a") >= lo_lim, F.col("a"))).alias("whisker_lo"),
        F.max(F.when(F.col("a") <= hi_lim, F.col("a"))).alias("whisker_hi"))


def empirical_cdf(tr: DataFrame) -> DataFrame:
    """``P(X <= v)`` per class at every distinct |amount| v."""
    a = tr.select("cls", F.col("amt_abs").alias("a")).filter(F.col("a").isNotNull())
    d = a.groupBy("cls", "a").agg(F.count(F.lit(1)).alias("n"))
    c = ordered_cumsum(d, "a", ["n"], ["cls"])
    tot = d.groupBy("cls").agg(F.sum("n").alias("_N"))
    c = c.join(F.broadcast(tot), "cls")
    return c.select("cls", "a", ((F.col("cum_n") + F.col("n")) / F.col("_N")).alias("cdf"))


# ---------------------------------------------------------------- E8-E10, E13

def category_table(tr: DataFrame, key: str = "mcc_code_i") -> DataFrame:
    return tr.groupBy(key).agg(
        F.sum((F.col("cls") == "RED").cast("long")).alias("red"),
        F.sum((F.col("cls") == "YELLOW").cast("long")).alias("yellow"),
        F.count(F.lit(1)).alias("total"))


def top_by_red(tr: DataFrame, key: str = "mcc_code_i", k: int = TOP_K) -> DataFrame:
    """Top-k categories by RED count (ties by key), with YELLOW, total, rate %."""
    t = category_table(tr, key).filter(F.col("red") > 0)
    t = t.withColumn("red_rate_pct", 100.0 * F.col("red") / F.col("total"))
    return t.orderBy(F.col("red").desc(), F.col(key).asc()).limit(k)


def top_by_rate(tr: DataFrame, key: str = "mcc_code_i", k: int = TOP_K,
                min_rows: int = MIN_ROWS_FOR_RATE) -> DataFrame:
    """Top-k by RED rate among labelled categories with at least ``min_rows`` rows."""
    t = category_table(tr, key).filter(((F.col("red") + F.col("yellow")) > 0)
                                      & (F.col("total") >= min_rows))
    t = t.withColumn("red_rate_pct", 100.0 * F.col("red") / F.col("total"))
    return t.orderBy(F.col("red_rate_pct").desc(), F.col(key).asc()).limit(k)


def red_concentration(tr: DataFrame, key: str = "mcc_code_i",
                      tops: list[int] = CONCENTRATION_TOPS) -> DataFrame:
    """Share of all RED events in the top-n categories by RED count."""
    t = category_table(tr, key).filter(F.col("red") > 0).select(key, "red")
    # the largest top-n decides how many categories are ranked one by one: a partial
    # top-n per task, then at most max(tops) rows in one
    first = Window.orderBy(F.col("red").desc(), F.col(key).asc())
    c = t.orderBy(F.col("red").desc(), F.col(key).asc()).limit(max(tops))
    c = c.select(F.row_number().over(first).alias("rank"),
                 F.sum("red").over(first.rowsBetween(Window.unboundedPreceding, 0)).alias("cum_red"))
    tot = t.agg(F.sum("red").alias("_all"), F.count(F.lit(1)).alias("_k"))
    tops_df = c.sparkSession.createDataFrame([(n,) for n in tops], "top_n int")
    c = attach_row(c, tot)
    # cumulative RED at rank min(top_n, number of categories)
    sel = c.join(F.broadcast(tops_df), F.col("rank") == F.least(F.col("top_n"), F.col("_k")))
    return sel.select("top_n", "cum_red", (100.0 * F.col("cum_red") / F.col("_all")).alias("share_pct"))


def value_red_rates(tr: DataFrame, keys: list[str]) -> DataFrame:
    """RED rate per value of each key, with volume (one stacked aggregate)."""
    body = ", ".join(f"'{k}', CAST({k} AS BIGINT)" for k in keys)
    long = tr.select(F.expr(f"stack({len(keys)}, {body}) AS (key_name, key_value)"), "cls")
    return long.groupBy("key_name", "key_value").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col("cls") == "RED").cast("long")).alias("red"),
        F.avg((F.col("cls") == "RED").cast("double")).alias("red_rate"))


# ---------------------------------------------------------------- E11, E12

def customer_overlap(tl: DataFrame, labels: DataFrame) -> DataFrame:
    """Test customers with label history (any / RED / YELLOW / none) and
    seen in pretrain / train; counts and % of test customers."""
    def seen(cond) -> Column:
        return F.max(F.coalesce(cond, F.lit(False)))

    per = tl.groupBy("customer_id").agg(*[seen(F.col("period") == p).alias(p) for p in ("test", "pretrain", "train")])
    lab = labels.groupBy("customer_id").agg(F.lit(True).alias("any_label"), seen(F.col("target") == 1).alias("red"),
                                            seen(F.col("target") == 0).alias("yellow"))
    j = per.filter("test").join(lab, "customer_id", "left")
    has = {m: F.coalesce(F.col(m), F.lit(False)) for m in ("any_label", "red", "yellow", "pretrain", "train")}
    has["no_label"] = ~has["any_label"]
    sums = j.agg(F.count(F.lit(1)).alias("_nt"), *[F.count_if(c).alias(m) for m, c in has.items()])
    rows = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("n")) for m in has]))
    return sums.select(rows.alias("r"), "_nt").select(
        "r.metric", "r.n", (100.0 * F.col("r.n") / F.col("_nt")).alias("pct"))


def event_coverage(tl: DataFrame, labels: DataFrame) -> DataFrame:
    """Test events from customers with / without label history."""
    test = tl.filter(F.col("period") == "test").select("event_id", "customer_id")
    custs = labels.select("customer_id").distinct().withColumn("_h", F.lit(True))
    j = test.join(custs, "customer_id", "left")
    g = j.groupBy(F.coalesce("_h", F.lit(False)).alias("has_history")).agg(
        F.count(F.lit(1)).alias("n_events"))
    tot = g.agg(F.sum("n_events").alias("_t"))
    return attach_row(g, tot).select("has_history", "n_events",
                                     (100.0 * F.col("n_events") / F.col("_t")).alias("pct"))


# ---------------------------------------------------------------- E14-E16

def burstiness(tr: DataFrame) -> DataFrame:
    """Gaps between consecutive same-class events of a customer: share
    within 1h / 24h and the exact median gap, for RED and GREEN."""
    x = tr.filter(F.col("cls").isin("RED", "GREEN"))
    w = Window.partitionBy("customer_id", "cls").orderBy("event_ts", "event_id")
    g = x.select("cls", (F.col("ets") - F.lag("ets").over(w)).alias("gap")).filter(
        F.col("gap").isNotNull())
    base = g.groupBy("cls").agg(F.count(F.lit(1)).alias("n_gaps"),
                                F.avg((F.col("gap") <= 3600).cast("double")).alias("share_1h"),
                                F.avg((F.col("gap") <= 86400).cast("double")).alias("share_24h"))
    med = exact_quantiles(g, "gap", ["cls"], [0.5]).select("cls", F.col("value_q").alias("median_gap"))
    return base.join(med, "cls", "left")


def red_trend(tr: DataFrame, grain: str = "month") -> DataFrame:
    """RED share per calendar period."""
    return tr.groupBy(F.date_trunc(grain, "event_ts").alias("period_start")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col("cls") == "RED").cast("long")).alias("red"),
        F.avg((F.col("cls") == "RED").cast("double")).alias("red_share"))


def period_summary(tl: DataFrame) -> DataFrame:
    """Rows, customers, first / last date, % rows with a valid device per period."""
    return tl.groupBy("period").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("customer_id").alias("n_customers"),
        F.min("event_ts").alias("first_ts"), F.max("event_ts").alias("last_ts"),
        (100.0 * F.avg((F.col("device_fp_i") != MISSING_DEVICE).cast("double"))).alias("pct_device"))


# ---------------------------------------------------------------- G1-G6

def valid_device_rows(tl: DataFrame) -> DataFrame:
    return tl.filter(F.col("device_fp_i") != MISSING_DEVICE)


def device_sharing(tl: DataFrame) -> DataFrame:
    """G1: % devices with >= 2 customers, % customers on a shared device, top device."""
    v = valid_device_rows(tl)
    pairs = v.select("device_fp_i", "customer_id").distinct()
    dev = pairs.groupBy("device_fp_i").agg(F.count(F.lit(1)).alias("n_cust"))
    shared = dev.filter(F.col("n_cust") >= 2)
    n_dev = dev.agg(F.count(F.lit(1)).alias("n_devices"),
                    F.sum((F.col("n_cust") >= 2).cast("long")).alias("n_shared"),
                    F.max_by(F.struct("n_cust", (-F.col("device_fp_i")).alias("neg")),
                             F.struct("n_cust", (-F.col("device_fp_i")).alias("neg"))).alias("_top"))
    cust_all = v.select("customer_id").distinct().agg(F.count(F.lit(1)).alias("n_customers"))
    cust_sh = (pairs.join(shared.select("device_fp_i"), "device_fp_i", "left_semi")
               .select("customer_id").distinct().agg(F.count(F.lit(1)).alias("n_cust_shared")))
    out = attach_row(attach_row(n_dev, cust_all), cust_sh)
    return out.select(
        "n_devices", "n_shared", (100.0 * F.col("n_shared") / F.col("n_devices")).alias("pct_shared"),
        "n_customers", "n_cust_shared",
        (100.0 * F.col("n_cust_shared") / F.col("n_customers")).alias("pct_cust_shared"),
        (-F.col("_top.neg")).alias("top_device"), F.col("_top.n_cust").alias("top_device_customers"))


def cross_customer_lift(tl: DataFrame, bucket_rows: int | None = None) -> DataFrame:
    """P(RED | another customer had a RED earlier on this device) / base rate,
    over train rows on valid devices.  Prefix counts via the two-level scan."""
    v = valid_device_rows(tl).filter(F.col("period") == "train")
    red = (F.col("train_target_raw") == 1).cast("long")
    p = exclusive_prefix(v, ["device_fp_i"], [
        PrefixSpec("_dev_red", None, red), PrefixSpec("_own_red", "customer_id", red)],
        bucket_rows=bucket_rows)
    p = p.withColumn("_other", (F.col("_dev_red") - F.col("_own_red")) > 0)
    return p.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("_other").cast("long")).alias("n_exposed"),
        F.avg((F.col("train_target_raw") == 1).cast("double")).alias("base_rate"),
        F.avg(F.when(F.col("_other"), (F.col("train_target_raw") == 1).cast("double"))).alias("exposed_rate"),
    ).withColumn("lift", F.col("exposed_rate") / F.col("base_rate"))


def fraud_clustering(tl: DataFrame) -> DataFrame:
    """Observed % of shared devices with a RED customer vs the % expected if
    RED customers were spread independently (``1 - (1 - p)^k``)."""
    v = valid_device_rows(tl).filter(F.col("period") == "train")
    cust_red = v.groupBy("customer_id").agg(F.max((F.col("train_target_raw") == 1).cast("int")).alias("r"))
    p = cust_red.agg(F.avg("r").alias("_p"))
    pairs = v.select("device_fp_i", "customer_id").distinct().join(cust_red, "customer_id")
    dev = pairs.groupBy("device_fp_i").agg(F.count(F.lit(1)).alias("k"), F.max("r").alias("has_red"))
    dev = attach_row(dev.filter(F.col("k") >= 2), p)
    return dev.agg(F.count(F.lit(1)).alias("n_shared"),
                   (100.0 * F.avg("has_red")).alias("observed_pct"),
                   (100.0 * F.avg(1.0 - F.pow(1.0 - F.col("_p"), F.col("k")))).alias("expected_pct"))


def merchant_signal(tr: DataFrame, key: str = "event_desc", factor: float = MERCHANT_FACTOR) -> DataFrame:
    """Categories with RED rate above ``factor`` x the overall rate."""
    t = tr.groupBy(key).agg(F.count(F.lit(1)).alias("n"),
                            F.sum((F.col("cls") == "RED").cast("long")).alias("red"))
    base = tr.agg(F.avg((F.col("cls") == "RED").cast("double")).alias("_base"))
    t = attach_row(t, base).withColumn("rate", F.col("red") / F.col("n"))
    return t.filter(F.col("rate") > factor * F.col("_base")).select(
        key, "n", "red", "rate", (F.col("rate") / F.col("_base")).alias("ratio"))


def device_coverage(tl: DataFrame) -> DataFrame:
    """% rows with a valid fingerprint by period and class."""
    cls = F.when(F.col("period") != "train", F.lit("ALL")).otherwise(event_class())
    return tl.groupBy("period", cls.alias("cls")).agg(
        F.count(F.lit(1)).alias("n"),
        (100.0 * F.avg((F.col("device_fp_i") != MISSING_DEVICE).cast("double"))).alias("pct_valid"))


def sharing_precedes_label(tl: DataFrame) -> DataFrame:
    """Among (device, customer) pairs with a RED on a shared valid device,
    % where another customer was on the device before the customer's first RED."""
    v = valid_device_rows(tl)
    is_red = (F.col("period") == "train") & (F.col("train_target_raw") == 1)
    pc = v.groupBy("device_fp_i", "customer_id").agg(
        F.min(F.struct("ets", "event_id")).alias("_first"),
        F.min(F.when(is_red, F.col("ets"))).alias("first_red"))
    # the two smallest first uses of a device as two aggregates with partial minima
    one = pc.groupBy("device_fp_i").agg(F.min(F.struct("_first", "customer_id")).alias("_a"), F.count(F.lit(1)).alias("_n"))
    one = one.where(F.col("_n") >= 2)
    rest = pc.join(one, "device_fp_i").where(~F.col("customer_id").eqNullSafe(F.col("_a.customer_id")))
    two = rest.groupBy("device_fp_i").agg(F.min("_first.ets").alias("_t2"))
    j = pc.filter(F.col("first_red").isNotNull()).join(one, "device_fp_i").join(two, "device_fp_i")
    other_first = F.when(F.col("customer_id").eqNullSafe(F.col("_a.customer_id")), F.col("_t2")).otherwise(F.col("_a._first.ets"))
    j = j.withColumn("_prec", (other_first < F.col("first_red")).cast("double"))
    return j.agg(F.count(F.lit(1)).alias("n_assoc"), (100.0 * F.avg("_prec")).alias("pct_sharing_first"))
