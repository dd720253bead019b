"""Group aggregations: customer profiles, smoothed target priors, imputation
(inventory A1-A9, J5, J6, P17, P18).

Priors are computed in one scan for all keys (A6): each row is expanded to
``(key_name, key_value)`` pairs with ``stack`` and aggregated once (partial
aggregation map-side), instead of one scan and one job per key.  The per-key
tables are small except the device key; joins back let AQE pick broadcast or
shuffle from the measured size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.functions.parse import safe_ratio
from kestrel.functions.scalars import attach_row
from kestrel.operators.split import packed, unpacked
from kestrel.sources import fixture

# Prior keys of the feature build (A4) and the refit.
PRIOR_KEYS = ["event_desc", "mcc_code_i", "timezone", "operating_system_type",
              "channel_indicator_sub_type", "event_type_nm", "pos_cd", "accept_language_i",
              "device_fp_i"]
FULL_PRIOR_KEYS = ["event_desc", "mcc_code_i", "event_type_nm", "pos_cd", "timezone",
                   "accept_language_i", "device_fp_i"]
# Interaction pairs (A5).
PRIOR_PAIRS = [("mcc_code_i", "event_type_nm"), ("event_desc", "channel_indicator_sub_type"),
               ("pos_cd", "event_type_nm"), ("mcc_code_i", "channel_indicator_sub_type")]
# Smoothing constants.
RATE_ADD, RATE_DEN = 1.0, 200.0
SHARE_ADD, SHARE_DEN = 1.0, 2.0
# Risk products prior x (1 + novelty).
RISK_PRODUCTS = [("prior_event_desc_red_rate", "is_new_desc_for_customer", "risk_new_desc_x_prior"),
                 ("prior_timezone_red_rate", "is_new_timezone_for_customer", "risk_new_tz_x_prior"),
                 ("prior_mcc_code_i_red_rate", "is_new_mcc_for_customer", "risk_new_mcc_x_prior"),
                 ("prior_device_fp_i_red_rate", "is_new_device_for_customer", "risk_new_device_x_prior")]
PROFILE_QUANTILE = 0.95
PROFILE_DAYS = 365.0


# ---------------------------------------------------------------- profiles

def customer_profiles(pretrain: DataFrame) -> DataFrame:
    """A1 + A2: per-customer profile of the pretrain period.

    The median and the nearest-rank p95 (``sorted[round((n-1)*q)]``) are read
    off a rank window in the customer partitioning (exact, no per-customer
    list is collected); everything else is one hash aggregate.
    """
    amt = F.col("amt")
    w = Window.partitionBy("customer_id").orderBy(amt.asc_nulls_last())
    ranked = pretrain.select(
        "customer_id", "amt", "mcc_code_i", "hour",
        F.row_number().over(w).alias("_r"),
        F.count(amt).over(Window.partitionBy("customer_id")).alias("_n"))
    n = F.col("_n")
    lo = F.floor((n + 1) / 2)
    hi = F.ceil((n + 1) / 2)
    q_idx = F.round((n - 1) * PROFILE_QUANTILE, 0) + 1
    r = F.col("_r")
    prof = ranked.groupBy("customer_id").agg(
        *profile_aggregates(),
        F.avg(F.when((r == lo) | (r == hi), amt)).alias("profile_amt_median"),
        F.max(F.when(r == q_idx, amt)).alias("profile_amt_p95"))
    return profile_columns(prof)


def profile_aggregates() -> list[Column]:
    """The profile's aggregates that need no order."""
    amt = F.col("amt")
    return [F.count(F.lit(1)).alias("profile_txn_count"), F.avg(amt).alias("profile_amt_mean"),
            F.stddev_samp(amt).alias("_std"), F.max(amt).alias("profile_amt_max"),
            F.countDistinct("mcc_code_i").alias("profile_n_unique_mcc"), F.avg("hour").alias("_hour")]


def profile_columns(prof: DataFrame) -> DataFrame:
    return prof.select(
        "customer_id", "profile_txn_count", "profile_amt_mean",
        F.coalesce("_std", F.lit(0.0)).alias("profile_amt_std"),
        "profile_amt_median", "profile_amt_max", "profile_amt_p95", "profile_n_unique_mcc",
        F.coalesce("_hour", F.lit(12.0)).alias("profile_hour_mean"),
        (F.col("profile_txn_count") / PROFILE_DAYS).alias("profile_avg_daily_txns"),
    )


PROFILE_COLS = ["profile_txn_count", "profile_amt_mean", "profile_amt_std", "profile_amt_median",
                "profile_amt_max", "profile_amt_p95", "profile_n_unique_mcc", "profile_hour_mean",
                "profile_avg_daily_txns"]


def attach_profiles(rows: DataFrame, profiles: DataFrame) -> DataFrame:
    """J5 + A3: profile join (missing -> 0, T12) and profile-relative features."""
    df = rows.join(profiles, "customer_id", "left")
    df = df.fillna(0, subset=PROFILE_COLS)
    amt = F.col("amt")
    mean, p95, std = F.col("profile_amt_mean"), F.col("profile_amt_p95"), F.col("profile_amt_std")
    return df.withColumns({
        "amt_over_profile_mean": safe_ratio(amt, mean, F.abs(mean) > 0.01),
        "amt_over_profile_p95": safe_ratio(amt, p95, F.abs(p95) > 0.01),
        "amt_profile_zscore": safe_ratio(amt - mean, std, std > 1.0),
        "amt_drift_5": F.coalesce(F.col("amt_avg_5"), F.lit(0.0))
                       - F.coalesce(F.col("cust_prev_amt_mean"), F.lit(0.0)),
        "hour_drift": F.abs(F.coalesce(F.col("hour_mean_5"), F.lit(12.0))
                            - F.coalesce(F.col("profile_hour_mean"), F.lit(12.0))),
    })


# ---------------------------------------------------------------- priors

def _smoothed(cnt: Column, lbl: Column, red: Column) -> dict[str, Column]:
    return {
        "red_rate": (red + RATE_ADD) / (cnt + RATE_DEN),
        "red_share": (red + SHARE_ADD) / (lbl + SHARE_DEN),
    }


def prior_source(tl: DataFrame, border: str | None = fixture.VAL_WINDOW_START) -> DataFrame:
    """Train rows (before ``border`` when given) with their label."""
    src = tl.filter(F.col("period") == "train")
    if border is not None:
        src = src.filter(F.col("event_ts") < F.to_timestamp(F.lit(border)))
    return src


def stacked_priors(src: DataFrame, keys: list[str] = PRIOR_KEYS) -> DataFrame:
    """A4 + A6: ``(key_name, key_value, cnt, lbl, red, red_rate, red_share)`` for
    every key in one aggregation."""
    pairs = ", ".join(f"'{k}', CAST({k} AS BIGINT)" for k in keys)
    long = src.select(F.expr(f"stack({len(keys)}, {pairs}) AS (key_name, key_value)"),
                      F.col("target"))
    agg = long.groupBy("key_name", "key_value").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.count("target").alias("lbl"),
        F.coalesce(F.sum("target"), F.lit(0)).alias("red"))
    return agg.withColumns(_smoothed(F.col("cnt"), F.col("lbl"), F.col("red")))


def stacked_pair_priors(src: DataFrame, pairs: list[tuple[str, str]] = PRIOR_PAIRS) -> DataFrame:
    """A5 (+A6): interaction priors of all pairs in one aggregation."""
    body = ", ".join(f"'{a}x{b}', CAST({a} AS BIGINT), CAST({b} AS BIGINT)" for a, b in pairs)
    long = src.select(F.expr(f"stack({len(pairs)}, {body}) AS (pair_name, a_value, b_value)"),
                      F.col("target"))
    agg = long.groupBy("pair_name", "a_value", "b_value").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.count("target").alias("lbl"),
        F.coalesce(F.sum("target"), F.lit(0)).alias("red"))
    return agg.withColumns(_smoothed(F.col("cnt"), F.col("lbl"), F.col("red")))


def attach_priors(rows: DataFrame, src: DataFrame, keys: list[str] = PRIOR_KEYS,
                  pairs: list[tuple[str, str]] = PRIOR_PAIRS) -> DataFrame:
    """Join every prior, fill gaps with the column mean, risk products.

    Each join copies its rows column by column, so all columns but the joins' keys go through them as one struct.
    """
    single = stacked_priors(src, keys)
    duo = stacked_pair_priors(src, pairs)
    by = list(dict.fromkeys([*keys, *[c for pair in pairs for c in pair]]))
    df = packed(rows, by)
    filled = []
    for k in keys:
        t = single.filter(F.col("key_name") == k).select(
            F.col("key_value").alias("_kv"),
            F.col("cnt").alias(f"prior_{k}_cnt"),
            F.col("red_rate").alias(f"prior_{k}_red_rate"),
            F.col("red_share").alias(f"prior_{k}_red_share"))
        df = df.join(t, F.col(k).cast("long") == F.col("_kv"), "left").drop("_kv")
        filled += [f"prior_{k}_cnt", f"prior_{k}_red_rate", f"prior_{k}_red_share"]
    for a, b in pairs:
        nm = f"{a}x{b}"
        t = duo.filter(F.col("pair_name") == nm).select(
            F.col("a_value").alias("_a"), F.col("b_value").alias("_b"),
            F.col("red_rate").alias(f"prior_{nm}_red_rate"),
            F.col("red_share").alias(f"prior_{nm}_red_share"))
        cond = (F.col(a).cast("long") == F.col("_a")) & (F.col(b).cast("long") == F.col("_b"))
        df = df.join(t, cond, "left").drop("_a", "_b")
        filled += [f"prior_{nm}_red_rate", f"prior_{nm}_red_share"]
    df = fill_with_mean(df, filled)
    df = unpacked(df, rows.columns, by, filled)
    return df.withColumns({
        out: F.col(p) * (1.0 + F.col(flag).cast("double")) for p, flag, out in RISK_PRODUCTS
        if flag in df.columns})


def fill_with_mean(df: DataFrame, cols: list[str]) -> DataFrame:
    """Nulls -> column mean, via one global aggregate broadcast as a single row."""
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in cols]).alias("_means"))
    out = attach_row(df, means)
    out = out.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col("_means")[c]) for c in cols})
    return out.drop("_means")


def fill_with_median(df: DataFrame, cols: list[str], ref: DataFrame | None = None) -> DataFrame:
    """Numeric nulls -> exact median of ``ref`` (the training rows).

    All columns go through one global scan over (column, distinct value) counts;
    a column without any value stays null.
    """
    from kestrel.operators.profiling import exact_quantiles
    ref = df if ref is None else ref
    body = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    long = ref.select(F.expr(f"stack({len(cols)}, {body}) AS (_c, _v)"))
    med = exact_quantiles(long, "_v", ["_c"], [0.5])
    one = med.agg(F.struct(*[F.max(F.when(F.col("_c") == c, F.col("value_q"))).alias(c) for c in cols]).alias("_medians"))
    out = attach_row(df, one)
    out = out.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col("_medians")[c]) for c in cols})
    return out.drop("_medians")
