"""Causal per-customer window features (inventory W1-W23, F1-F6).

Plan shape: the timeline arrives hash-partitioned by ``customer_id``; every
window spec below starts with ``customer_id`` so the whole block runs with
that single exchange and one sort per distinct spec.  Window expressions of
one spec are grouped in one projection so Catalyst emits one ``Window``
operator per spec.  "Prior" aggregates exclude the current row; ties in
``event_ts`` are ordered by ``event_id`` (T2).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from kestrel.functions.parse import safe_ratio
from kestrel.functions.scalars import EXACT_AMOUNT
from kestrel.functions.windows import last_n, prior, since, wc, whole, wk

# Categorical keys of the prior-count features (W2) as
# (output column, key column).
SAME_KEY_COUNTS = [
    ("cnt_prev_same_type", "event_type_nm"),
    ("cnt_prev_same_desc", "event_desc"),
    ("cnt_prev_same_mcc", "mcc_code_i"),
    ("cnt_prev_same_subtype", "channel_indicator_sub_type"),
    ("cnt_prev_same_session", "session_id"),
    ("cust_prev_same_device", "device_fp_i"),
    ("cust_prev_same_timezone", "timezone"),
    ("cust_prev_same_os", "operating_system_type"),
    ("cnt_prev_same_currency", "currency_iso_cd"),
    ("cust_prev_same_channel_type", "channel_indicator_type"),
]

# Columns with a log prior-count feature.
LOG_CNT_COLS = [
    "event_type_nm", "event_desc", "channel_indicator_type",
    "channel_indicator_sub_type", "currency_iso_cd", "mcc_code_i", "pos_cd", "timezone",
    "session_id", "operating_system_type", "developer_tools_i", "compromised_i",
    "phone_voip_call_state", "web_rdp_connection",
]

# Novelty flags (W4) as (output, prior-count column).
NOVELTY = [
    ("is_new_device_for_customer", "cust_prev_same_device"),
    ("is_new_desc_for_customer", "cnt_prev_same_desc"),
    ("is_new_mcc_for_customer", "cnt_prev_same_mcc"),
    ("is_new_timezone_for_customer", "cust_prev_same_timezone"),
    ("is_new_subtype_for_customer", "cnt_prev_same_subtype"),
    ("is_new_os_for_customer", "cust_prev_same_os"),
]

# Seconds since the previous same-category event.
SINCE_SAME = [
    ("sec_since_prev_same_type", "event_type_nm"),
    ("sec_since_prev_same_desc", "event_desc"),
    ("sec_since_prev_same_mcc", "mcc_code_i"),
    ("sec_since_prev_same_device", "device_fp_i"),
    ("sec_since_prev_same_currency", "currency_iso_cd"),
    ("sec_since_prev_same_channel_type", "channel_indicator_type"),
]

MOVING_AVG_N = [5, 10, 50, 100]

AMT_DECIMAL = EXACT_AMOUNT


def _rn(*keys) -> Column:
    return F.row_number().over(wk(*keys) if keys else wc())


# Each block = (raw window expressions, derived projections applied in order).
# ``customer_features`` emits the window expressions of all requested blocks in
# ONE projection, so Catalyst builds one Sort + Window per distinct
# (partition, order) spec for the whole block instead of one per expression
# group; the derived columns are plain projections afterwards.

def _counts_windows() -> dict[str, Column]:
    w = {"cust_event_idx": _rn()}
    w.update({f"_rn_{key}": _rn(key) for _, key in SAME_KEY_COUNTS})
    have = {key for _, key in SAME_KEY_COUNTS}
    w.update({f"_rn_{c}": _rn(c) for c in LOG_CNT_COLS if c not in have})
    w["_rn_combo"] = _rn("channel_indicator_sub_type", "operating_system_type")
    return w


def _counts_derived() -> list[dict[str, Column]]:
    d1 = {"cust_prev_events": F.col("cust_event_idx") - 1}
    d1.update({name: F.col(f"_rn_{key}") - 1 for name, key in SAME_KEY_COUNTS})
    d1.update({f"{c}_log_cnt": F.log1p(F.greatest(F.col(f"_rn_{c}") - 1, F.lit(0)))
               for c in LOG_CNT_COLS})
    d1["ch_dev_combo_log_cnt"] = F.log1p(F.greatest(F.col("_rn_combo") - 1, F.lit(0)))
    d2 = {name: (F.col(cnt) == 0).cast("int") for name, cnt in NOVELTY}
    return [d1, d2]


def _index_windows() -> dict[str, Column]:
    """Minimal counters needed by other blocks when ``counts`` is not requested."""
    return {"cust_event_idx": _rn(), "_rn_event_desc": _rn("event_desc")}


def _index_derived() -> list[dict[str, Column]]:
    return [{"cust_prev_events": F.col("cust_event_idx") - 1,
             "cnt_prev_same_desc": F.col("_rn_event_desc") - 1}]


def _lag_windows() -> dict[str, Column]:
    w = wc()
    out = {
        "prev_ets": F.lag("ets", 1).over(w),
        "prev_amt": F.lag("amt", 1).over(w),
        "_lag_mcc": F.lag("mcc_code_i", 1).over(w),
        "_lag_sess": F.lag("session_id", 1).over(w),
        "_prev_os": F.lag("operating_system_type", 1).over(w),
        "_prev_sw": F.lag("screen_w", 1).over(w),
        "_prev_tz": F.lag("timezone", 1).over(w),
    }
    out.update({f"_p_{name}": F.lag("ets", 1).over(wk(key)) for name, key in SINCE_SAME})
    return out


def _lag_derived() -> list[dict[str, Column]]:
    def changed(cur: str, prev: str) -> Column:
        return ((F.col(cur) != F.col(prev)) & F.col(prev).isNotNull()).cast("int")

    d1 = {
        "prev_mcc_code_i": F.coalesce(F.col("_lag_mcc"), F.lit(-1)),
        "prev_session_id": F.coalesce(F.col("_lag_sess"), F.lit(-1).cast("long")),
        "sec_since_prev_event": since(F.col("ets"), F.col("prev_ets")),
        "amt_delta_prev": F.col("amt") - F.coalesce(F.col("prev_amt"), F.lit(0.0)),
        "os_changed": changed("operating_system_type", "_prev_os"),
        "screen_changed": changed("screen_w", "_prev_sw"),
        "tz_changed": changed("timezone", "_prev_tz"),
        "tz_jump_magnitude": F.coalesce(F.abs(F.col("timezone") - F.col("_prev_tz")), F.lit(0)),
    }
    d1.update({name: since(F.col("ets"), F.col(f"_p_{name}")) for name, _ in SINCE_SAME})
    s = F.col("sec_since_prev_event")
    d2 = {
        "mcc_changed": (F.col("mcc_code_i") != F.col("prev_mcc_code_i")).cast("int"),
        "session_changed": (F.col("session_id") != F.col("prev_session_id")).cast("int"),
        "impossible_travel": ((F.col("tz_jump_magnitude") > 2) & (s > 0) & (s < 3600)).cast("int"),
    }
    return [d1, d2]


def _amount_windows() -> dict[str, Column]:
    """W10-W14 inputs.  Exact decimal running sums: a double running sum of
    squares cancels badly when the variance is near zero (hard case W11)."""
    w = prior(wc())
    dec = F.col("amt").cast(AMT_DECIMAL)
    return {
        "_s1": F.coalesce(F.sum(dec).over(w), F.lit(0)).cast("double"),
        "_s2": F.coalesce(F.sum((F.col("amt") * F.col("amt")).cast(AMT_DECIMAL)).over(w), F.lit(0)).cast("double"),
        "_pmax": F.max("amt_abs").over(w),
        "_prev_abs": F.lag("amt_abs", 1).over(wc()),
        "_desc_sum": F.coalesce(F.sum(dec).over(prior(wk("event_desc"))), F.lit(0)).cast("double"),
    }


def _amount_derived() -> list[dict[str, Column]]:
    """Null amounts count in the row denominators and yield null on their own
    row (T6).  The running max resets to 0 right after a null amount, as the
    source's shift-then-cumulative-max does."""
    amt = F.col("amt")
    idx = F.col("cust_event_idx")
    n_prev = idx - 1
    null_d = F.lit(None).cast("double")
    cnt_desc = F.col("cnt_prev_same_desc")
    d1 = {
        "cust_prev_amt_mean": F.when(idx > 1, F.when(amt.isNull(), null_d)
                                     .otherwise(F.col("_s1") / n_prev)).otherwise(F.lit(0.0)),
        "cust_prev_max_amt": F.when(F.col("_prev_abs").isNull(), F.lit(0.0)).otherwise(F.col("_pmax")),
        "cust_prev_mean_amt_same_desc": F.when(
            cnt_desc > 0, F.when(amt.isNull(), null_d).otherwise(F.col("_desc_sum") / cnt_desc)
        ).otherwise(F.lit(0.0)),
    }
    m = F.col("cust_prev_amt_mean")
    var = (F.col("_s2") / n_prev) - m * m
    d2 = {"cust_prev_amt_std": F.when(idx > 2, F.when(amt.isNull(), null_d).otherwise(
        F.sqrt(F.greatest(var, F.lit(0.0))))).otherwise(F.lit(0.0))}
    sd, mx, dm = F.col("cust_prev_amt_std"), F.col("cust_prev_max_amt"), F.col("cust_prev_mean_amt_same_desc")
    d3 = {
        "amt_to_prev_mean": safe_ratio(amt, m, F.abs(m) > 0.01),
        "amt_zscore": safe_ratio(amt - m, sd, sd > 1.0),
        "amt_vs_prev_max": safe_ratio(F.col("amt_abs"), mx, mx > 0.01),
        "amt_vs_same_desc_mean": safe_ratio(F.col("amt_abs"), dm, F.abs(dm) > 0.01),
    }
    return [d1, d2, d3]


def _session_day_windows() -> dict[str, Column]:
    ws = wk("session_id")
    wdt = wk("event_date")
    return {
        "_sess_sum": F.coalesce(F.sum(F.col("amt").cast(AMT_DECIMAL)).over(prior(ws)).cast("double"), F.lit(0.0)),
        "_sess_first": F.first("ets").over(whole(ws)),
        "_day_sum": F.coalesce(F.sum(F.col("amt_abs").cast(AMT_DECIMAL)).over(prior(wdt)).cast("double"), F.lit(0.0)),
        "today_max_amount": F.coalesce(F.max("amt_abs").over(prior(wdt)), F.lit(0.0)),
        "_rn_day": F.row_number().over(wdt),
        "_rn_hour": F.row_number().over(wk(F.date_trunc("hour", "event_ts"))),
        "_first_ets": F.first("ets").over(whole(wc())),
    }


def _session_day_derived() -> list[dict[str, Column]]:
    amt = F.col("amt")
    null_d = F.lit(None).cast("double")
    age = F.col("ets") - F.col("_first_ets")
    whole_days = F.floor(age / 86400)
    d1 = {
        "session_amt_before": F.when(amt.isNull(), null_d).otherwise(F.col("_sess_sum")),
        "sec_since_session_start": F.when(F.col("_sess_first").isNotNull(),
                                          F.col("ets") - F.col("_sess_first")).otherwise(F.lit(0)),
        "today_total_amount": F.when(amt.isNull(), null_d).otherwise(F.col("_day_sum")),
        "events_before_today": F.col("_rn_day") - 1,
        "events_before_hour": F.col("_rn_hour") - 1,
        "days_since_first_event": F.coalesce(age / 86400.0, F.lit(0.0)),
        "cust_events_per_day": F.when(whole_days > 0, F.col("cust_event_idx") / whole_days)
                                .otherwise(F.lit(1.0)),
    }
    tot = F.col("today_total_amount")
    d2 = {"today_amt_vs_daily_norm": safe_ratio(F.col("amt_abs"), tot, tot > 1.0, 1.0)}
    return [d1, d2]


def moving_avg_windows(w: WindowSpec) -> dict[str, Column]:
    """Means over the rows before, in the order of ``w``."""
    out = {}
    for n in MOVING_AVG_N:
        fr = last_n(w, n)
        out[f"amt_avg_{n}"] = F.when(F.count("amt").over(fr) == n, F.avg("amt").over(fr))
    fr5 = last_n(w, 5)
    out["hour_mean_5"] = F.when(F.count("hour").over(fr5) == 5, F.avg("hour").over(fr5))
    return out


def _moving_avg_windows() -> dict[str, Column]:
    return moving_avg_windows(wc())


def _moving_avg_derived() -> list[dict[str, Column]]:
    return [{"amt_momentum": F.coalesce(F.col("amt_avg_5"), F.lit(0.0))
             - F.coalesce(F.col("amt_avg_50"), F.lit(0.0))}]


def _feedback_windows() -> dict[str, Column]:
    w = prior(wc())
    wd = prior(wk("event_desc"))

    def psum(c: str, win) -> Column:
        return F.coalesce(F.sum(c).over(win), F.lit(0)).cast("int")

    return {
        "cust_prev_red_lbl_cnt": psum("is_red_lbl", w),
        "cust_prev_yellow_lbl_cnt": psum("is_yellow_lbl", w),
        "cust_prev_labeled_cnt": psum("is_labeled_fb", w),
        "_prev_red_ets": F.last(F.when(F.col("is_red_lbl") == 1, F.col("ets")), True).over(w),
        "_prev_yel_ets": F.last(F.when(F.col("is_yellow_lbl") == 1, F.col("ets")), True).over(w),
        "cnt_prev_labeled_same_desc": psum("is_labeled_fb", wd),
        "cnt_prev_red_same_desc_lbl": psum("is_red_lbl", wd),
        "cnt_prev_yellow_same_desc_lbl": psum("is_yellow_lbl", wd),
    }


def _feedback_derived() -> list[dict[str, Column]]:
    red, yel, lab = (F.col("cust_prev_red_lbl_cnt"), F.col("cust_prev_yellow_lbl_cnt"),
                     F.col("cust_prev_labeled_cnt"))
    return [{
        "cust_prev_red_lbl_rate": (red + 0.1) / (lab + 1.0),
        "cust_prev_yellow_lbl_rate": (yel + 0.1) / (lab + 1.0),
        "cust_prev_susp_lbl_rate": (red + yel + 0.1) / (F.col("cust_prev_events") + 1.0),
        "cust_prev_any_red_flag": (red > 0).cast("int"),
        "cust_prev_any_yellow_flag": (yel > 0).cast("int"),
        "red_rate_prev_same_desc_lbl": (F.col("cnt_prev_red_same_desc_lbl") + 0.1)
                                       / (F.col("cnt_prev_labeled_same_desc") + 1.0),
        "sec_since_prev_red_lbl": since(F.col("ets"), F.col("_prev_red_ets")),
        "sec_since_prev_yellow_lbl": since(F.col("ets"), F.col("_prev_yel_ets")),
    }]


def _markov_windows() -> dict[str, Column]:
    return {"_pc": F.row_number().over(wk("prev_mcc_code_i")) - 1,
            "_bc": F.row_number().over(wk("prev_mcc_code_i", "mcc_code_i")) - 1}


def _markov_derived() -> list[dict[str, Column]]:
    prob = F.col("_bc") / F.greatest(F.col("_pc"), F.lit(1))
    return [{"markov_mcc_prob": F.coalesce(prob, F.lit(0.0))},
            {"markov_mcc_surprise": -F.log(F.greatest(F.col("markov_mcc_prob"), F.lit(1e-6)))}]


_BLOCKS = {
    "counts": (_counts_windows, _counts_derived),
    "lag": (_lag_windows, _lag_derived),
    "amount": (_amount_windows, _amount_derived),
    "session_day": (_session_day_windows, _session_day_derived),
    "moving_avg": (_moving_avg_windows, _moving_avg_derived),
    "feedback": (_feedback_windows, _feedback_derived),
}
ALL_BLOCKS = ("counts", "lag", "amount", "session_day", "markov", "moving_avg", "feedback")
_NEEDS_INDEX = ("amount", "session_day", "feedback")


def derived_columns(blocks: tuple[str, ...]) -> list[dict[str, Column]]:
    """Per-row projections over the window columns of ``blocks``, to be applied in order."""
    derived: list[dict[str, Column]] = []
    if "counts" not in blocks and any(b in blocks for b in _NEEDS_INDEX):
        derived += _index_derived()
    if "markov" in blocks and "lag" not in blocks:
        derived.append({"prev_mcc_code_i": F.coalesce(F.col("_lag_mcc"), F.lit(-1))})
    for b in ALL_BLOCKS:
        if b in blocks and b in _BLOCKS:
            derived += _BLOCKS[b][1]()
    return derived


def customer_features(tl: DataFrame, blocks: tuple[str, ...] = ALL_BLOCKS) -> DataFrame:
    """Customer block (W, F): one exchange on ``customer_id``, one Sort + Window
    per distinct window spec, then per-row projections."""
    wins: dict[str, Column] = {}
    if "counts" not in blocks and any(b in blocks for b in _NEEDS_INDEX):
        wins.update(_index_windows())
    if "markov" in blocks and "lag" not in blocks:
        wins["_lag_mcc"] = F.lag("mcc_code_i", 1).over(wc())
    for b in ALL_BLOCKS:
        if b in blocks and b in _BLOCKS:
            wins.update(_BLOCKS[b][0]())
    df = tl.withColumns(wins)
    for d in derived_columns(blocks):
        df = df.withColumns(d)
    if "markov" in blocks:
        df = df.withColumns(_markov_windows())
        for d in _markov_derived():
            df = df.withColumns(d)
    return df.drop(*[c for c in df.columns if c.startswith("_") and c not in tl.columns])


def counts_block(df: DataFrame) -> DataFrame:
    """Event index, prior counts per (customer x key), log counts, novelty."""
    return customer_features(df, ("counts",))


def lag_block(df: DataFrame) -> DataFrame:
    """Lags, gaps, change flags, deltas, timezone jumps."""
    return customer_features(df, ("lag",))


def amount_block(df: DataFrame) -> DataFrame:
    """Expanding mean / std / max of amounts, same-desc mean."""
    return customer_features(df, ("amount",))


def session_day_block(df: DataFrame) -> DataFrame:
    """Session and calendar-day accumulations, intra-hour count, tenure."""
    return customer_features(df, ("session_day",))


def markov_block(df: DataFrame) -> DataFrame:
    """MCC transition probability and surprise from the customer's own past."""
    return customer_features(df, ("markov",))


def moving_avg_block(df: DataFrame) -> DataFrame:
    """Mean of the previous n amounts (null until n non-null exist), drift."""
    return customer_features(df, ("moving_avg",))


def feedback_block(df: DataFrame) -> DataFrame:
    """Label-history counts, smoothed rates, flags, time since last label."""
    return customer_features(df, ("feedback",))


def daily_rate(df: DataFrame, target: str) -> DataFrame:
    """(_te_day, _p): mean target over all rows of earlier days; one row a day."""
    day = df.where(F.col("event_date").isNotNull()).groupBy(F.col("event_date").alias("_te_day")).agg(
        F.sum(F.col(target).cast("long")).alias("s"), F.count(target).alias("n"))
    before = Window.orderBy("_te_day").rowsBetween(Window.unboundedPreceding, -1)
    return day.select("_te_day", F.coalesce(F.sum("s").over(before) / F.nullif(F.sum("n").over(before), F.lit(0)),
                                            F.lit(0.0)).alias("_p"))


def target_encoding(df: DataFrame, key: str, target: str = "target_bin",
                    alpha: float = 10.0, prior_rate: float | None = None,
                    name: str | None = None) -> DataFrame:
    """causal (ordered) target encoding of ``key`` within the customer's past.

    ``(sum(y) + alpha * p) / (count(y) + alpha)`` over earlier rows of the same
    (customer, key); rows without a target do not count.  ``p`` is the given
    ``prior_rate`` (from before a border) or the mean target of all earlier
    days, so no later label and no label of the row itself enters; rows without a
    time and rows of the first day have p = 0.
    """
    name = name or f"te_{key}"
    w = prior(wk(key))
    y = F.col(target).cast("double")
    if prior_rate is None:
        rate = daily_rate(df, target)
        df = df.join(rate, df["event_date"] == rate["_te_day"], "left").drop("_te_day")
        pr = F.coalesce(F.col("_p"), F.lit(0.0))
    else:
        pr = F.lit(float(prior_rate))
    enc = (F.coalesce(F.sum(y).over(w), F.lit(0.0)) + alpha * pr) / (F.count(y).over(w) + alpha)
    out = df.withColumn(name, enc)
    return out.drop("_p") if prior_rate is None else out
