"""Time-range velocity windows ``[t - p, t)`` per customer (inventory R1-R8).

Two physical forms, same results:

* ``method="frame"``: Spark RANGE frames over integer epoch seconds
  (``rangeBetween(-p, -1)``: exactly ``t - p`` is in, every row at ``t`` is
  out, T5).  Cost grows with rows x frame length.
* ``method="delta"`` (R1, R2, R4, R6): every event emits ``+w`` at ``t`` and
  ``-w`` at ``t + p``; one cumulative ``sum`` over ``RANGE UNBOUNDED
  PRECEDING .. 1 PRECEDING`` then equals the ``[t - p, t)`` total.  Linear in
  rows whatever the window length, so 7-day windows over heavy customers do
  not blow up.  Integer weights stay exact; amount sums use decimals.

Both run in the customer partitioning; the delta rows are unioned in, so no
join back is needed.  R3 (max) and R5 (distinct count) are not invertible
and always use frames (at most 24 h).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.functions.parse import safe_ratio
from kestrel.functions.scalars import EXACT_AMOUNT
from kestrel.functions.windows import wr

# Window lengths in seconds.
COUNT_WINDOWS = [("cnt_15min", 900), ("cnt_1h", 3600), ("cnt_6h", 21600),
                 ("cnt_24h", 86400), ("cnt_7d", 604800)]
SUM_WINDOWS = [("amt_sum_15min", 900), ("amt_sum_1h", 3600), ("amt_sum_24h", 86400)]
MAX_WINDOW = ("max_amt_last_24h", 86400)
VOIP_WINDOW = ("voip_cnt_15min", 900)
DISTINCT_WINDOWS = [("unique_mcc_1h", 3600), ("unique_mcc_24h", 86400)]
TZ_WINDOW = ("tz_change_cnt_24h", 86400)

_AMT_DEC = EXACT_AMOUNT


def _live(live: Column | None) -> Column:
    """Rows that count: live, and with a time (an event without one is in no window)."""
    timed = F.col("ets").isNotNull()
    return timed if live is None else timed & F.coalesce(live, F.lit(False))


def _timed(value: Column, missing: Column) -> Column:
    """A window value; ``missing`` on rows without a time, which have no window."""
    return F.when(F.col("ets").isNull(), missing).otherwise(value)


def _invertible_specs(live: Column | None = None) -> list[tuple[str, int, Column, str]]:
    """(output, seconds, weight, kind) for the prefix-decomposable features.

    Rows outside ``live`` weigh 0, so they never count in a window (the
    source computes velocity on non-pretrain rows only).
    """
    on = _live(live)
    one = F.when(on, F.lit(1)).otherwise(F.lit(0)).cast("long")
    specs = [(n, p, one, "count") for n, p in COUNT_WINDOWS]
    specs += [(n, p, F.when(on, F.col("amt_abs")).cast(_AMT_DEC), "sum") for n, p in SUM_WINDOWS]
    specs.append((VOIP_WINDOW[0], VOIP_WINDOW[1],
                  (on & (F.col("phone_voip_call_state") == 1)).cast("long"), "count"))
    specs.append((TZ_WINDOW[0], TZ_WINDOW[1],
                  F.when(on, F.col("tz_changed")).otherwise(F.lit(0)).cast("long"), "count"))
    return specs


def _frame_invertible(df: DataFrame, live: Column | None) -> DataFrame:
    on = _live(live)
    cols = {}
    for name, p, wgt, kind in _invertible_specs(live):
        if kind == "count":
            cols[name] = _timed(F.coalesce(F.sum(wgt).over(wr(p)), F.lit(0)), F.lit(0)).cast("long")
        else:
            dec = F.when(on, F.col("amt_abs")).cast(_AMT_DEC)
            cols[name] = _timed(F.coalesce(F.sum(dec).over(wr(p)).cast("double"), F.lit(0.0)), F.lit(0.0))
    return df.withColumns(cols)


def _delta_invertible(df: DataFrame, live: Column | None) -> DataFrame:
    """Delta-event form: one union, one sort, one cumulative sum per feature."""
    specs = _invertible_specs(live)
    names = [s[0] for s in specs]
    # Query rows keep every column; their own weights enter as additions at t.
    base = df.withColumns({"_t": F.col("ets"), "_q": F.lit(1)})
    base = base.withColumns({f"_d_{n}": w for n, _, w, _ in specs})
    periods = sorted({p for _, p, _, _ in specs})
    expiries = []
    for p in periods:
        e = df.filter(_live(live)).select(
            "customer_id", (F.col("ets") + p).alias("_t"),
            *[(-w if sp == p else F.lit(None).cast(_AMT_DEC if k == "sum" else "long")
               ).alias(f"_d_{n}") for n, sp, w, k in specs])
        expiries.append(e)
    exp = expiries[0]
    for e in expiries[1:]:
        exp = exp.unionByName(e)
    exp = exp.withColumn("_q", F.lit(0))
    allrows = base.unionByName(exp, allowMissingColumns=True)
    w = (Window.partitionBy("customer_id").orderBy("_t")
         .rangeBetween(Window.unboundedPreceding, -1))
    cols = {}
    for n, _, _, k in specs:
        s = F.sum(f"_d_{n}").over(w)
        cols[n] = (_timed(F.coalesce(s, F.lit(0)), F.lit(0)).cast("long") if k == "count"
                   else _timed(F.coalesce(s.cast("double"), F.lit(0.0)), F.lit(0.0)))
    out = allrows.withColumns(cols).filter(F.col("_q") == 1)
    return out.drop("_t", "_q", *[f"_d_{n}" for n in names])


def rolling_features(df: DataFrame, method: str = "frame", live: Column | None = None
                     ) -> DataFrame:
    """R1-R7 for every row of ``df``, counting only rows where ``live`` holds."""
    df = _delta_invertible(df, live) if method == "delta" else _frame_invertible(df, live)
    on = _live(live)
    mx_name, mx_p = MAX_WINDOW
    cols = {mx_name: _timed(F.max(F.when(on, F.col("amt_abs"))).over(wr(mx_p)), F.lit(None).cast("double"))}
    for name, p in DISTINCT_WINDOWS:
        cols[name] = _timed(F.size(F.collect_set(F.when(on, F.col("mcc_code_i"))).over(wr(p))), F.lit(0))
    df = df.withColumns(cols)
    return df.withColumns(ratio_columns())


def ratio_columns() -> dict[str, Column]:
    """R4 flag and R7 burst / concentration ratios."""
    c15, c1, c24 = F.col("cnt_15min"), F.col("cnt_1h"), F.col("cnt_24h")
    s1 = F.coalesce(F.col("amt_sum_1h"), F.lit(0.0))
    s24 = F.col("amt_sum_24h")
    a = F.col("amt_abs")
    u1, u24 = F.col("unique_mcc_1h"), F.col("unique_mcc_24h")
    s24f = F.coalesce(s24, F.lit(0.0))
    return {
        "had_voip_before_txn": (F.col("voip_cnt_15min") > 0).cast("int"),
        "amt_ratio_24h": safe_ratio(a, s24, s24 > 1.0, 1.0),
        "burst_ratio_1h_24h": safe_ratio(c1.cast("double"), c24, c24 > 0),
        "spend_concentration_1h": safe_ratio(s1, s24, s24 > 1.0),
        "burst_ratio_15m_1h": safe_ratio(c15.cast("double"), c1, c1 > 0),
        "mcc_scatter_ratio": safe_ratio(u1.cast("double"), u24, u24 > 0),
        "amt_vs_1h_sum": safe_ratio(a, s1 + 1.0, s1 > 1.0),
        "amt_vs_24h_sum": safe_ratio(a, s24f + 1.0, s24f > 1.0),
    }


def profile_ratio_columns() -> dict[str, Column]:
    """Velocity relative to the pretrain profile (after the A1 join)."""
    daily = F.col("profile_avg_daily_txns")
    nmcc = F.col("profile_n_unique_mcc")
    return {
        "velocity_ratio_1h": safe_ratio(F.coalesce(F.col("cnt_1h"), F.lit(0)).cast("double"),
                                        daily, daily > 0.1),
        "mcc_diversity_ratio": safe_ratio(F.coalesce(F.col("unique_mcc_24h"), F.lit(0)).cast("double"),
                                          nmcc, nmcc > 0),
    }
