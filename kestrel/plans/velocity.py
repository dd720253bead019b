"""Flagship plan: per-event velocity table (build-plan minimum slice).

``events -> timeline -> W1, W2, W6 (customer windows, one exchange)
-> R1 (1h, 24h), R2 (24h), R7 burst ratio (range frames, same partitioning)``
on the non-pretrain rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.parse import safe_ratio
from kestrel.functions.scalars import EXACT_AMOUNT
from kestrel.functions.windows import since, wc, wk, wr


def velocity_table(tl: DataFrame) -> DataFrame:
    w = wc()
    df = tl.select(
        "customer_id", "event_id", "period", "event_ts", "ets", "amt_abs",
        (F.row_number().over(w) - 1).alias("cust_prev_events"),
        (F.row_number().over(wk("mcc_code_i")) - 1).alias("cnt_prev_same_mcc"),
        F.lag("ets", 1).over(w).alias("_prev_ets"),
    )
    df = df.withColumn("sec_since_prev_event", since(F.col("ets"), F.col("_prev_ets")))
    live = df.filter(F.col("period") != "pretrain")
    timed = F.col("ets").isNotNull()  # an event without a time is in no window and has none
    amount = F.sum(F.col("amt_abs").cast(EXACT_AMOUNT)).over(wr(86400)).cast("double")
    live = live.withColumns({
        "cnt_1h": F.when(timed, F.count(F.lit(1)).over(wr(3600))).otherwise(F.lit(0)),
        "cnt_24h": F.when(timed, F.count(F.lit(1)).over(wr(86400))).otherwise(F.lit(0)),
        "amt_sum_24h": F.when(timed, F.coalesce(amount, F.lit(0.0))).otherwise(F.lit(0.0)),
    })
    c1, c24 = F.col("cnt_1h"), F.col("cnt_24h")
    live = live.withColumn("burst_ratio_1h_24h", safe_ratio(c1.cast("double"), c24, c24 > 0))
    return live.select("event_id", "cust_prev_events", "cnt_prev_same_mcc",
                       "sec_since_prev_event", "cnt_1h", "cnt_24h", "amt_sum_24h",
                       "burst_ratio_1h_24h")


def velocity_table_split(tl: DataFrame, bucket_rows: int | None = None,
                         materialize: bool = True) -> DataFrame:
    """Same table, skew-proof: every feature is a prefix statistic of one stream.

    Stream rows per customer, ordered by ``(t, ord, event_id)``:

    * the events themselves (``ord = 0``) carry the per-row specs: prior
      count, prior count with the same MCC (ROWS semantics, ties ordered by
      id) and the latest earlier time (a prefix max = the lag);
    * for live (non-pretrain) events, ``+1`` / ``+amount`` at ``t`` and ``-1``
      / ``-amount`` at ``t + p`` (``ord = 1``, after every event at the same
      second): their exclusive prefix sums are the ``[t - p, t)`` windows.

    ``exclusive_prefix`` splits hot customers into time buckets, so even a
    customer holding a third of all rows is spread over many tasks; one
    exchange in total.  The 6-column input is cut from the lineage once
    (reliable checkpoint) because the stream reads it four times.
    """
    from kestrel.operators.prefix import PrefixSpec, exclusive_prefix
    dec = EXACT_AMOUNT
    live = F.col("period") != "pretrain"
    base = tl.select("customer_id", "event_id", "period", "ets", "amt_abs", "mcc_code_i")
    if materialize:
        from kestrel.plans.features import cut
        base = cut(base, True)
    real = base.select("customer_id", "event_id", F.col("ets").alias("_t"), F.lit(0).alias("_ord"),
                       "mcc_code_i", "period", F.lit(1).alias("_q"))
    src = base.filter(live & F.col("ets").isNotNull())

    def deltas(shift: int, w1, w24, s24):
        return src.select("customer_id", "event_id", (F.col("ets") + shift).alias("_t"),
                          F.lit(1).alias("_ord"), F.lit(0).alias("_q"),
                          F.lit(w1).cast("long").alias("_w1"), F.lit(w24).cast("long").alias("_w24"),
                          (F.col("amt_abs").cast(dec) * s24).cast(dec).alias("_s24"))

    stream = real.unionByName(deltas(0, 1, 1, 1), allowMissingColumns=True)
    stream = stream.unionByName(deltas(3600, -1, 0, 0), allowMissingColumns=True)
    stream = stream.unionByName(deltas(86400, 0, -1, -1), allowMissingColumns=True)
    # order within one second: events first, then deltas, each by id
    stream = stream.withColumn("_oid", F.struct("_ord", "event_id"))
    q = F.col("_q") == 1
    specs = [
        PrefixSpec("cust_prev_events", None, F.when(q, F.lit(1))),
        PrefixSpec("cnt_prev_same_mcc", "mcc_code_i", F.when(q, F.lit(1))),
        PrefixSpec("_prev_t", None, F.when(q, F.col("_t")), agg="max"),
        PrefixSpec("cnt_1h", None, F.col("_w1")),
        PrefixSpec("cnt_24h", None, F.col("_w24")),
        PrefixSpec("_s24", None, F.col("_s24"), dtype=dec),
    ]
    out = exclusive_prefix(stream, ["customer_id"], specs, time_col="_t", id_col="_oid",
                           bucket_rows=bucket_rows)
    out = out.filter(q & live)
    c1, c24 = F.col("cnt_1h"), F.col("cnt_24h")
    return out.select(
        "event_id", "cust_prev_events", "cnt_prev_same_mcc",
        since(F.col("_t"), F.col("_prev_t")).alias("sec_since_prev_event"),
        "cnt_1h", "cnt_24h", F.col("_s24").cast("double").alias("amt_sum_24h"),
        safe_ratio(c1.cast("double"), c24, c24 > 0).alias("burst_ratio_1h_24h"))


def velocity_block(tl: DataFrame, bucket_rows: int | None = None) -> DataFrame:
    """Customers of up to ``bucket_rows`` rows by plain windows, the others by the split stream."""
    from kestrel.operators.prefix import BUCKET_ROWS
    from kestrel.operators.split import by_rows
    rows = bucket_rows or BUCKET_ROWS
    slim = tl.select("customer_id", "event_id", "period", "event_ts", "ets", "amt_abs", "mcc_code_i")
    return by_rows(slim, ["customer_id"], rows, velocity_table, lambda df: velocity_table_split(df, rows))
