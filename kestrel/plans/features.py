"""Full feature build (entry A of the source pipeline), Spark-first.

Exchange budget, in order:

1. timeline: labels joined by (customer, event), so that no customer meets in one task; staged
   in buckets of ``customer_id`` with a folder for each period (one exchange), long customers apart;
2. customer block W/F and the rolling block R read the buckets without an exchange
   (rolling counts only non-pretrain rows through conditional aggregates,
   so no filter / re-shuffle is needed between them); long customers are split by time;
3. device block D on a slim 12-column projection of every event (two-level
   prefix scan, partitioned by (device, hour bucket)), joined back to the
   sampled rows on ``event_id``;
4. profiles (pretrain) and priors (train before the border): small aggregates,
   joined back with AQE choosing broadcast or shuffle by measured size.

After the row-level blocks the sampled rows are the natural lineage cut:
``cut`` writes them to the shared checkpoint folder (never a machine-local
one) so a lost executor recomputes from the checkpoint, not from the raw
files, and the join-heavy tail plans against a small frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.functions.parse import (amount_columns, calendar_columns, null_pattern_columns,
                                     risk_flag_columns)
from kestrel.operators import customer as C
from kestrel.operators.device import device_features
from kestrel.operators.priors import RISK_PRODUCTS, attach_priors, attach_profiles, prior_source
from kestrel.operators.hot import FRAME_ROWS, customer_split, profile_block, rolling_split
from kestrel.operators.rolling import profile_ratio_columns, rolling_features
from kestrel.operators.sampling import training_columns
from kestrel.operators.split import by_rows, long_keys, parted
from kestrel.sources.sinks import bucketed_stage, stage
from kestrel.sources.timeline import dedup_by_event


def interaction_columns() -> dict:
    """Products of novelty / risk flags with device and velocity ratios."""
    s = F.col("sec_since_prev_event")
    risk = F.col("any_risk_flag").cast("double")
    return {
        "new_device_diversity_risk": F.col("is_new_device_for_customer").cast("double")
                                     * F.coalesce(F.col("device_customer_diversity"), F.lit(0.0)),
        "risk_velocity_interaction": risk * F.coalesce(F.col("burst_ratio_1h_24h"), F.lit(0.0)),
        "risk_spend_concentration": risk * F.coalesce(F.col("spend_concentration_1h"), F.lit(0.0)),
        "rapid_timezone_switch": ((F.col("is_new_timezone_for_customer") == 1)
                                  & (F.coalesce(F.col("tz_change_cnt_24h"), F.lit(0)) > 0)
                                  & (s > 0) & (s < 3600)).cast("int"),
    }


# Per-row columns the window chain reads; the other per-row columns are
# computed after it, so the rows sorted by each window stay narrow.
_WINDOW_INPUTS = {"hour", "event_date", "amt_abs"}


def timeline_block(tl: DataFrame, rolling_method: str = "frame", frame_rows: int = FRAME_ROWS) -> DataFrame:
    """Customer (W, F) and rolling (R) features.

    Customers of up to ``frame_rows`` rows share one customer partitioning; longer
    ones, counted first, take the split plans of ``operators.hot``.
    """
    return by_rows(tl, ["customer_id"], frame_rows, lambda d: _short(d, rolling_method), lambda d: _long(d, frame_rows))


def _without_late(tl: DataFrame, plan) -> DataFrame:
    """``plan`` over the columns that windows read; the other per-row columns come after it."""
    late = {**calendar_columns(), **amount_columns(), **risk_flag_columns()}
    late = {k: v for k, v in late.items() if k not in _WINDOW_INPUTS and k in tl.columns}
    return plan(tl.drop(*late), F.col("period") != "pretrain").withColumns(late)


def _short(tl: DataFrame, rolling_method: str) -> DataFrame:
    return _without_late(tl, lambda d, live: rolling_features(C.customer_features(d), method=rolling_method, live=live))


def _long(tl: DataFrame, rows: int) -> DataFrame:
    return _without_late(tl, lambda d, live: rolling_split(customer_split(d, bucket_rows=rows), live, rows))


def _customer_stage(tl: DataFrame, rolling_method: str, frame_rows: int) -> tuple[DataFrame, DataFrame]:
    """The staged timeline, and the customer and rolling features read from it.

    Customers of up to ``frame_rows`` rows are bucketed, so that their windows and profiles need no
    further exchange; longer ones are staged without buckets and split by time.
    """
    key = ["customer_id"]
    sizes = cut(tl.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")), True)
    n = task_buckets(tl.sparkSession, sizes.agg(F.sum("_n")).first()[0] or 0)
    long = long_keys(sizes, key, frame_rows, F.sum("_n"))
    if long is None:
        tl = bucketed_stage(tl, "timeline", *key, "period", n)
        return tl, _short(tl, rolling_method)
    short, rest = parted(tl, key, long)
    short, rest = bucketed_stage(short, "timeline", *key, "period", n), stage(rest, "long", "period")
    return short.unionByName(rest), _short(short, rolling_method).unionByName(_long(rest, frame_rows))


#: Rows of a bucket, at about: each of the block's sorts then fits the one page that it takes at least.
STAGE_ROWS = 50_000


def task_buckets(spark: SparkSession, rows: int) -> int:
    """Buckets of a stage of ``rows`` rows: about ``STAGE_ROWS`` each, fewer rows only to give every core some thousands."""
    return max(-(-rows // STAGE_ROWS), min(spark.sparkContext.defaultParallelism, -(-rows // 4000)), 1)


def cut(df: DataFrame, enabled: bool) -> DataFrame:
    """Reliable lineage cut in the shared ``spark.checkpoint.dir``."""
    if not enabled:
        return df
    from kestrel.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Columns of the customer and rolling blocks that profiles, priors and their ratios read.
TAIL_INPUTS = {"amt_avg_5", "hour_mean_5", "cust_prev_amt_mean", "cnt_1h", "unique_mcc_24h", *[flag for _, flag, _ in RISK_PRODUCTS]}


def build_features(tl: DataFrame, *, rolling_method: str = "frame", checkpoint: bool = True,
                   prior_border: str | None = "default", dedup: bool = True,
                   device_scope: str = "global", columns: tuple[str, ...] | None = None) -> DataFrame:
    """Sampled train + test rows with every feature column (W, F, R, D, A, P14, P17).

    ``dedup`` (default) keeps one row per event id, so nothing multiplies when
    blocks are joined back; pass False only for a timeline built with dedup.
    The timeline is staged once as Parquet and read with column pruning by the
    customer, device, profile and prior blocks.  The row-level blocks run over
    every event; only then are the sampled train + test rows kept and cut from
    the lineage, so the joins plan and run against that small frame.
    ``columns``: the columns of the row-level blocks that are asked for, where these are few; windows that neither
    they nor the later blocks read are then not computed.  The timeline's own columns are always there.
    """
    own = set(tl.columns)
    if dedup:
        tl = dedup_by_event(tl)
    if checkpoint:
        tl, rows = _customer_stage(tl, rolling_method, FRAME_ROWS)
    else:
        rows = timeline_block(tl, rolling_method)
    dev = device_features(tl, scope=device_scope, materialize=False)
    rows = rows.filter(F.col("is_train_sample") | F.col("is_test"))
    # the rows are partitioned by customer already: only the device columns move
    rows = rows.join(dev, ["customer_id", "event_id"], "left").withColumns(interaction_columns())
    if columns is not None:
        rows = rows.select(*[c for c in rows.columns if c in own or c in TAIL_INPUTS or c in columns])
    rows = cut(rows, checkpoint)
    prof = profile_block(tl.filter(F.col("period") == "pretrain"))
    rows = attach_profiles(rows, prof).withColumns(profile_ratio_columns())
    src = prior_source(tl) if prior_border == "default" else prior_source(tl, prior_border)
    rows = attach_priors(rows, src)
    return rows.withColumns({**null_pattern_columns(), **training_columns()})
