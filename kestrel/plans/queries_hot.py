"""Registered queries on customers that one task should not hold: W, F, R and A blocks by their split plans.

The timeline is the fixture's ``hot`` variant (one customer has a third of all
events) or ``dense`` variant; a customer of over ``LIMIT`` events is split.  The oracles are those of
the plain blocks, over the same variant.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import customer as C
from kestrel.operators import hot
from kestrel.plans import queries_features as QF
from kestrel.plans import queries_timeline as QT
from kestrel.plans.catalog import QUERIES, register
from kestrel.plans.oracle import on_variant
from kestrel.plans.velocity import velocity_block
from kestrel.sources.sinks import stage
from kestrel.sources.timeline import fixture_timeline

#: Events of a customer above which these queries split it.
LIMIT = 200

#: plain query -> its oracle and the customer blocks that it shows
_BLOCKS = {
    "cust_counts": (QT.CUST_COUNTS_SQL, ("counts",)),
    "cust_lags": (QT.CUST_LAGS_SQL, ("lag",)),
    "cust_amounts": (QT.CUST_AMOUNTS_SQL, ("amount",)),
    "cust_session_day": (QT.CUST_SESSION_DAY_SQL, ("session_day",)),
    "markov": (QT.MARKOV_SQL, ("markov",)),
    "moving_avg": (QT.MOVING_AVG_SQL, ("moving_avg",)),
    "feedback": (QT.FEEDBACK_SQL, ("feedback",)),
}


def _block(name: str, sql: str, blocks: tuple[str, ...], variant: str):
    @register(f"{name}_{variant}", on_variant(sql, variant))
    def query(spark, sf_dir):
        df = hot.customer_block(fixture_timeline(spark, sf_dir, by_customer=False, variant=variant), blocks, LIMIT)
        return df.select(*QUERIES[name](spark, sf_dir).columns)
    query.__doc__ = f"The {name} features where customers of over {LIMIT} events are split; {variant} variant."


for _name, (_sql, _blocks) in _BLOCKS.items():
    _block(_name, _sql, _blocks, "hot")
_block("cust_lags", QT.CUST_LAGS_SQL, ("lag",), "bad")


#: What the lag block and the rolling windows read of the timeline; the split plans stage their rows.
_LAG_INPUT = list(dict.fromkeys([
    "customer_id", "event_id", "event_ts", "ets", "period", "amt", "amt_abs", "mcc_code_i", "session_id", "operating_system_type",
    "screen_w", "timezone", "phone_voip_call_state", *[key for _, key in C.SINCE_SAME]]))


def _rolling(variant: str):
    @register(f"rolling_split_{variant}", on_variant(QF.ROLLING_SQL, variant))
    def query(spark, sf_dir):
        live = F.col("period") != "pretrain"
        tl = fixture_timeline(spark, sf_dir, by_customer=False, variant=variant).select(*_LAG_INPUT)
        df = hot.customer_block(tl, ("lag",), LIMIT)
        # the block is read for the customers' sizes and for both plans: staged, with the columns of its readers
        df = stage(df.select(*hot.ROLLED, "period"), "lags")
        df = hot.rolling_block(df, live=live, frame_rows=LIMIT)
        return df.filter(live).select("event_id", *QF._ROLL_COLS)
    query.__doc__ = f"R1-R7, linear and split for customers of over {LIMIT} events; {variant} variant."


for _v in ("hot", "dense", "bad"):
    _rolling(_v)


@register("profile_hot", on_variant(QF.PROFILE_SQL, "hot"))
def q_profile_hot(spark, sf_dir):
    """A1-A2 with ranks from a range scan for customers of over LIMIT events; hot variant."""
    tl = fixture_timeline(spark, sf_dir, by_customer=False, variant="hot")
    return hot.profile_block(tl.filter(F.col("period") == "pretrain"), LIMIT)


@register("target_encoding_hot", on_variant(QT.TARGET_ENCODING_SQL, "hot"))
def q_target_encoding_hot(spark, sf_dir):
    """F6 by split groups; hot variant."""
    tl = fixture_timeline(spark, sf_dir, by_customer=False, variant="hot").withColumn(
        "y_red", (F.col("train_target_raw") == 1).cast("double"))
    df = hot.target_encoding_split(tl, "mcc_code_i", target="y_red", bucket_rows=LIMIT, name="te_mcc_code_i")
    return df.select("event_id", "te_mcc_code_i")


@register("velocity_hot", on_variant(QT.VELOCITY_SQL, "hot"))
def q_velocity_hot(spark, sf_dir):
    """The velocity table, each customer by its own plan; hot variant."""
    return velocity_block(fixture_timeline(spark, sf_dir, by_customer=False, variant="hot"), LIMIT)
