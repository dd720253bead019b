"""Typed event timeline: parse, dedup, label join, sample flags.

At scale the timeline is partitioned once by ``customer_id``; the label table
is partitioned the same way and joined on ``(customer_id, event_id)`` so the
join reuses that exchange (see ``kestrel.session``: co-partitioning on a
subset of the join keys is allowed).  When the label table is small AQE turns
the join into a broadcast on its own, after measuring it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from kestrel.functions import parse
from kestrel.sources import fixture

# Negative-sampling moduli and seed (L1).
SEED = 42
NEG_SAMPLE_MOD_RECENT = 5
NEG_SAMPLE_MOD_OLD = 15

# Period priority for dedup by event_id (T1: test wins over pretest).
PERIOD_PRIORITY = {"test": 0, "train": 1, "pretest": 2, "pretrain": 3}


def mix_hash(seed: int) -> Column:
    """Portable integer mixing hash, identical in Spark and DuckDB (L1 oracle variant)."""
    return F.col("event_id") * 1000003 + F.col("customer_id") * 7919 + F.lit(seed)


def xx_hash(seed: int) -> Column:
    return F.xxhash64(F.col("event_id"), F.col("customer_id"), F.lit(seed))


def dedup_by_event(df: DataFrame) -> DataFrame:
    """One row per ``event_id``; the survivor is the highest-priority period.

    Deterministic (period priority, then customer) instead of an arbitrary
    survivor.  One shuffle on ``event_id``.
    """
    prio = F.create_map(*[x for k, v in PERIOD_PRIORITY.items() for x in (F.lit(k), F.lit(v))])
    w = Window.partitionBy("event_id").orderBy(prio[F.col("period")], F.col("customer_id"))
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1).drop("_rn"))


def attach_labels(tl: DataFrame, labels: DataFrame) -> DataFrame:
    """Left join of labels on ``(customer_id, event_id)``, all periods."""
    lab = labels.select("customer_id", "event_id", F.col("target").cast("int").alias("target"))
    return tl.join(lab, ["customer_id", "event_id"], "left")


def sample_flags(tl: DataFrame, border: str = fixture.NEG_SAMPLE_BORDER,
                 seed: int = SEED, hash_kind: str = "xxhash") -> DataFrame:
    """P20 + L1: training-target columns and deterministic negative sampling.

    Unlabelled train rows are kept when ``hash % 5 == 0`` (after ``border``)
    or ``hash(seed+17) % 15 == 0`` (before it); labelled rows always.
    """
    h = mix_hash if hash_kind == "mix" else xx_hash
    is_train = F.col("period") == "train"
    raw = F.when(is_train, F.coalesce(F.col("target"), F.lit(-1))).otherwise(F.lit(None).cast("int"))
    border_ts = F.to_timestamp(F.lit(border))
    keep_green = (is_train & (raw == -1) & (
        ((F.col("event_ts") >= border_ts) & (F.pmod(h(seed), F.lit(NEG_SAMPLE_MOD_RECENT)) == 0))
        | ((F.col("event_ts") < border_ts) & (F.pmod(h(seed + 17), F.lit(NEG_SAMPLE_MOD_OLD)) == 0))))
    df = tl.withColumns({"train_target_raw": raw})
    df = df.withColumns({
        "keep_green": F.coalesce(keep_green, F.lit(False)),
        "is_test": F.col("period") == "test",
    })
    df = df.withColumns({
        "is_train_sample": is_train & ((F.col("train_target_raw") != -1) | F.col("keep_green")),
        "is_red_lbl": (is_train & (F.col("train_target_raw") == 1)).cast("int"),
        "is_yellow_lbl": (is_train & (F.col("train_target_raw") == 0)).cast("int"),
    })
    return df.withColumns({
        "target_bin": F.when(F.col("is_train_sample"),
                             (F.col("train_target_raw") == 1).cast("int")),
        "is_labeled_fb": F.col("is_red_lbl") + F.col("is_yellow_lbl"),
    })


def build_timeline(raw: DataFrame, labels: DataFrame | None = None, *,
                   dedup: bool = False, hash_kind: str = "xxhash",
                   by_customer: bool = True) -> DataFrame:
    """Raw events (+ labels) -> typed, enriched, label-flagged timeline.

    Partitioned by ``customer_id`` so the customer window block that follows
    needs no further exchange; ``by_customer=False`` for plans without
    customer windows (aggregates, scoring), which then pay no exchange here.
    """
    tl = parse.parse_timeline(raw.drop("target") if "target" in raw.columns else raw)
    if dedup:
        tl = dedup_by_event(tl)
    if by_customer:
        tl = tl.repartition("customer_id")
    if labels is not None:
        tl = attach_labels(tl, labels)
    else:
        tl = tl.withColumn("target", F.lit(None).cast("int"))
    tl = parse.enrich_rows(tl)
    return sample_flags(tl, hash_kind=hash_kind)


def fixture_timeline(spark: SparkSession, sf_dir: str, *, hash_kind: str = "mix", dedup: bool = False,
                     by_customer: bool = True, variant: str | None = None) -> DataFrame:
    raw = fixture.raw_events(spark, sf_dir, variant)
    events, labels = fixture.split_raw(raw)
    return build_timeline(events, labels, hash_kind=hash_kind, dedup=dedup, by_customer=by_customer)
