"""Multi-part scans and the period union (inventory S1-S3, J1, U1)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_COLS = ["customer_id", "event_id", "event_dttm", "event_type_nm", "event_desc",
             "channel_indicator_type", "channel_indicator_sub_type", "operaton_amt",
             "currency_iso_cd", "mcc_code", "pos_cd", "timezone", "session_id",
             "operating_system_type", "battery", "device_system_version", "screen_size",
             "developer_tools", "phone_voip_call_state", "web_rdp_connection", "compromised",
             "accept_language", "browser_language"]


def read_parts(spark: SparkSession, paths: list[str], cols: list[str] = BASE_COLS,
               with_part: bool = False) -> DataFrame:
    """S1 + S2: one projected scan over several parts (Catalyst prunes columns).

    ``part_id`` is the place of the part in ``paths``, however many files it has.
    """
    if not with_part:
        return spark.read.parquet(*paths).select(*cols)
    parts = [spark.read.parquet(p).select(*cols, F.lit(k).alias("part_id")) for k, p in enumerate(paths)]
    return reduce(DataFrame.unionByName, parts)


def period_union(pretrain: DataFrame, train: DataFrame, pretest: DataFrame,
                 test: DataFrame) -> DataFrame:
    """S3 + J1 + U1: tag periods; pretest / test limited to customers of the part
    (left-semi join to the part's pretrain customers); relaxed union by name."""
    custs = pretrain.select("customer_id").distinct()
    frames = [pretrain.withColumn("period", F.lit("pretrain")),
              train.withColumn("period", F.lit("train")),
              pretest.join(custs, "customer_id", "left_semi").withColumn("period", F.lit("pretest")),
              test.join(custs, "customer_id", "left_semi").withColumn("period", F.lit("test"))]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
