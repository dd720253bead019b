"""Raw bank-event timeline derived from the driver's ``events`` table.

The production input is a set of event files with 23 raw columns (see
``kestrel.sources.schema.BASE_COLS``).  The test data has no such table, so
this module derives one from ``events`` with a fixed, documented mapping:
``k`` is the integer in ``props``; each raw column is a function of ``k``,
``event_type``, ``value``, ``user_id`` and the timestamp.  The same mapping
is given as SQL text in ``RAW_SQL`` for the DuckDB oracle.

All derived columns are computed per row (no shuffle); Catalyst prunes the
``events`` scan to the six columns used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Period borders and fixture date parameters (FIXTURES.md).
PRETRAIN_END = "2024-01-11"
TRAIN_END = "2024-01-24"
PRETEST_END = "2024-01-28"
NEG_SAMPLE_BORDER = "2024-01-17 00:00:00"
VAL_WINDOW_START = "2024-01-19 00:00:00"
VAL_WINDOW_END = "2024-01-24 00:00:00"
RECENT_BORDER = "2024-01-15 00:00:00"

# Same mapping as SQL text, valid in both Spark SQL and DuckDB.
RAW_SQL = """
WITH b AS (
  SELECT event_id, user_id, event_type, value,
         substr(cast(ts AS string), 1, 19)                   AS event_dttm,
         cast(substr(cast(ts AS string), 12, 2) AS int)      AS hh,
         cast(substr(cast(ts AS string), 9, 2) AS int)       AS dd,
         cast(regexp_extract(props, '([0-9]+)', 1) AS int)   AS k
  FROM events)
SELECT
  user_id                                                     AS customer_id,
  event_id,
  event_dttm,
  CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3
                  WHEN 'purchase' THEN 4 ELSE 5 END           AS event_type_nm,
  k % 20                                                      AS event_desc,
  k % 3                                                       AS channel_indicator_type,
  k % 6                                                       AS channel_indicator_sub_type,
  CASE WHEN k = 99 THEN NULL
       WHEN k % 10 = 0 THEN 500e0 * floor(value / 25e0)
       WHEN event_type = 'purchase' THEN -100e0 * value
       ELSE 100e0 * value END                                 AS operaton_amt,
  CASE WHEN k % 50 = 0 THEN 840 ELSE 643 END                  AS currency_iso_cd,
  CASE WHEN k % 9 = 0 THEN NULL WHEN k % 17 = 0 THEN 'n/a'
       ELSE cast(k % 13 AS string) END                        AS mcc_code,
  CASE WHEN k % 8 = 0 THEN NULL ELSE k % 5 END                AS pos_cd,
  CASE WHEN k >= 90 THEN NULL ELSE k % 7 END                  AS timezone,
  CASE WHEN k % 11 = 0 THEN NULL
       ELSE user_id * 10000 + dd * 10 + cast(floor(hh / 6e0) AS int) END AS session_id,
  CASE WHEN k < 50 THEN NULL ELSE k % 3 END                   AS operating_system_type,
  CASE WHEN k < 50 THEN NULL ELSE concat(cast(k AS string), '%') END AS battery,
  CASE WHEN k < 50 THEN NULL
       ELSE concat(cast(10 + k % 6 AS string), '.', cast(k % 4 AS string)) END AS device_system_version,
  CASE WHEN k < 50 THEN NULL
       ELSE concat(cast(300 + 10 * (k % 10) AS string), 'x800') END AS screen_size,
  CASE WHEN k < 50 THEN NULL WHEN k % 25 = 0 THEN 1 ELSE 0 END AS developer_tools,
  CASE WHEN k < 50 THEN NULL WHEN k % 12 = 0 THEN 1 ELSE 0 END AS phone_voip_call_state,
  CASE WHEN k < 50 THEN NULL WHEN k % 16 = 0 THEN 1 ELSE 0 END AS web_rdp_connection,
  CASE WHEN k < 50 THEN NULL WHEN k % 20 = 0 THEN 1 ELSE 0 END AS compromised,
  CASE WHEN k < 50 THEN NULL ELSE k % 5 END                   AS accept_language,
  CASE WHEN k < 60 THEN NULL ELSE k % 4 END                   AS browser_language,
  CASE WHEN event_dttm < '2024-01-11' THEN 'pretrain'
       WHEN event_dttm < '2024-01-24' THEN 'train'
       WHEN event_dttm < '2024-01-28' THEN 'pretest' ELSE 'test' END AS period,
  CASE WHEN event_dttm < '2024-01-11' OR event_dttm >= '2024-01-24' THEN NULL
       WHEN event_type = 'error' AND k % 5 < 2 THEN 1
       WHEN event_type = 'purchase' AND k % 4 = 0 THEN 0 END  AS target
FROM b
"""


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null_unless(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def vary(raw: DataFrame, variant: str | None) -> DataFrame:
    """Harder inputs: ``dense`` customers, ``bad`` times, ``dup`` licate events of two periods,
    a ``hot`` customer with a third of all events."""
    if variant == "dense":
        return raw.withColumn("customer_id", F.floor(F.col("customer_id") / 10))
    if variant == "hot":
        return raw.withColumn("customer_id", F.when(F.col("event_id") % 3 == 0, F.lit(1)).otherwise(F.col("customer_id")))
    if variant == "bad":
        return raw.withColumn("event_dttm", F.when(F.col("event_id") % 7 == 0, F.lit("bad"))
                              .otherwise(F.col("event_dttm")))
    if variant == "dup":
        return raw.unionByName(raw.filter(F.col("period") == "test").withColumn("period", F.lit("pretest")))
    return raw


def raw_events(spark: SparkSession, sf_dir: str, variant: str | None = None) -> DataFrame:
    """Raw timeline in the production shape (23 base columns + ``period`` + ``target``)."""
    return vary(_raw_events(spark, sf_dir), variant)


def _raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    ts_s = F.col("ts").cast("string")
    b = ev.select(
        "event_id", "user_id", "event_type", "value",
        F.substring(ts_s, 1, 19).alias("event_dttm"),
        F.substring(ts_s, 12, 2).cast("int").alias("hh"),
        F.substring(ts_s, 9, 2).cast("int").alias("dd"),
        F.regexp_extract("props", r"([0-9]+)", 1).cast("int").alias("k"),
    )
    k = F.col("k")
    et = F.col("event_type")
    dttm = F.col("event_dttm")
    no_dev = k < 50
    return b.select(
        F.col("user_id").alias("customer_id"),
        "event_id",
        "event_dttm",
        F.when(et == "view", 1).when(et == "click", 2).when(et == "signup", 3)
         .when(et == "purchase", 4).otherwise(5).alias("event_type_nm"),
        (k % 20).alias("event_desc"),
        (k % 3).alias("channel_indicator_type"),
        (k % 6).alias("channel_indicator_sub_type"),
        F.when(k == 99, F.lit(None).cast("double"))
         .when(k % 10 == 0, 500.0 * F.floor(F.col("value") / 25.0))
         .when(et == "purchase", -100.0 * F.col("value"))
         .otherwise(100.0 * F.col("value")).alias("operaton_amt"),
        F.when(k % 50 == 0, 840).otherwise(643).alias("currency_iso_cd"),
        F.when(k % 9 == 0, F.lit(None).cast("string")).when(k % 17 == 0, "n/a")
         .otherwise((k % 13).cast("string")).alias("mcc_code"),
        _null_unless(k % 8 == 0, k % 5).alias("pos_cd"),
        _null_unless(k >= 90, k % 7).alias("timezone"),
        _null_unless(k % 11 == 0, F.col("user_id") * 10000 + F.col("dd") * 10
                     + F.floor(F.col("hh") / 6.0).cast("int")).alias("session_id"),
        _null_unless(no_dev, k % 3).alias("operating_system_type"),
        _null_unless(no_dev, F.concat(k.cast("string"), F.lit("%"))).alias("battery"),
        _null_unless(no_dev, F.concat((10 + k % 6).cast("string"), F.lit("."),
                                      (k % 4).cast("string"))).alias("device_system_version"),
        _null_unless(no_dev, F.concat((300 + 10 * (k % 10)).cast("string"),
                                      F.lit("x800"))).alias("screen_size"),
        _null_unless(no_dev, F.when(k % 25 == 0, 1).otherwise(0)).alias("developer_tools"),
        _null_unless(no_dev, F.when(k % 12 == 0, 1).otherwise(0)).alias("phone_voip_call_state"),
        _null_unless(no_dev, F.when(k % 16 == 0, 1).otherwise(0)).alias("web_rdp_connection"),
        _null_unless(no_dev, F.when(k % 20 == 0, 1).otherwise(0)).alias("compromised"),
        _null_unless(no_dev, k % 5).alias("accept_language"),
        _null_unless(k < 60, k % 4).alias("browser_language"),
        F.when(dttm < PRETRAIN_END, "pretrain").when(dttm < TRAIN_END, "train")
         .when(dttm < PRETEST_END, "pretest").otherwise("test").alias("period"),
        F.when((dttm < PRETRAIN_END) | (dttm >= TRAIN_END), F.lit(None).cast("int"))
         .when((et == "error") & (k % 5 < 2), 1)
         .when((et == "purchase") & (k % 4 == 0), 0).alias("target"),
    )


def labels_from_raw(raw: DataFrame) -> DataFrame:
    """Label source (S4): ``event_id, customer_id, target`` for labelled events."""
    return raw.filter(F.col("target").isNotNull()).select(
        "event_id", "customer_id", F.col("target").cast("int").alias("target"))


def split_raw(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Separate the event stream (without the label) from the label table."""
    return raw.drop("target"), labels_from_raw(raw)
