"""Build tiny raw timelines (production raw shape) for hand-computed tests."""

from datetime import datetime, timedelta

from pyspark.sql import types as T

BASE = datetime(2024, 1, 15, 12, 0, 0)

RAW_SCHEMA = T.StructType([
    T.StructField("customer_id", T.LongType()), T.StructField("event_id", T.LongType()),
    T.StructField("event_dttm", T.StringType()), T.StructField("event_type_nm", T.IntegerType()),
    T.StructField("event_desc", T.IntegerType()),
    T.StructField("channel_indicator_type", T.IntegerType()),
    T.StructField("channel_indicator_sub_type", T.IntegerType()),
    T.StructField("operaton_amt", T.DoubleType()), T.StructField("currency_iso_cd", T.IntegerType()),
    T.StructField("mcc_code", T.StringType()), T.StructField("pos_cd", T.IntegerType()),
    T.StructField("timezone", T.IntegerType()), T.StructField("session_id", T.LongType()),
    T.StructField("operating_system_type", T.IntegerType()), T.StructField("battery", T.StringType()),
    T.StructField("device_system_version", T.StringType()), T.StructField("screen_size", T.StringType()),
    T.StructField("developer_tools", T.IntegerType()),
    T.StructField("phone_voip_call_state", T.IntegerType()),
    T.StructField("web_rdp_connection", T.IntegerType()), T.StructField("compromised", T.IntegerType()),
    T.StructField("accept_language", T.IntegerType()), T.StructField("browser_language", T.IntegerType()),
    T.StructField("period", T.StringType()), T.StructField("target", T.IntegerType()),
])

DEFAULTS = dict(customer_id=1, event_type_nm=1, event_desc=1, channel_indicator_type=1,
                channel_indicator_sub_type=1, operaton_amt=100.0, currency_iso_cd=643,
                mcc_code="5", pos_cd=1, timezone=3, session_id=10, operating_system_type=1,
                battery="50%", device_system_version="14.1", screen_size="390x800",
                developer_tools=0, phone_voip_call_state=0, web_rdp_connection=0, compromised=0,
                accept_language=1, browser_language=1, period="train", target=None)


def raw(spark, rows):
    """rows: dicts with ``t`` (seconds after BASE) or ``dttm`` plus overrides."""
    out = []
    for i, r in enumerate(rows):
        d = dict(DEFAULTS)
        d.update({k: v for k, v in r.items() if k not in ("t",)})
        d.setdefault("event_id", i + 1)
        if "event_dttm" not in r:
            d["event_dttm"] = (BASE + timedelta(seconds=r.get("t", 60 * i))).strftime("%Y-%m-%d %H:%M:%S")
        out.append(tuple(d.get(f.name) for f in RAW_SCHEMA.fields))
    return spark.createDataFrame(out, RAW_SCHEMA)


def timeline(spark, rows):
    from kestrel.sources.fixture import split_raw
    from kestrel.sources.timeline import build_timeline
    events, labels = split_raw(raw(spark, rows))
    return build_timeline(events, labels, hash_kind="mix")


def by_id(df, *cols):
    return {r["event_id"]: tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]]
            for r in df.select("event_id", *cols).collect()}
