"""Per-row parsing and derived columns (inventory P1-P16, P20).

All of these are plain Catalyst expressions: they run inside whole-stage
codegen, fuse with the scan and never shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Input timestamp format and feature sentinels.
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
FEATURE_SENTINEL = -1
SEQUENCE_SENTINEL = 0

# Raw column -> output name for non-strict integer casts with the -1 sentinel.
INT_CODES = [
    ("event_type_nm", "event_type_nm"),
    ("event_desc", "event_desc"),
    ("channel_indicator_type", "channel_indicator_type"),
    ("channel_indicator_sub_type", "channel_indicator_sub_type"),
    ("currency_iso_cd", "currency_iso_cd"),
    ("pos_cd", "pos_cd"),
    ("timezone", "timezone"),
    ("operating_system_type", "operating_system_type"),
    ("phone_voip_call_state", "phone_voip_call_state"),
    ("web_rdp_connection", "web_rdp_connection"),
    ("mcc_code", "mcc_code_i"),
    ("developer_tools", "developer_tools_i"),
    ("compromised", "compromised_i"),
    ("accept_language", "accept_language_i"),
    ("browser_language", "browser_language_i"),
]

# Regex extractions (P3) as (raw column, pattern, output).
REGEX_CODES = [
    ("battery", r"(\d{1,3})", "battery_pct"),
    ("device_system_version", r"^(\d+)", "os_ver_major"),
    ("screen_size", r"^(\d+)", "screen_w"),
    ("screen_size", r"x(\d+)$", "screen_h"),
]


def safe_int(c: Column | str, sentinel: int = FEATURE_SENTINEL, dtype: str = "int") -> Column:
    """Non-strict cast with a sentinel for null / unparsable."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.try_cast(dtype), F.lit(sentinel).cast(dtype))


def regex_int(c: Column | str, pattern: str, sentinel: int = FEATURE_SENTINEL) -> Column:
    """First group of ``pattern`` as int; no match -> sentinel."""
    c = F.col(c) if isinstance(c, str) else c
    return safe_int(F.regexp_extract(c, pattern, 1), sentinel)


def safe_ratio(num: Column, den: Column, cond: Column, default: float = 0.0) -> Column:
    """Guarded ratio (P15): ``num/den`` where ``cond`` holds, ``default`` otherwise.

    A null condition falls through to the default, as in the source.
    """
    return F.when(cond, num / den).otherwise(F.lit(default))


def device_fingerprint(w: Column, h: Column, os_: Column, lang: Column) -> Column:
    """P5: ``w*1e8 + h*1e5 + os*1e3 + (lang floor-mod 1000)`` as long (T4: pmod)."""
    return (w.cast("long") * 100_000_000 + h.cast("long") * 100_000
            + os_.cast("long") * 1000 + F.pmod(lang.cast("long"), F.lit(1000)))


def parse_timeline(raw: DataFrame) -> DataFrame:
    """Typed timeline from raw event columns.

    Output keys: ``customer_id``, ``event_id`` (long), ``event_ts`` (timestamp,
    second resolution, null when unparsable) and ``ets`` (epoch seconds).
    """
    cols = [
        F.col("customer_id").cast("long").alias("customer_id"),
        F.col("event_id").cast("long").alias("event_id"),
        F.col("period"),
        F.try_to_timestamp(F.col("event_dttm"), F.lit(TS_FORMAT)).alias("event_ts"),
        F.col("operaton_amt").try_cast("double").alias("amt"),
        safe_int("session_id", dtype="long").alias("session_id"),
    ]
    cols += [safe_int(src).alias(dst) for src, dst in INT_CODES]
    cols += [regex_int(src, pat).alias(dst) for src, pat, dst in REGEX_CODES]
    al, bl = F.col("accept_language"), F.col("browser_language")
    cols += [
        al.isNull().cast("int").alias("accept_language_missing"),
        F.when(al.isNotNull() & bl.isNotNull(), (al != bl).cast("int"))
         .otherwise(F.lit(-1)).alias("lang_mismatch"),
    ]
    extra = [c for c in raw.columns if c in ("target", "part_id")]
    df = raw.select(*cols, *extra)
    return df.withColumns({
        "ets": F.unix_seconds("event_ts"),
        "device_fp_i": device_fingerprint(F.col("screen_w"), F.col("screen_h"),
                                          F.col("operating_system_type"),
                                          F.col("accept_language_i")),
    })


def calendar_columns(ts: str = "event_ts") -> dict[str, Column]:
    """Calendar parts, flags and cyclic hour (weekday Mon=1..Sun=7)."""
    t = F.col(ts)
    hour = F.hour(t)
    wd = F.weekday(t) + 1
    two_pi = 2.0 * math.pi
    return {
        "hour": hour,
        "weekday": wd,
        "day": F.dayofmonth(t),
        "month": F.month(t),
        "day_of_year": F.dayofyear(t),
        "event_date": F.to_date(t),
        "event_day_number": F.floor(F.unix_seconds(t) / 86400).cast("int"),
        "is_weekend": (wd >= 5).cast("int"),
        "is_night": ((hour >= 22) | (hour < 6)).cast("int"),
        "is_night_early": (hour < 6).cast("int"),
        "hour_sin": F.sin(hour * (two_pi / 24.0)),
        "hour_cos": F.cos(hour * (two_pi / 24.0)),
    }


def amount_columns() -> dict[str, Column]:
    """Amount transforms, bucket, round-amount flag, screen geometry."""
    amt = F.col("amt")
    a = F.abs(amt)
    w, h = F.col("screen_w"), F.col("screen_h")
    return {
        "amt_log_abs": F.log1p(a),
        "amt_abs": a,
        "amt_is_negative": (amt < 0).cast("int"),
        "amt_bucket": F.least(F.greatest(F.floor(F.log1p(a) * 4.0), F.lit(0)), F.lit(63)).cast("int"),
        "is_round_amount": ((a % 1000 == 0) | (a % 500 == 0)).cast("int"),
        "screen_pixels": w * h,
        "screen_ratio": F.when((h > 0) & (w > 0), w.cast("double") / h).otherwise(F.lit(0.0)),
    }


def risk_flag_columns() -> dict[str, Column]:
    """Device risk-flag combinations."""
    voip = F.col("phone_voip_call_state") == 1
    rdp = F.col("web_rdp_connection") == 1
    comp = F.col("compromised_i") == 1
    dev = F.col("developer_tools_i") == 1
    return {
        "voip_rdp_combo": (voip & rdp).cast("int"),
        "any_risk_flag": (voip | rdp | comp | dev).cast("int"),
        "compromised_devtools": (comp & dev).cast("int"),
    }


NULL_DEVICE_COLS = [
    "phone_voip_call_state", "web_rdp_connection", "timezone",
    "operating_system_type", "developer_tools_i", "compromised_i",
    "battery_pct", "os_ver_major", "screen_w", "screen_h",
]


def null_pattern_columns() -> dict[str, Column]:
    """``null_{c}`` flags over sentinel-filled device columns + their sum."""
    out = {f"null_{c}": (F.col(c) == FEATURE_SENTINEL).cast("int") for c in NULL_DEVICE_COLS}
    total = None
    for c in NULL_DEVICE_COLS:
        e = (F.col(c) == FEATURE_SENTINEL).cast("int")
        total = e if total is None else total + e
    out["null_device_count"] = total
    return out


def enrich_rows(df: DataFrame) -> DataFrame:
    """Apply P6-P13 in one projection."""
    return df.withColumns({**calendar_columns(), **amount_columns(), **risk_flag_columns()})
