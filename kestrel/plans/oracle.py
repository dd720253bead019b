"""Independent SQL oracles (DuckDB dialect) for the registered queries.

Each oracle is written from the operator's definition, not from the Spark
code: rolling windows are self-joins, prefix counts are correlated counts or
plain SQL windows, ranks are counts of smaller values.  The common prefix is
the raw fixture (``RAW_SQL``, valid in both engines), the parsed timeline
``t`` and the label table ``lab``.  Output rule (same as
``kestrel.functions.output.normalize``): integers ``BIGINT``, fractions
``round(x, 6) + 0.0``.
"""

from __future__ import annotations

from kestrel.sources.fixture import RAW_SQL

PARSED_SQL = r"""
t0 AS (
  SELECT CAST(customer_id AS BIGINT) AS customer_id,
         CAST(event_id AS BIGINT) AS event_id,
         period,
         try_strptime(event_dttm, '%Y-%m-%d %H:%M:%S') AS event_ts,
         TRY_CAST(operaton_amt AS DOUBLE) AS amt,
         coalesce(TRY_CAST(session_id AS BIGINT), -1) AS session_id,
         coalesce(TRY_CAST(event_type_nm AS INTEGER), -1) AS event_type_nm,
         coalesce(TRY_CAST(event_desc AS INTEGER), -1) AS event_desc,
         coalesce(TRY_CAST(channel_indicator_type AS INTEGER), -1) AS channel_indicator_type,
         coalesce(TRY_CAST(channel_indicator_sub_type AS INTEGER), -1) AS channel_indicator_sub_type,
         coalesce(TRY_CAST(currency_iso_cd AS INTEGER), -1) AS currency_iso_cd,
         coalesce(TRY_CAST(pos_cd AS INTEGER), -1) AS pos_cd,
         coalesce(TRY_CAST(timezone AS INTEGER), -1) AS timezone,
         coalesce(TRY_CAST(operating_system_type AS INTEGER), -1) AS operating_system_type,
         coalesce(TRY_CAST(phone_voip_call_state AS INTEGER), -1) AS phone_voip_call_state,
         coalesce(TRY_CAST(web_rdp_connection AS INTEGER), -1) AS web_rdp_connection,
         coalesce(TRY_CAST(mcc_code AS INTEGER), -1) AS mcc_code_i,
         coalesce(TRY_CAST(developer_tools AS INTEGER), -1) AS developer_tools_i,
         coalesce(TRY_CAST(compromised AS INTEGER), -1) AS compromised_i,
         coalesce(TRY_CAST(accept_language AS INTEGER), -1) AS accept_language_i,
         coalesce(TRY_CAST(browser_language AS INTEGER), -1) AS browser_language_i,
         coalesce(TRY_CAST(NULLIF(regexp_extract(battery, '(\d{1,3})', 1), '') AS INTEGER), -1) AS battery_pct,
         coalesce(TRY_CAST(NULLIF(regexp_extract(device_system_version, '^(\d+)', 1), '') AS INTEGER), -1) AS os_ver_major,
         coalesce(TRY_CAST(NULLIF(regexp_extract(screen_size, '^(\d+)', 1), '') AS INTEGER), -1) AS screen_w,
         coalesce(TRY_CAST(NULLIF(regexp_extract(screen_size, 'x(\d+)$', 1), '') AS INTEGER), -1) AS screen_h,
         CAST(accept_language IS NULL AS INTEGER) AS accept_language_missing,
         CASE WHEN accept_language IS NOT NULL AND browser_language IS NOT NULL
              THEN CAST(accept_language <> browser_language AS INTEGER) ELSE -1 END AS lang_mismatch
  FROM raw),
lab AS (SELECT event_id, customer_id, CAST(target AS INTEGER) AS target FROM raw WHERE target IS NOT NULL),
t AS (
  SELECT t0.*,
         CAST(epoch(event_ts) AS BIGINT) AS ets,
         CAST(screen_w AS BIGINT) * 100000000 + CAST(screen_h AS BIGINT) * 100000
           + CAST(operating_system_type AS BIGINT) * 1000
           + (((CAST(accept_language_i AS BIGINT) % 1000) + 1000) % 1000) AS device_fp_i,
         lab.target,
         abs(amt) AS amt_abs,
         CAST(hour(event_ts) AS INTEGER) AS hour,
         CAST(CAST(event_ts AS DATE) AS DATE) AS event_date,
         CASE WHEN period = 'train' THEN coalesce(lab.target, -1) END AS train_target_raw
  FROM t0 LEFT JOIN lab USING (customer_id, event_id))
"""


def with_base(body: str, extra_ctes: str = "") -> str:
    """Prefix ``body`` with the raw fixture, parsed timeline and any extra CTEs."""
    raw = RAW_SQL.strip()
    assert raw.startswith("WITH b AS (")
    # Turn the fixture's own WITH into a named CTE ``raw``.
    raw_cte = "WITH b AS (" + raw[len("WITH b AS ("):]
    head, _, sel = raw_cte.partition("\nSELECT\n")
    ctes = head + ",\nraw AS (\nSELECT\n" + sel + "\n),\n" + PARSED_SQL.strip()
    if extra_ctes.strip():
        ctes += ",\n" + extra_ctes.strip()
    return ctes + "\n" + body.strip()


def r6(expr: str) -> str:
    """Oracle side of the rounding rule in ``kestrel.functions.output``."""
    return f"(round(CAST({expr} AS DOUBLE) * 1000000) / 1000000 + 0.0)"


#: The fixture's variants as replacements of raw columns (see ``kestrel.sources.fixture.vary``).
VARIANTS = {
    "dense": "SELECT * REPLACE (CAST(floor(customer_id / 10.0) AS BIGINT) AS customer_id) FROM raw0",
    "hot": "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 1 ELSE customer_id END AS customer_id) FROM raw0",
    "bad": "SELECT * REPLACE (CASE WHEN event_id % 7 = 0 THEN 'bad' ELSE event_dttm END AS event_dttm) FROM raw0",
    "dup": "SELECT * FROM raw0 UNION ALL SELECT * REPLACE ('pretest' AS period) FROM raw0 WHERE period = 'test'",
}


def on_variant(sql: str, variant: str) -> str:
    """An oracle over a variant of the fixture; rows without a time come first, as in Spark."""
    head, _, rest = sql.partition("\nraw AS (\nSELECT\n")
    body, _, tail = rest.partition("\nFROM b\n),\n")
    out = f"{head}\nraw0 AS (\nSELECT\n{body}\nFROM b\n),\nraw AS ({VARIANTS[variant]}),\n{tail}"
    return out.replace("ORDER BY event_ts,", "ORDER BY event_ts NULLS FIRST,")
