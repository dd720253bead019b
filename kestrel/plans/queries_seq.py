"""Registered sequence / embedding, split and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import sequences as Q
from kestrel.plans.catalog import register
from kestrel.plans.oracle import with_base
from kestrel.plans.queries_timeline import _i
from kestrel.sources.fixture import raw_events, read_table
from kestrel.sources.timeline import fixture_timeline

_FIELDS = Q.CAT_FIELDS + Q.NUM_FIELDS

SEQ_SRC = """
ss0 AS (SELECT *, try_strptime(event_dttm, '%Y-%m-%d %H:%M:%S') AS ts FROM raw
        WHERE period IN ('pretrain', 'train')),
ss AS (
  SELECT CAST(customer_id AS BIGINT) AS customer_id, CAST(event_id AS BIGINT) AS event_id,
    CAST(epoch(ts) AS BIGINT) AS ets,
    coalesce(TRY_CAST(event_type_nm AS INTEGER), 0) AS etype,
    coalesce(TRY_CAST(event_desc AS INTEGER), 0) AS edesc,
    coalesce(TRY_CAST(channel_indicator_type AS INTEGER), 0) AS ch_type,
    coalesce(TRY_CAST(channel_indicator_sub_type AS INTEGER), 0) AS ch_sub,
    coalesce(TRY_CAST(mcc_code AS INTEGER), 0) AS mcc,
    coalesce(TRY_CAST(pos_cd AS INTEGER), 0) AS pos,
    coalesce(TRY_CAST(timezone AS INTEGER), 0) AS tz,
    coalesce(TRY_CAST(operating_system_type AS INTEGER), 0) AS os,
    coalesce(TRY_CAST(phone_voip_call_state AS INTEGER), 0) AS voip,
    coalesce(TRY_CAST(web_rdp_connection AS INTEGER), 0) AS rdp,
    coalesce(hour(ts), 0) AS hour, coalesce(isodow(ts), 0) AS dow,
    ln(1 + abs(coalesce(TRY_CAST(operaton_amt AS DOUBLE), 0))) AS amt_log
  FROM ss0),
rk AS (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY ets DESC NULLS LAST, event_id DESC) AS r,
         count(*) OVER (PARTITION BY customer_id) AS total_events
  FROM ss),
sq AS (
  SELECT customer_id, any_value(total_events) AS total_events, """ + ", ".join(
    f"list({f} ORDER BY ets, event_id) AS {f}_seq" for f in Q.CAT_FIELDS) + """,
    list(CAST(round(amt_log * 1000000) AS BIGINT) ORDER BY ets, event_id) AS amt_log_seq
  FROM rk WHERE r <= 500 GROUP BY customer_id)"""


def _seq_strings(df, fields, suffix="_seq"):
    return [F.array_join(F.transform(f"{f}{suffix}", lambda x: x.cast("string")), ",")
            .alias(f"{f}{suffix}") for f in fields]


def _spark_seqs(spark, sf_dir):
    src = Q.sequence_source(raw_events(spark, sf_dir))
    seqs = Q.last_n_sequences(src)
    return seqs.withColumn("amt_log_seq", F.transform(
        "amt_log_seq", lambda x: F.round(x * 1e6, 0).cast("long")))


SEQUENCES_SQL = with_base(
    "SELECT customer_id, " + _i("total_events", "total_events") + ", "
    + _i("len(etype_seq)", "seq_len") + ", "
    + ", ".join(f"array_to_string({f}_seq, ',') AS {f}_seq" for f in _FIELDS) + " FROM sq", SEQ_SRC)


@register("sequences", SEQUENCES_SQL)
def q_sequences(spark, sf_dir):
    """Q1: last-500 event sequences per customer (13 parallel lists + total)."""
    seqs = _spark_seqs(spark, sf_dir)
    return seqs.select("customer_id", "total_events", F.size("etype_seq").alias("seq_len"),
                       *_seq_strings(seqs, _FIELDS))


@register("sequences_last20", SEQUENCES_SQL.replace("r <= 500", "r <= 20"))
def q_sequences_last20(spark, sf_dir):
    """Q1 with a limit that the customers of the fixture exceed."""
    seqs = Q.last_n_sequences(Q.sequence_source(raw_events(spark, sf_dir)), 20).withColumn(
        "amt_log_seq", F.transform("amt_log_seq", lambda x: F.round(x * 1e6, 0).cast("long")))
    return seqs.select("customer_id", "total_events", F.size("etype_seq").alias("seq_len"),
                       *_seq_strings(seqs, _FIELDS))


def _h(view: int) -> str:
    return f"customer_id * 7919 + {view * 104729 + Q.SEED}"


SUBSEQ_SQL = with_base("""
SELECT customer_id, """ + ", ".join([
    _i("floor(customer_id / 64)", "batch_id"), _i("len(e1)", "len_v1"), _i("len(m2)", "len_v2"),
    "array_to_string(e1, ',') AS etype_v1", "array_to_string(m2, ',') AS mcc_v2",
    _i("max(len(e1)) OVER (PARTITION BY floor(customer_id / 64))", "pad_len"),
    _i("len(e1)", "mask_sum")]) + """
FROM (SELECT customer_id,
        et[st1 + 1 : st1 + 64] AS e1, mc[st2 + 1 : st2 + 64] AS m2
      FROM (SELECT customer_id,
              list_transform(etype_seq, lambda x: least(greatest(x + 1, 0), 19)) AS et,
              list_transform(mcc_seq, lambda x: least(greatest(x + 1, 0), 24)) AS mc,
              CASE WHEN len(etype_seq) > 64 THEN ((""" + _h(1) + """) % (len(etype_seq) - 64)
                   + (len(etype_seq) - 64)) % (len(etype_seq) - 64) ELSE 0 END AS st1,
              CASE WHEN len(etype_seq) > 64 THEN ((""" + _h(2) + """) % (len(etype_seq) - 64)
                   + (len(etype_seq) - 64)) % (len(etype_seq) - 64) ELSE 0 END AS st2
            FROM sq))
""", SEQ_SRC)


@register("subsequences", SUBSEQ_SQL)
def q_subsequences(spark, sf_dir):
    """Q2-Q4: shift+clip codes, two deterministic 64-long views, batch padding + mask."""
    seqs = Q.shift_clip(_spark_seqs(spark, sf_dir))
    v = Q.subsequence_pairs(seqs, ["etype", "mcc"])
    v = Q.pad_batch(v, "etype_v1", "len_v1")
    return v.select("customer_id", "batch_id", "len_v1", "len_v2",
                    F.array_join(F.transform("etype_v1", lambda x: x.cast("string")), ",").alias("etype_v1"),
                    F.array_join(F.transform("mcc_v2", lambda x: x.cast("string")), ",").alias("mcc_v2"),
                    F.size("etype_v1_padded").alias("pad_len"),
                    F.aggregate("etype_v1_mask", F.lit(0), lambda a, x: a + x).alias("mask_sum"))


EPOCH_VIEWS_SQL = with_base("SELECT customer_id, " + ", ".join([
    _i("epoch", "epoch"), _i("view", "view"), _i("st", "start"), "array_to_string(mcc_seq[st + 1 : st + 16], ',') AS mcc"]) + f"""
FROM (SELECT customer_id, mcc_seq, epoch, view, CASE WHEN len(mcc_seq) > 16 THEN
        CAST('0x' || substr(md5('{Q.SEED}:' || epoch || ':' || customer_id || ':' || view), 1, 8) AS BIGINT) % (len(mcc_seq) - 16)
        ELSE 0 END AS st
      FROM sq, (SELECT unnest(range(0, 3)) AS epoch), (SELECT unnest(range(1, 3)) AS view))
""", SEQ_SRC)


@register("epoch_views", EPOCH_VIEWS_SQL)
def q_epoch_views(spark, sf_dir):
    """Q3 by a counter-based generator: two random 16-long slices per customer in each of three passes."""
    v = Q.epoch_views(_spark_seqs(spark, sf_dir), epochs=3, fields=["mcc"], sub_len=16)
    return v.select("customer_id", "epoch", "view", "start",
                    F.array_join(F.transform("mcc_seq", lambda x: x.cast("string")), ",").alias("mcc"))


_views_at = SUBSEQ_SQL.rindex("\nFROM (SELECT customer_id,\n        et[")
_views_from = SUBSEQ_SQL.rindex("SELECT customer_id, ", 0, _views_at)
PADDING_SQL = (SUBSEQ_SQL[:_views_from] + """
SELECT customer_id,
  array_to_string(list_concat(e1, list_transform(range(0, n - len(e1)), lambda i: 0)), ',') AS padded,
  array_to_string(list_concat(list_transform(e1, lambda x: 1), list_transform(range(0, n - len(e1)), lambda i: 0)), ',') AS mask
FROM (SELECT *, max(len(e1)) OVER (PARTITION BY floor(customer_id / 64)) AS n """ + SUBSEQ_SQL[_views_at:] + ")")


@register("padding", PADDING_SQL)
def q_padding(spark, sf_dir):
    """Q4: contents of the padded lists and masks."""
    v = Q.subsequence_pairs(Q.shift_clip(_spark_seqs(spark, sf_dir)), ["etype", "mcc"])
    v = Q.pad_batch(v, "etype_v1", "len_v1")
    return v.select("customer_id", *[F.array_join(F.transform(f"etype_v1_{c}", lambda x: x.cast("string")), ",").alias(c)
                                     for c in ("padded", "mask")])


# Q6 ---------------------------------------------------------------------------
POOL_SQL = """
SELECT CAST(label AS BIGINT) AS label, CAST(dim AS BIGINT) AS dim,
  (round(CAST(coalesce(sum(x), 0) / greatest(count(x), 1) AS DOUBLE) * 1000000) / 1000000 + 0.0) AS mean
FROM (SELECT label, generate_subscripts(embedding, 1) - 1 AS dim, unnest(embedding) AS x FROM embeddings)
GROUP BY label, dim
"""


@register("pooling", POOL_SQL)
def q_pooling(spark, sf_dir):
    """Q6: masked mean pooling of embedding vectors per label."""
    emb = read_table(spark, sf_dir, "embeddings")
    return Q.masked_mean_pool(emb, "label", "embedding")


POOL_MASK_SQL = """
WITH x AS (SELECT label, vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings),
m AS (SELECT *, CAST((dim + vec_id) % 3 <> 0 AS DOUBLE) AS m FROM x)
SELECT CAST(label AS BIGINT) AS label, CAST(dim AS BIGINT) AS dim,
  (round(CAST(sum(m * CAST(x AS DOUBLE)) / greatest(sum(m), 1) AS DOUBLE) * 1000000) / 1000000 + 0.0) AS mean
FROM m GROUP BY label, dim
"""


@register("pooling_masked", POOL_MASK_SQL)
def q_pooling_masked(spark, sf_dir):
    """Q6 with an array mask: one weight per vector and dimension."""
    emb = read_table(spark, sf_dir, "embeddings")
    emb = emb.withColumn("keep", F.transform("embedding", lambda x, i: (F.pmod(i + F.col("vec_id"), F.lit(3)) != 0)
                                             .cast("int")))
    return Q.masked_mean_pool(emb, "label", "embedding", "keep")


# Q7 ---------------------------------------------------------------------------
NTXENT_SQL = """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v, floor(vec_id / 128) AS batch_id
           FROM embeddings),
pr AS (SELECT * FROM (SELECT batch_id, vec_id AS aid, v AS a,
         lead(vec_id) OVER (PARTITION BY batch_id, label ORDER BY vec_id) AS pid,
         lead(v) OVER (PARTITION BY batch_id, label ORDER BY vec_id) AS p FROM e) WHERE pid IS NOT NULL),
vw AS (SELECT batch_id, aid, 0 AS side, list_transform(a, lambda x: x / sqrt(list_sum(list_transform(a, lambda y: y * y)))) AS z FROM pr
       UNION ALL
       SELECT batch_id, aid, 1 AS side, list_transform(p, lambda x: x / sqrt(list_sum(list_transform(p, lambda y: y * y)))) AS z FROM pr),
sm AS (SELECT l.batch_id, l.aid, l.side, l.aid = r.aid AS is_pos, list_dot_product(l.z, r.z) / 0.07 AS s
       FROM vw l JOIN vw r ON l.batch_id = r.batch_id AND NOT (l.aid = r.aid AND l.side = r.side)),
per AS (SELECT batch_id, aid, side, max(s) AS m, max(s) FILTER (WHERE is_pos) AS sp FROM sm GROUP BY 1, 2, 3),
lse AS (SELECT sm.batch_id, sm.aid, sm.side, any_value(per.m) + ln(sum(exp(sm.s - per.m))) - any_value(per.sp) AS l
        FROM sm JOIN per USING (batch_id, aid, side) GROUP BY 1, 2, 3)
SELECT CAST(batch_id AS BIGINT) AS batch_id, CAST(count(*) AS BIGINT) AS n_views,
  (round(CAST(avg(l) AS DOUBLE) * 1000000) / 1000000 + 0.0) AS loss
FROM lse GROUP BY batch_id
"""


@register("ntxent", NTXENT_SQL)
def q_ntxent(spark, sf_dir):
    """Q7: NT-Xent contrastive loss per bounded batch of embedding pairs."""
    emb = read_table(spark, sf_dir, "embeddings")
    return Q.nt_xent(Q.contrastive_pairs(emb))


# L4 ---------------------------------------------------------------------------
VAL_SQL = with_base("SELECT event_id, " + ", ".join([
    _i("inw AND day_n = vd", "is_val"), _i("event_ts < TIMESTAMP '2024-01-19 00:00:00'", "in_train_part")])
    + " FROM sm LEFT JOIN pick USING (customer_id)", """
sm AS (SELECT *, floor(ets / 86400) AS day_n,
         event_ts >= TIMESTAMP '2024-01-19 00:00:00' AND event_ts < TIMESTAMP '2024-01-24 00:00:00' AS inw
       FROM t WHERE period = 'train' AND (train_target_raw <> -1 OR (
         (event_ts >= TIMESTAMP '2024-01-17 00:00:00' AND (event_id * 1000003 + customer_id * 7919 + 42) % 5 = 0)
         OR (event_ts < TIMESTAMP '2024-01-17 00:00:00' AND (event_id * 1000003 + customer_id * 7919 + 59) % 15 = 0)))),
pick AS (SELECT customer_id, arg_min(day_n, struct_pack(h := (customer_id * 7919 + day_n * 104729 + 42) % 2147483647, d := day_n)) AS vd
         FROM (SELECT DISTINCT customer_id, day_n FROM sm WHERE inw) GROUP BY customer_id)""")


@register("val_split", VAL_SQL)
def q_val_split(spark, sf_dir):
    """L3-L4 (+A9): random active validation day per customer inside the window."""
    from kestrel.operators.sampling import random_day_validation
    tl = fixture_timeline(spark, sf_dir).filter(F.col("is_train_sample"))
    return random_day_validation(tl.withColumn("event_day_number",
                                               F.floor(F.col("ets") / 86400))).select(
        "event_id", "is_val", "in_train_part")


REFIT_SQL = with_base("SELECT CAST(event_id AS BIGINT) AS event_id FROM sm WHERE train_target_raw <> -1 OR event_id % 3 = 0", """
sm AS (SELECT * FROM t WHERE period = 'train' AND (train_target_raw <> -1 OR (
         (event_ts >= TIMESTAMP '2024-01-17 00:00:00' AND (event_id * 1000003 + customer_id * 7919 + 42) % 5 = 0)
         OR (event_ts < TIMESTAMP '2024-01-17 00:00:00' AND (event_id * 1000003 + customer_id * 7919 + 59) % 15 = 0))))""")


@register("refit_sample", REFIT_SQL)
def q_refit_sample(spark, sf_dir):
    """L2: the second-stage sample of the refit."""
    from kestrel.operators.sampling import refit_sample
    return refit_sample(fixture_timeline(spark, sf_dir, by_customer=False)).select("event_id")


# S3, J1, U1, U3 ---------------------------------------------------------------
DEDUP_SQL = with_base("""
SELECT CAST(event_id AS BIGINT) AS event_id, period, CAST(customer_id AS BIGINT) AS customer_id FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY
    CASE period WHEN 'test' THEN 0 WHEN 'train' THEN 1 WHEN 'pretest' THEN 2 ELSE 3 END, customer_id) AS rn
  FROM (SELECT event_id, customer_id, period FROM raw WHERE period IN ('pretrain', 'train')
        UNION ALL
        SELECT event_id, customer_id, period FROM raw
          WHERE period IN ('pretest', 'test') AND customer_id IN (SELECT customer_id FROM raw WHERE period = 'pretrain')
        UNION ALL
        SELECT event_id, customer_id, 'pretest' FROM raw
          WHERE period = 'test' AND customer_id IN (SELECT customer_id FROM raw WHERE period = 'pretrain')))
WHERE rn = 1""")


@register("dedup", DEDUP_SQL)
def q_dedup(spark, sf_dir):
    """Period union with duplicated test ids in pretest, semi join to
    the part's customers, deterministic dedup (test wins)."""
    from kestrel.sources.timeline import dedup_by_event
    from kestrel.sources.union import period_union
    raw = raw_events(spark, sf_dir)
    frames = {p: raw.filter(F.col("period") == p).drop("period") for p in
              ("pretrain", "train", "pretest", "test")}
    frames["pretest"] = frames["pretest"].unionByName(frames["test"])  # ids also in test (T1)
    u = period_union(frames["pretrain"], frames["train"], frames["pretest"], frames["test"])
    return dedup_by_event(u).select("event_id", "period", "customer_id")


# U2, U4 -----------------------------------------------------------------------
SETS_SQL = with_base("SELECT metric, CAST(n AS BIGINT) AS n FROM (" + " UNION ALL ".join([
    "SELECT 'test_customers' AS metric, count(DISTINCT customer_id) AS n FROM raw WHERE period = 'test'",
    "SELECT 'test_and_train', count(*) FROM (SELECT customer_id FROM raw WHERE period = 'test' "
    "INTERSECT SELECT customer_id FROM raw WHERE period = 'train')",
    "SELECT 'test_not_pretest', count(*) FROM (SELECT customer_id FROM raw WHERE period = 'test' "
    "EXCEPT SELECT customer_id FROM raw WHERE period = 'pretest')",
    "SELECT 'labelled_customers', count(DISTINCT customer_id) FROM lab"]) + ")")


@register("customer_sets", SETS_SQL)
def q_customer_sets(spark, sf_dir):
    """Distinct customers, intersect and difference of period customer sets."""
    raw = raw_events(spark, sf_dir)
    cust = {p: raw.filter(F.col("period") == p).select("customer_id") for p in ("train", "pretest", "test")}
    lab = raw.filter(F.col("target").isNotNull()).select("customer_id")

    def n(df, name):
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("metric"), "n")

    parts = [n(cust["test"].distinct(), "test_customers"),
             n(cust["test"].intersect(cust["train"]), "test_and_train"),
             n(cust["test"].subtract(cust["pretest"]), "test_not_pretest"),
             n(lab.distinct(), "labelled_customers")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


