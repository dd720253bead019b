"""Registered scoring queries.

Scored rows: the sampled training rows of the timeline (``is_train_sample``)
with deterministic scores that have ties:
``s_a = ((event_id * 37) % 101) / 101``, ``s_b = ((event_id * 31) % 97) / 97``,
``s_fb = (event_desc * 5 + pmod(mcc_code_i, 13)) / 100`` and the product score
``s_prod = logit(sigmoid(s_a) * sigmoid(s_b))`` (M5).  ``y`` = RED.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import scoring as S
from kestrel.plans.catalog import register
from kestrel.plans.oracle import with_base
from kestrel.plans.queries_timeline import _d, _i
from kestrel.sources.sinks import stage
from kestrel.sources.timeline import fixture_timeline

_SMP = ("period = 'train' AND (train_target_raw <> -1 OR ("
        "(event_ts >= TIMESTAMP '2024-01-17 00:00:00' AND (event_id * 1000003 + customer_id * 7919 + 42) % 5 = 0)"
        " OR (event_ts < TIMESTAMP '2024-01-17 00:00:00' AND (event_id * 1000003 + customer_id * 7919 + 59) % 15 = 0)))")

SCORED_CTE = f"""
sc0 AS (
  SELECT event_id, customer_id, period, train_target_raw,
    CAST(train_target_raw = 1 AS INTEGER) AS y,
    ((event_id * 37) % 101) / 101.0 AS s_a,
    ((event_id * 31) % 97) / 97.0 AS s_b,
    (event_desc * 5 + (((mcc_code_i % 13) + 13) % 13)) / 100.0 AS s_fb
  FROM t WHERE {_SMP}),
sc AS (
  SELECT *, ln(least(greatest(pg, 1e-8), 1 - 1e-8) / (1 - least(greatest(pg, 1e-8), 1 - 1e-8))) AS s_prod
  FROM (SELECT *, (1 / (1 + exp(-least(greatest(s_a, -40), 40))))
                  * (1 / (1 + exp(-least(greatest(s_b, -40), 40)))) AS pg FROM sc0))"""


def scored(spark, sf_dir):
    tl = fixture_timeline(spark, sf_dir, by_customer=False).filter(F.col("is_train_sample"))
    df = tl.select(
        "event_id", "customer_id", "period", "train_target_raw",
        (F.col("train_target_raw") == 1).cast("int").alias("y"),
        ((F.col("event_id") * 37) % 101 / 101.0).alias("s_a"),
        ((F.col("event_id") * 31) % 97 / 97.0).alias("s_b"),
        ((F.col("event_desc") * 5 + F.pmod("mcc_code_i", F.lit(13))) / 100.0).alias("s_fb"))
    # ranks and searches read the scored rows several times: computed once
    return stage(df.withColumn("s_prod", S.product_score(F.col("s_a"), F.col("s_b"))), "scored")


def _ap_sql(score_expr_by_name: dict[str, str], source: str = "sc") -> str:
    parts = [f"SELECT '{n}' AS score_name, {e} AS s, y FROM {source}"
             for n, e in score_expr_by_name.items()]
    return f"""
lg AS ({' UNION ALL '.join(parts)}),
dg AS (SELECT score_name, s, sum(y) AS pos, count(*) AS n FROM lg GROUP BY score_name, s),
cg AS (SELECT *, sum(pos) OVER (PARTITION BY score_name ORDER BY s DESC) AS tp,
              sum(n) OVER (PARTITION BY score_name ORDER BY s DESC) AS nn FROM dg),
apg AS (SELECT score_name, sum(pos * tp / nn) / sum(pos) AS ap FROM cg GROUP BY score_name)"""


# --------------------------------------------------------------------------
# ap: M7 (+M5 product score)

AP_SQL = with_base("SELECT score_name, " + _d("ap", "ap") + " FROM apg",
                   SCORED_CTE + "," + _ap_sql({"s_a": "s_a", "s_b": "s_b", "s_fb": "s_fb",
                                               "s_prod": "s_prod"}))


@register("ap", AP_SQL)
def q_ap(spark, sf_dir):
    """M7: average precision (ties grouped) of four scores, via range-bucketed scans."""
    df = scored(spark, sf_dir)
    long = df.select("y", F.explode(F.array(*[
        F.struct(F.lit(n).alias("score_name"), F.col(n).alias("s"))
        for n in ("s_a", "s_b", "s_fb", "s_prod")])).alias("x")).select("y", "x.*")
    return S.average_precision(long, "s", "y", ["score_name"])


# --------------------------------------------------------------------------
# rank: M9

RANK_SQL = with_base("SELECT event_id, " + ", ".join([
    _d("(rank() OVER (ORDER BY s_a) - 1 + (count(*) OVER (PARTITION BY s_a) + 1) / 2.0) "
       "/ count(*) OVER ()", "r_a"),
    _d("(rank() OVER (ORDER BY s_fb) - 1 + (count(*) OVER (PARTITION BY s_fb) + 1) / 2.0) "
       "/ count(*) OVER ()", "r_fb")]) + " FROM sc", SCORED_CTE)


@register("rank", RANK_SQL)
def q_rank(spark, sf_dir):
    """M9: average-tie rank / n without a single-partition window."""
    df = scored(spark, sf_dir)
    df = S.average_rank(df, "s_a", "r_a")
    df = S.average_rank(df, "s_fb", "r_fb")
    return df.select("event_id", "r_a", "r_fb")


# --------------------------------------------------------------------------
# blend_coarse / blend_best: M6, M8

_COARSE_CTE = """
cand AS (
  SELECT m.i * 5000 + r.i * 5 AS cand, CAST(m.i * 5 AS DOUBLE) / 100 AS wm, CAST(r.i * 5 AS DOUBLE) / 100 AS wr,
         CAST(100 - m.i * 5 - r.i * 5 AS DOUBLE) / 100 AS wp
  FROM range(0, 19) m(i) CROSS JOIN range(0, 13) r(i) WHERE m.i * 5 + r.i * 5 <= 100),
bl AS (SELECT c.cand, c.wm * s.s_a + c.wr * s.s_b + c.wp * s.s_prod AS s, s.y FROM cand c CROSS JOIN sc s),
bd AS (SELECT cand, s, sum(y) AS pos, count(*) AS n FROM bl GROUP BY cand, s),
bc AS (SELECT *, sum(pos) OVER (PARTITION BY cand ORDER BY s DESC) AS tp,
              sum(n) OVER (PARTITION BY cand ORDER BY s DESC) AS nn FROM bd),
bap AS (SELECT cand, sum(pos * tp / nn) / sum(pos) AS ap FROM bc GROUP BY cand)"""

BLEND_COARSE_SQL = with_base(
    "SELECT " + ", ".join([_i("cand", "cand"), _d("wm", "wm"), _d("wr", "wr"), _d("wp", "wp"),
                           _d("ap", "ap")]) + " FROM cand JOIN bap USING (cand)",
    SCORED_CTE + "," + _COARSE_CTE)


@register("blend_coarse", BLEND_COARSE_SQL)
def q_blend_coarse(spark, sf_dir):
    """M8 stage 1: AP of all coarse blend candidates in one job."""
    grid = S.weight_grid(spark, S.COARSE["main"], S.COARSE["recent"])
    ap = S.candidate_ap(scored(spark, sf_dir), "y", ["s_a", "s_b", "s_prod"], grid)
    return ap.join(grid.toDF("cand", "wm", "wr", "wp"), "cand")


BLEND_BEST_SQL = with_base("""
SELECT """ + ", ".join([_d("wm", "wm"), _d("wr", "wr"), _d("wp", "wp"), _d("ap", "ap")]) + """
FROM (
  SELECT * FROM (
    SELECT 0 AS stage, cand, wm, wr, wp, ap FROM cb
    UNION ALL
    SELECT 1 AS stage, cand, round(wm, 4), round(wr, 4), round(wp, 4), ap FROM fap
      WHERE round(ap, 12) > (SELECT round(ap, 12) FROM cb))
  ORDER BY stage DESC, round(ap, 12) DESC, cand LIMIT 1)
""", SCORED_CTE + "," + _COARSE_CTE + """,
cb AS (SELECT c.cand, c.wm, c.wr, c.wp, b.ap FROM cand c JOIN bap b USING (cand)
       ORDER BY round(b.ap, 12) DESC, c.cand LIMIT 1),
fc AS (SELECT m.i * 1000 + r.i AS cand, CAST(m.i AS DOUBLE) / 100 AS wm, CAST(r.i AS DOUBLE) / 100 AS wr,
              CAST(100 - m.i - r.i AS DOUBLE) / 100 AS wp
       FROM cb, range(0, 101) m(i) CROSS JOIN range(0, 101) r(i)
       WHERE abs(m.i - round(cb.wm * 100)) <= 8 AND abs(r.i - round(cb.wr * 100)) <= 8 AND m.i + r.i <= 100),
fbl AS (SELECT c.cand, c.wm * s.s_a + c.wr * s.s_b + c.wp * s.s_prod AS s, s.y FROM fc c CROSS JOIN sc s),
fbd AS (SELECT cand, s, sum(y) AS pos, count(*) AS n FROM fbl GROUP BY cand, s),
fbc AS (SELECT *, sum(pos) OVER (PARTITION BY cand ORDER BY s DESC) AS tp,
               sum(n) OVER (PARTITION BY cand ORDER BY s DESC) AS nn FROM fbd),
fap AS (SELECT c.cand, c.wm, c.wr, c.wp, sum(pos * tp / nn) / sum(pos) AS ap
        FROM fbc JOIN fc c USING (cand) GROUP BY c.cand, c.wm, c.wr, c.wp
        ORDER BY round(ap, 12) DESC, c.cand LIMIT 1)
""")


@register("blend_best", BLEND_BEST_SQL)
def q_blend_best(spark, sf_dir):
    """M8: two-stage (coarse 0.05, fine 0.01) blend-weight search; strict > keeps the first."""
    df = scored(spark, sf_dir)
    w, ap = S.search_blend(df, "y", ["s_a", "s_b", "s_prod"])
    return spark.createDataFrame([(float(w[0]), float(w[1]), float(w[2]), float(ap))],
                                 "wm double, wr double, wp double, ap double")


# --------------------------------------------------------------------------
# alpha_search: M9, M10, M11, J9

_ALPHA_CTE = """
rk AS (
  SELECT *,
    (rank() OVER (ORDER BY cb) - 1 + (count(*) OVER (PARTITION BY cb) + 1) / 2.0) / count(*) OVER () AS r_cb,
    (rank() OVER (ORDER BY s_fb) - 1 + (count(*) OVER (PARTITION BY s_fb) + 1) / 2.0) / count(*) OVER () AS r_fb,
    customer_id IN (SELECT customer_id FROM sc WHERE train_target_raw <> -1) AS hist
  FROM (SELECT *, 0.35 * s_a + 0.0 * s_b + 0.65 * s_prod AS cb FROM sc)),
al AS (SELECT i AS cand, CAST(i * 5 AS DOUBLE) / 100 AS alpha FROM range(0, 11) r(i)),
ab AS (SELECT a.cand, a.alpha, CASE WHEN hist THEN (1 - a.alpha) * r_cb + a.alpha * r_fb ELSE r_cb END AS s, y
       FROM al a CROSS JOIN rk),
ad AS (SELECT cand, alpha, s, sum(y) AS pos, count(*) AS n FROM ab GROUP BY cand, alpha, s),
ac AS (SELECT *, sum(pos) OVER (PARTITION BY cand ORDER BY s DESC) AS tp,
              sum(n) OVER (PARTITION BY cand ORDER BY s DESC) AS nn FROM ad)"""

ALPHA_SQL = with_base("SELECT " + ", ".join([_i("cand", "cand"), _d("alpha", "alpha"),
                                              _d("sum(pos * tp / nn) / sum(pos)", "ap")])
                      + " FROM ac GROUP BY cand, alpha", SCORED_CTE + "," + _ALPHA_CTE)


def _ranked(spark, sf_dir):
    df = scored(spark, sf_dir)
    df = df.withColumn("cb", S.linear_blend([0.35, 0.0, 0.65],
                                            [F.col("s_a"), F.col("s_b"), F.col("s_prod")]))
    df = S.average_rank(df, "cb", "r_cb")
    df = S.average_rank(df, "s_fb", "r_fb")
    return S.history_flag(df, df.filter(F.col("train_target_raw") != -1), "hist")


@register("alpha_search", ALPHA_SQL)
def q_alpha_search(spark, sf_dir):
    """AP of the conditional rank injection for alpha in 0..0.5 step 0.05."""
    df = _ranked(spark, sf_dir)
    return S.alpha_ap(df, "y", "r_cb", "r_fb", "hist")


# --------------------------------------------------------------------------
# alpha_sweep: M12 + S5 / J8 (template join with completeness check)

SWEEP_SQL = with_base("""
SELECT tp.event_id, """ + _d("a.alpha", "alpha") + ", " + _d(
    "CASE WHEN hist THEN (1 - a.alpha) * r_cb + a.alpha * r_fb ELSE r_cb END", "predict") + """
FROM (SELECT DISTINCT event_id FROM t WHERE period = 'test') tp
CROSS JOIN (SELECT unnest([0.3, 0.5, 0.7]) AS alpha) a
LEFT JOIN tr USING (event_id)
""", """
te AS (
  SELECT event_id, customer_id,
    ((event_id * 37) % 101) / 101.0 AS cb,
    (event_desc * 5 + (((mcc_code_i % 13) + 13) % 13)) / 100.0 AS fb
  FROM t WHERE period = 'test'),
tr AS (
  SELECT event_id,
    (rank() OVER (ORDER BY cb) - 1 + (count(*) OVER (PARTITION BY cb) + 1) / 2.0) / count(*) OVER () AS r_cb,
    (rank() OVER (ORDER BY fb) - 1 + (count(*) OVER (PARTITION BY fb) + 1) / 2.0) / count(*) OVER () AS r_fb,
    customer_id IN (SELECT customer_id FROM lab) AS hist
  FROM te)
""")


@register("alpha_sweep", SWEEP_SQL)
def q_alpha_sweep(spark, sf_dir):
    """M12 + S5/J8: one prediction column per alpha, left-joined to the test template."""
    from kestrel.sources.fixture import labels_from_raw, raw_events
    from kestrel.sources.sinks import template_join
    tl = fixture_timeline(spark, sf_dir, by_customer=False)
    test = tl.filter(F.col("period") == "test").select(
        "event_id", "customer_id",
        ((F.col("event_id") * 37) % 101 / 101.0).alias("cb"),
        ((F.col("event_desc") * 5 + F.pmod("mcc_code_i", F.lit(13))) / 100.0).alias("fb"))
    test = S.average_rank(test, "cb", "r_cb")
    test = S.average_rank(test, "fb", "r_fb")
    test = S.history_flag(test, labels_from_raw(raw_events(spark, sf_dir)), "hist")
    arr = F.array(*[F.lit(a) for a in S.ALPHA_SWEEP])
    preds = test.select("event_id", F.explode(arr).alias("alpha"), "r_cb", "r_fb", "hist")
    a = F.col("alpha")
    preds = preds.select("event_id", "alpha", F.when(F.col("hist"), (1.0 - a) * F.col("r_cb")
                         + a * F.col("r_fb")).otherwise(F.col("r_cb")).alias("predict"))
    template = tl.filter(F.col("period") == "test").select("event_id").distinct()
    return template_join(template, preds, ["alpha"])


# --------------------------------------------------------------------------
# seed_avg: M13; rank_blend: M14 (weighted rank blend + Spearman)

SEED_AVG_SQL = with_base("SELECT event_id, " + _d("avg(s)", "score_mean") + ", "
                         + _i("count(*)", "n_seeds") + " FROM sd GROUP BY event_id", """
sd AS (SELECT event_id, ((event_id * 31 + seed) % 97) / 97.0 AS s
       FROM t, (SELECT unnest([42, 123, 777]) AS seed) k WHERE period = 'test')
""")


@register("seed_avg", SEED_AVG_SQL)
def q_seed_avg(spark, sf_dir):
    """Mean of per-seed scores (one row per event and seed in, one per event out)."""
    tl = fixture_timeline(spark, sf_dir, by_customer=False).filter(F.col("period") == "test")
    per_seed = tl.select("event_id", F.explode(F.array(*[F.lit(s) for s in (42, 123, 777)]))
                         .alias("seed"))
    per_seed = per_seed.withColumn("score", (F.col("event_id") * 31 + F.col("seed")) % 97 / 97.0)
    return S.seed_average(per_seed)


RANK_BLEND_SQL = with_base("""
SELECT """ + _d("corr(r_a, r_b)", "spearman") + ", " + _d("avg(0.6 * r_a + 0.4 * r_b)", "mean_blend")
    + ", " + _i("count(*)", "n") + """
FROM (SELECT
  (rank() OVER (ORDER BY s_a) - 1 + (count(*) OVER (PARTITION BY s_a) + 1) / 2.0) / count(*) OVER () AS r_a,
  (rank() OVER (ORDER BY s_fb) - 1 + (count(*) OVER (PARTITION BY s_fb) + 1) / 2.0) / count(*) OVER () AS r_b
  FROM sc)
""", SCORED_CTE)


@register("rank_blend", RANK_BLEND_SQL)
def q_rank_blend(spark, sf_dir):
    """Weighted rank average of two score sources and their Spearman correlation."""
    df = scored(spark, sf_dir)
    df = S.average_rank(df, "s_a", "r_a")
    df = S.average_rank(df, "s_fb", "r_b")
    return df.agg(F.corr("r_a", "r_b").alias("spearman"),
                  F.avg(0.6 * F.col("r_a") + 0.4 * F.col("r_b")).alias("mean_blend"),
                  F.count(F.lit(1)).alias("n"))



# --------------------------------------------------------------------------
# refit_submission: entry C after the models (M6, M9, M10, M13, J8, J9) as one plan on stored scores

def _stored(seed: str) -> dict[str, str]:
    return {"s_main": f"((event_id * 37 + {seed}) % 101) / 101", "s_recent": f"((event_id * 31 + {seed}) % 97) / 97",
            "s_prod": f"((event_id * 29 + 3 * {seed}) % 89) / 89", "s_fb": f"((event_id * 17 + 5 * {seed}) % 83) / 83"}


REFIT_SUBMISSION_SQL = with_base("SELECT event_id, " + _d(
    "CASE WHEN hist THEN 0.7 * r_cb + 0.3 * r_fb ELSE r_cb END", "predict") + " FROM rr", """
sd AS (SELECT event_id, customer_id, """ + ", ".join(
    f"{v.replace(' / ', ' / CAST(')} AS DOUBLE) AS {k}" for k, v in _stored("seed").items()) + """
  FROM t, (SELECT unnest([42, 123, 777]) AS seed) k WHERE period = 'test'),
mn AS (SELECT event_id, customer_id, avg(s_main) AS s_main, avg(s_recent) AS s_recent, avg(s_prod) AS s_prod, avg(s_fb) AS s_fb
  FROM sd GROUP BY event_id, customer_id),
bl AS (SELECT *, round(0.35 * s_main + 0.2 * s_recent + 0.45 * s_prod, 9) AS cb, round(s_fb, 9) AS fb FROM mn),
rr AS (SELECT event_id, customer_id IN (SELECT customer_id FROM lab) AS hist,
    (rank() OVER (ORDER BY cb) - 1 + (count(*) OVER (PARTITION BY cb) + 1) / 2.0) / count(*) OVER () AS r_cb,
    (rank() OVER (ORDER BY fb) - 1 + (count(*) OVER (PARTITION BY fb) + 1) / 2.0) / count(*) OVER () AS r_fb FROM bl)
""")


@register("refit_submission", REFIT_SUBMISSION_SQL)
def q_refit_submission(spark, sf_dir):
    """Seed means, blend, ranks, injection and submission of stored per-seed scores."""
    from kestrel.plans.refit import SEEDS, submission
    from kestrel.sources.fixture import labels_from_raw, raw_events
    test = fixture_timeline(spark, sf_dir, by_customer=False).filter(F.col("period") == "test").select(
        "event_id", "customer_id")
    scored_ = test.withColumn("seed", F.explode(F.array(*[F.lit(s) for s in SEEDS]))).selectExpr(
        "event_id", "customer_id", "seed", *[f"{v} AS {k}" for k, v in _stored("seed").items()])
    return submission(scored_, labels_from_raw(raw_events(spark, sf_dir)), test.select("event_id"), (0.35, 0.2, 0.45), 0.3)
