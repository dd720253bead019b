"""Split plans of hot customers against the plain windows they stand for."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001


@pytest.fixture(scope="module")
def hard(spark):
    """Half of all rows on one customer, a null customer, hours as times (ties), and some rows without a time."""
    from kestrel.sources.timeline import fixture_timeline
    tl = fixture_timeline(spark, SF001, variant="bad")
    tl = tl.withColumn("ets", F.floor(F.col("ets") / 3600) * 3600).withColumn("event_ts", F.timestamp_seconds("ets"))
    customer = F.when(F.col("event_id") % 2 == 0, F.lit(1)).when(F.col("event_id") % 31 != 0, F.col("customer_id"))
    tl = tl.withColumn("customer_id", customer).cache()
    yield tl
    tl.unpersist()


def differences(a, b, key="event_id"):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    left, right = ({r[key]: r for r in df.select(cols).collect()} for df in (a, b))
    assert left and left.keys() == right.keys()
    return {c for k in left for c in cols if left[k][c] != right[k][c] and not (
        isinstance(left[k][c], float) and left[k][c] == pytest.approx(right[k][c], rel=1e-12))}


def test_customer_block_of_split_customers(hard):
    from kestrel.operators import customer as C
    from kestrel.operators.hot import customer_split
    assert differences(C.customer_features(hard), customer_split(hard, bucket_rows=30)) == set()


def test_rolling_block_of_split_customers(hard):
    from kestrel.operators import customer as C
    from kestrel.operators.hot import rolling_block, rolling_split
    from kestrel.operators.rolling import rolling_features
    live = F.col("period") != "pretrain"
    lag = C.lag_block(hard).select(*[c for c in hard.columns if c != "props"], "tz_changed")
    plain = rolling_features(lag, "frame", live)
    assert differences(plain, rolling_split(lag, live, 30)) == set()
    assert differences(plain, rolling_block(lag, live=live, frame_rows=100)) == set()


def test_profiles_and_target_encoding(hard):
    from kestrel.operators import customer as C
    from kestrel.operators import hot as H
    from kestrel.operators import priors as P
    assert differences(P.customer_profiles(hard), H.profiles_split(hard), "customer_id") == set()
    y = hard.withColumn("y", (F.col("train_target_raw") == 1).cast("double"))
    assert differences(C.target_encoding(y, "mcc_code_i", "y"),
                       H.target_encoding_split(y, "mcc_code_i", "y", bucket_rows=30)) == set()
    assert differences(C.target_encoding(y, "event_desc", "y", prior_rate=0.2),
                       H.target_encoding_split(y, "event_desc", "y", prior_rate=0.2, bucket_rows=30)) == set()


def test_each_customer_has_its_own_plan(spark, hard):
    """Long customers, the null one included, go through the second plan and no other."""
    from kestrel.operators.split import by_rows
    n = {r["customer_id"]: r["count"] for r in hard.groupBy("customer_id").count().collect()}
    limit = n[None] - 1
    out = by_rows(hard.select("customer_id", "event_id"), ["customer_id"], limit,
                  lambda d: d.withColumn("plan", F.lit("few")), lambda d: d.withColumn("plan", F.lit("many")))
    got = {(r["customer_id"], r["plan"]) for r in out.collect()}
    assert got == {(c, "many" if k > limit else "few") for c, k in n.items()} and (None, "many") in got
    assert out.count() == sum(n.values())
    few = by_rows(hard, ["customer_id"], 10**6, lambda d: d, lambda d: 1 / 0)
    assert few is hard


def test_no_window_holds_a_hot_customer(hard):
    """The rows of a window partition stay near the bound, however long the customer."""
    from kestrel.operators.prefix import time_buckets
    b = time_buckets(hard, ["customer_id"], "ets", "_b", 60, None)
    rows = hard.groupBy("customer_id", "ets").count().agg(F.max("count")).first()[0]  # ties stay together
    held = b.where("ets IS NOT NULL").groupBy("customer_id", "_b").count().agg(F.max("count")).first()[0]
    assert hard.where("customer_id = 1").count() > 300 and held <= 60 + max(rows, 60)


def test_halo_reaches_over_short_partitions(spark):
    from kestrel.operators.split import with_halo
    df = spark.range(1, 41).select(F.lit(1).alias("k"), F.col("id").alias("i"), (F.col("id") * 1.0).alias("x"))
    got = with_halo(df, ["k"], "i", 7, ["x"], lambda w: {"s": F.sum("x").over(w.rowsBetween(-7, -1))}, 3)
    want = {i: (float(sum(range(max(1, i - 7), i))) if i > 1 else None) for i in range(1, 41)}
    assert {r["i"]: r["s"] for r in got.collect()} == want


def test_last_row_and_group_values_cross_borders(spark):
    """A lag over a border, an open group over several buckets, null group values, and a group that ends."""
    from kestrel.operators.split import Group, Measure, prefix_groups
    rows = [(1, t, t, None if t % 5 == 0 else t % 3 if t < 20 else 9, f"v{t}") for t in range(40)]
    df = spark.createDataFrame(rows, "c long, ets long, event_id long, g int, v string")
    last = Measure("prev", "last", F.struct("ets", "event_id", "v"), "struct<ets: bigint, event_id: bigint, v: string>")
    groups = [Group((), (last, Measure("n", "sum", F.lit(1), "long"))),
              Group((F.col("g"),), (Measure("same", "sum", F.lit(1), "long"), Measure("late", "max", F.col("ets"), "long")))]
    got = {r["ets"]: r for r in prefix_groups(df, ["c"], groups, bucket_rows=4).collect()}
    for _, t, _, g, _ in rows:
        before = [r for r in rows if r[1] < t]
        same = [r[1] for r in before if r[3] == g]
        assert got[t]["n"] == (len(before) or None) and got[t]["same"] == (len(same) or None)
        assert got[t]["late"] == (max(same) if same else None)
        assert (got[t]["prev"]["v"] if before else got[t]["prev"]) == (f"v{t - 1}" if before else None)


def test_staged_build_with_and_without_long_customers(spark):
    """The build's customer and rolling features are the same wherever the limit lies."""
    from kestrel.plans.features import _customer_stage, timeline_block
    from kestrel.sources.timeline import fixture_timeline
    tl = fixture_timeline(spark, SF001, by_customer=False, variant="hot")
    whole, rows = _customer_stage(tl, "frame", 100)
    assert whole.count() == tl.count() and whole.columns == tl.columns
    assert differences(timeline_block(tl), rows) == set()


def test_tasks_are_bounded_by_rows_not_by_the_session(spark):
    from kestrel.plans.features import STAGE_ROWS, task_buckets
    from kestrel.session import apply_engine_conf
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    apply_engine_conf(spark)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "4m"
    assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) >= 500
    assert task_buckets(spark, 36_000_000) * STAGE_ROWS >= 36_000_000
    assert task_buckets(spark, 0) == task_buckets(spark, 4000) == 1


def test_a_hot_key_learns_its_time_range_in_parts(spark):
    from pyspark.sql import functions as F

    from kestrel.operators.prefix import time_buckets
    df = spark.range(600).select(F.lit(1).alias("k"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("ets"))
    out = time_buckets(df.hint("merge"), ["k"], "ets", "b", 50, None)
    assert "_h_part" in out._jdf.queryExecution().optimizedPlan().toString()
    rows = out.collect()
    assert len(rows) == 600 and out.columns == ["k", "ets", "b"]
    assert all((r.b == -1) == (r.ets is None) for r in rows)
    timed = sorted((r.ets, r.b) for r in rows if r.ets is not None)
    assert [b for _, b in timed] == sorted(b for _, b in timed) and len({b for _, b in timed}) > 5


def test_packed_keeps_every_column_and_adds_one_word_to_null_rows(spark):
    from kestrel.operators.split import packed
    df = spark.createDataFrame([(1, 2, "x", None)], "a int, b int, c string, d int")
    out = packed(df, ["b"])
    assert out.columns == ["b", "_row"] and out.select("b", "_row.*").columns == ["b", "a", "c", "d"]
    assert out.select("_row.c").first()[0] == "x"


def test_rows_find_their_buckets_without_moving(spark, hard):
    """The split plans' buckets follow time, stay near the bound, and cost no exchange of the rows."""
    from kestrel.operators.prefix import MAX_BUCKETS, placed_buckets
    rows = hard.select("customer_id", "ets", "event_id")
    rows = spark.createDataFrame(rows.collect(), rows.schema)  # no exchange of its own
    b = placed_buckets(rows, ["customer_id"], "ets", "_b", 60)
    assert b.columns == ["customer_id", "ets", "event_id", "_b"] and b.count() == hard.count()
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    ties = hard.groupBy("customer_id", "ets").count().agg(F.max("count")).first()[0]
    held = b.where("ets IS NOT NULL").groupBy("customer_id", "_b").count().agg(F.max("count")).first()[0]
    assert hard.where("customer_id = 1").count() > 300 and held <= 60 + max(ties, 60)
    got = sorted((r["ets"], r["_b"]) for r in b.where("customer_id = 1").collect() if r["ets"] is not None)
    assert [x for _, x in got] == sorted(x for _, x in got) and len({x for _, x in got}) > 5
    assert b.where("(ets IS NULL) <> (_b = -1)").isEmpty()
    many = spark.range(3000).select(F.lit(1).alias("k"), F.col("id").alias("ets"))
    n = placed_buckets(many, ["k"], "ets", "_b", 1).select("_b").distinct().count()
    assert 500 < n <= MAX_BUCKETS


def test_equal_times_and_ids_take_the_greatest_row_before(spark):
    """A "last" over rows with equal time and id does not depend on the order they come in."""
    from kestrel.operators.split import Group, Measure, prefix_groups
    last = Measure("prev", "last", F.struct("ets", "event_id", "v"), "struct<ets: bigint, event_id: bigint, v: string>")
    for order in (("b", "a"), ("a", "b")):
        df = spark.createDataFrame([(1, 5, 7, v) for v in order] + [(1, 6, 8, "c")], "c long, ets long, event_id long, v string")
        got = {r["v"]: r["prev"] for r in prefix_groups(df.coalesce(1), ["c"], [Group((), (last,))]).collect()}
        assert got["a"] is None and got["b"]["v"] == "a" and got["c"]["v"] == "b"
