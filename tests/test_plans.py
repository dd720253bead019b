"""Physical-plan checks: shuffles where intended, no single-partition windows."""

from conftest import SF001


def _plan(df):
    df.collect()  # an action of this frame, so its own plan becomes the final one
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_customer_block_single_exchange(spark):
    from kestrel.operators import customer as C
    from kestrel.sources.timeline import fixture_timeline
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = _plan(C.customer_features(fixture_timeline(spark, SF001)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    hashed = [line for line in p.split("\n") if "Exchange hashpartitioning" in line]
    # events once by customer_id, labels once by customer_id; every window reuses it
    assert len(hashed) == 2 and all("customer_id" in line for line in hashed)


def test_no_single_partition_exchange(spark):
    import __spark_entry__ as e
    qs = e.queries()
    for name in ["velocity", "device", "rank", "ap", "eda_cdf", "rolling", "sequences"]:
        lines = _plan(qs[name](spark, SF001)).split("\n")
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                # only bounded inputs may meet in one task: aggregates (bucket
                # totals, global sums), never row-level data
                assert "Aggregate" in lines[i + 1], (name, line, lines[i + 1])


def test_scan_prunes_columns(spark):
    import __spark_entry__ as e
    df = e.queries()["priors"](spark, SF001)
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()
    # the events scan reads only the columns the plan uses
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint," in p or \
        "event_id,ts,user_id" in p.replace(" ", "")


def test_no_customer_exchange_after_the_stage(spark):
    """Windows and profiles over the bucketed stage shuffle nothing by customer; a period reads its own folder."""
    from pyspark.sql import functions as F

    from kestrel.operators import customer as C
    from kestrel.operators.priors import customer_profiles
    from kestrel.sources.sinks import bucketed_stage
    from kestrel.sources.timeline import fixture_timeline
    tl = fixture_timeline(spark, SF001, by_customer=False)
    staged = bucketed_stage(tl, "test", "customer_id", "period", 4)
    assert staged.columns == tl.columns and staged.count() == tl.count()
    assert "Exchange" not in _plan(C.customer_features(staged))
    p = _plan(customer_profiles(staged.filter(F.col("period") == "pretrain")))
    assert "Exchange hashpartitioning(customer_id" not in p and "PartitionFilters: [isnotnull(period" in p


def test_wide_rows_go_through_the_prior_joins_as_one_struct(spark):
    from pyspark.sql import functions as F

    from kestrel.operators import priors as P
    from kestrel.session import apply_engine_conf
    apply_engine_conf(spark)
    keys = list(dict.fromkeys([*P.PRIOR_KEYS, *[c for pair in P.PRIOR_PAIRS for c in pair]]))
    rows = spark.range(50).select("id", *[(F.col("id") % 3).alias(k) for k in keys],
                                  (F.col("id") % 2).cast("int").alias("target"), *[F.rand(k).alias(f"x{k}") for k in range(80)])
    rows = rows.checkpoint()
    out = P.attach_priors(rows, rows.select(*keys, "target"))
    assert out.columns[:len(rows.columns)] == rows.columns
    assert out.select(*rows.columns).exceptAll(rows).isEmpty() and out.count() == 50

    def widths(plan) -> list[int]:
        kids = plan.children()
        own = [plan.output().size()] if "Join" in plan.nodeName() else []
        return own + [w for i in range(kids.size()) for w in widths(kids.apply(i))]

    # some of the columns only: the struct's fields are not taken out below the joins
    found = widths(out.drop("x1", "x2")._jdf.queryExecution().optimizedPlan())
    assert found and max(found) < 80
