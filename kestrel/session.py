"""SparkSession defaults for the feature engine.

Everything downstream assumes the session time zone is UTC (timestamps are
parsed from zone-less strings and turned into epoch seconds) and that AQE is
on (skewed joins are split at runtime, small shuffles coalesced).
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins on (customer_id, event_id) reuse a customer_id partitioning.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Window stages are CPU-heavy: let AQE coalesce small shuffles only down to
    # 256k partitions (large shuffles still coalesce to the advisory size).
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    # A window block sorts its rows once for each specification, some twenty times in one task, and every sort
    # holds them: at 64 MB of shuffle a task (the default) that is several GB. So tasks get a few MB each, out of enough
    # partitions that a partition alone is not larger.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    # Wide rows go through joins as one struct; the optimizer would take its fields out before the joins again.
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "kestrel",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine defaults applied."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in ENGINE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    extra = dict(extra or {})
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        extra.setdefault("spark.driver.memory", "8g")
    for k, v in extra.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_engine_conf(spark)
    return spark


def apply_engine_conf(spark: SparkSession) -> None:
    """Pin the runtime SQL settings the operators rely on (safe on a shared session)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    spark.conf.set("spark.sql.optimizer.nestedSchemaPruning.enabled", ENGINE_CONF["spark.sql.optimizer.nestedSchemaPruning.enabled"])
    for k in ("coalescePartitions.minPartitionSize", "advisoryPartitionSizeInBytes", "coalescePartitions.initialPartitionNum"):
        spark.conf.set(f"spark.sql.adaptive.{k}", ENGINE_CONF[f"spark.sql.adaptive.{k}"])


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Without the setting there is no folder that all machines share, so a
    cluster session is an error; a local session (tests) gets a scratch folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="kestrel-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d
