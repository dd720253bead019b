"""Benchmark the headline feature blocks; prints ONE JSON line on stdout.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8).  Each query is executed in full with the ``noop`` sink (no
collect).  Beside the headline blocks (whose sum is the metric) it reports the
split plans on a timeline where one customer has a third of all events, and
how the blocks' seconds grow from the next smaller tables (``growth``: power of the events).  Shuffle bytes and spill per query come from Spark's event log,
written to a fresh scratch folder (no UI, no REST).
"""

from __future__ import annotations

import glob
import json
import math
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def _blocks():
    from pyspark.sql import functions as F

    from kestrel.operators import customer as C
    from kestrel.operators.device import device_features
    from kestrel.operators.priors import (customer_profiles, prior_source, stacked_pair_priors,
                                          stacked_priors)
    from kestrel.operators.rolling import rolling_features
    from kestrel.operators.scoring import average_precision, average_rank
    from kestrel.plans.features import build_features
    from kestrel.plans.velocity import velocity_block, velocity_table, velocity_table_split

    live = F.col("period") != "pretrain"
    return {
        "velocity": lambda tl: velocity_block(tl),
        "velocity_split": lambda tl: velocity_table_split(tl),
        "velocity_windows": lambda tl: velocity_table(tl),
        "customer_block": lambda tl: C.customer_features(tl),
        "rolling_frame": lambda tl: rolling_features(C.lag_block(tl), "frame", live),
        "rolling_delta": lambda tl: rolling_features(C.lag_block(tl), "delta", live),
        "device_block": lambda tl: device_features(tl),
        "priors": lambda tl: stacked_priors(prior_source(tl)).unionByName(
            stacked_pair_priors(prior_source(tl)).withColumnRenamed("pair_name", "key_name")
            .withColumnRenamed("a_value", "key_value").drop("b_value")),
        "profiles": lambda tl: customer_profiles(tl.filter(F.col("period") == "pretrain")),
        "rank_ap": lambda tl: average_precision(
            average_rank(tl.filter(F.col("period") == "train")
                         .withColumn("s", (F.col("event_id") * 37) % 101 / 101.0), "s", "r"),
            "r", "is_red_lbl"),
        "features_full": lambda tl: build_features(tl),
    }


def _hot_blocks():
    """Split plans over the ``hot`` variant, customers of over 5,000 events split."""
    from pyspark.sql import functions as F

    from kestrel.operators import hot
    from kestrel.plans.velocity import velocity_block

    live = F.col("period") != "pretrain"
    return {
        "velocity_hot": lambda tl: velocity_block(tl, 5_000),
        "customer_hot": lambda tl: hot.customer_block(tl, bucket_rows=5_000),
        "rolling_hot": lambda tl: hot.rolling_block(hot.customer_block(tl, ("lag",), 5_000), live=live, frame_rows=5_000),
    }


def _run(spark, blocks, timeline, label=""):
    secs = {}
    for name, fn in blocks.items():
        spark.sparkContext.setJobGroup(name + label, name + label)
        t0 = time.time()
        fn(timeline()).write.format("noop").mode("overwrite").save()
        secs[name] = round(time.time() - t0, 3)
        print(f"[bench] {name}{label}: {secs[name]}s", file=sys.stderr, flush=True)
    return secs


def _smaller(sf_dir: str) -> str | None:
    """The tables of a tenth of the size, where there are any."""
    top, name = os.path.split(sf_dir)
    try:
        path = os.path.join(top, f"sf{float(name.removeprefix('sf')) / 10:g}")
    except ValueError:
        return None
    return path if os.path.isdir(path) else None


def _metrics_from_log(log_dir: str) -> dict[str, dict[str, int]]:
    stage_group: dict[int, str] = {}
    out: dict[str, dict[str, int]] = {}
    paths = [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
             if os.path.isfile(p)]
    for path in sorted(paths):
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    g = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    if g:
                        for sid in ev.get("Stage IDs", []):
                            stage_group[sid] = g
                elif kind == "SparkListenerTaskEnd":
                    g = stage_group.get(ev.get("Stage ID"))
                    m = ev.get("Task Metrics") or {}
                    if not g:
                        continue
                    acc = out.setdefault(g, {"shuffle_bytes": 0, "spill_bytes": 0})
                    sw = m.get("Shuffle Write Metrics") or {}
                    acc["shuffle_bytes"] += int(sw.get("Shuffle Bytes Written", 0))
                    acc["spill_bytes"] += int(m.get("Memory Bytes Spilled", 0)) + int(
                        m.get("Disk Bytes Spilled", 0))
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="kestrel-bench-")
    log_dir = os.path.join(scratch, "events")
    os.makedirs(log_dir)
    from kestrel.session import build_session
    spark = build_session(f"local[{cpus}]", app="kestrel-bench", shuffle_partitions=int(cpus), extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false",
        "spark.checkpoint.dir": os.path.join(scratch, "ckpt")})
    spark.sparkContext.setLogLevel("ERROR")
    from kestrel.sources.timeline import fixture_timeline

    blocks = _blocks()
    n_events = fixture_timeline(spark, sf_dir).count()
    small = _smaller(sf_dir)
    growth = {}
    if small:  # also the warm-up (JVM, codegen) of every block
        n_small = fixture_timeline(spark, small).count()
        _run(spark, blocks, lambda: fixture_timeline(spark, small), " (warm-up)")
        growth = _run(spark, blocks, lambda: fixture_timeline(spark, small), " (small)")
    secs = _run(spark, blocks, lambda: fixture_timeline(spark, sf_dir))
    growth = {k: round(math.log(max(secs[k], 0.001) / max(v, 0.001)) / math.log(n_events / n_small), 3)
              for k, v in growth.items()} if small and n_events > n_small else {}
    hot = _run(spark, _hot_blocks(), lambda: fixture_timeline(spark, sf_dir, by_customer=False, variant="hot"))
    spark.sparkContext.setJobGroup("rows", "rows")
    spark.stop()
    metrics = _metrics_from_log(log_dir)
    total = round(sum(secs.values()), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "feature_blocks_total_sec", "value": total, "unit": "sec",
        "queries": secs, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "events": n_events,
        "events_per_sec": {k: round(n_events / v, 1) for k, v in secs.items() if v > 0},
        "shuffle_bytes": {k: v["shuffle_bytes"] for k, v in metrics.items() if k in secs},
        "spill_bytes": {k: v["spill_bytes"] for k, v in metrics.items() if k in secs},
        "growth": growth, "hot_customer_sec": hot, "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
