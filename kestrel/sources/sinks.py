"""Sinks: stage parquet, run config JSON, embeddings, template-driven CSV
(inventory S5-S8, J8)."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.session import checkpoint_dir


class IncompleteSubmission(ValueError):
    pass


def template_join(template: DataFrame, preds: DataFrame, extra_keys: list[str] = ()) -> DataFrame:
    """Template ``event_id`` list left-joined to predictions; every template
    row must get a prediction (checked with one distributed count, no collect)."""
    out = template.join(preds, "event_id", "left")
    missing = out.filter(F.col("predict").isNull()).count()
    if missing:
        raise IncompleteSubmission(f"{missing} template rows without a prediction")
    return out.select("event_id", *extra_keys, "predict")


def write_submission(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header; one file per alpha when an ``alpha`` column is present."""
    w = df.write.mode(mode).option("header", True)
    if "alpha" in df.columns:
        w = w.partitionBy("alpha")
    w.csv(path)


def write_stage(df: DataFrame, path: str, force: bool = False) -> str:
    """Zstd parquet stage; reuse an existing stage unless ``force``."""
    spark = df.sparkSession
    if not force and stage_exists(spark, path):
        return path
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return path


def stage(df: DataFrame, name: str, periods: str | None = None) -> DataFrame:
    """S6 inside a plan: write a stage to the shared folder once and read it with column pruning.

    ``periods``: a column whose values become folders, so that a filter on it skips the others.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/stage-{name}-{uuid.uuid4().hex}"
    w = df.write.option("compression", "zstd")
    (w.partitionBy(periods) if periods else w).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def bucketed_stage(df: DataFrame, name: str, key: str, periods: str, buckets: int | None = None) -> DataFrame:
    """A stage bucketed by ``key`` and with a folder for each value of ``periods``.

    Readers that work by ``key`` need no exchange, readers of one period skip the rest.  One exchange
    deals the rows to ``buckets`` tasks (the session's shuffle partitions), each of which writes one file a
    period.  A bucket is read by one task, so keys too long for a task do not belong here.
    """
    spark = df.sparkSession
    ident = uuid.uuid4().hex
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    w = df.repartition(n, key).write.format("parquet").option("compression", "zstd")
    w = w.option("path", f"{checkpoint_dir(spark).rstrip('/')}/stage-{name}-{ident}")
    w.partitionBy(periods).bucketBy(n, key).saveAsTable(f"kestrel_{name}_{ident}")
    return spark.table(f"kestrel_{name}_{ident}").select(*df.columns)


def stage_exists(spark: SparkSession, path: str) -> bool:
    """A stage is finished once its writer has committed all files (``_SUCCESS``), not when its folder exists."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return p.getFileSystem(conf).exists(p)


def input_state(spark: SparkSession, paths: list[str]) -> list[tuple[str, int, int]]:
    """(path, bytes, time of change) of every input file, in order of their paths."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for top in paths:
        p = jvm.org.apache.hadoop.fs.Path(top)
        files = p.getFileSystem(conf).listFiles(p, True)
        while files.hasNext():
            f = files.next()
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(found)


def fingerprint(spark: SparkSession, inputs: list[str], params: dict) -> str:
    """Hash of the inputs' files and of the parameters: what a stage depends on."""
    state = json.dumps([input_state(spark, inputs), params], sort_keys=True, default=str)
    return hashlib.sha256(state.encode()).hexdigest()[:32]


def cached_stage(spark: SparkSession, root: str, name: str, inputs: list[str], params: dict,
                 build: Callable[[], DataFrame]) -> DataFrame:
    """The finished stage of these inputs and parameters, or ``build()`` written as such.

    A folder that a killed run left behind has no ``_SUCCESS`` and is written anew;
    changed inputs or parameters lead to another folder.
    """
    path = f"{root.rstrip('/')}/{name}-{fingerprint(spark, inputs, params)}"
    if not stage_exists(spark, path):
        write_stage(build(), path, force=True)
    return spark.read.parquet(path)


@dataclass(frozen=True)
class RunConfig:
    """What the first stage decides and the second stage needs."""
    blend_main: float
    blend_recent: float
    blend_prod: float
    alpha: float
    seeds: list[int]
    trees: dict[str, int]
    features: list[str]
    vector_size: int

    SCHEMA = ("blend_main double, blend_recent double, blend_prod double, alpha double, seeds array<int>, "
              "trees map<string,int>, features array<string>, vector_size int")


def write_config(spark: SparkSession, cfg: RunConfig, path: str) -> None:
    """Run config as a one-row JSON dataset."""
    spark.createDataFrame([asdict(cfg)], RunConfig.SCHEMA).coalesce(1).write.mode("overwrite").json(path)


def read_config(spark: SparkSession, path: str) -> RunConfig:
    """The config of a finished run; a missing, unfinished or incomplete one is an error."""
    if not stage_exists(spark, path):
        raise FileNotFoundError(f"no finished run config in {path}")
    rows = spark.read.schema(RunConfig.SCHEMA).json(path).take(2)
    if len(rows) != 1 or any(v is None for v in rows[0]):
        raise ValueError(f"the run config in {path} is not one complete row")
    return RunConfig(**rows[0].asDict())


def write_embeddings(df: DataFrame, path: str) -> None:
    """Customer -> ``array<float>`` vector parquet."""
    df.select("customer_id", F.col("embedding").cast("array<float>")) \
        .write.mode("overwrite").option("compression", "zstd").parquet(path)


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    """The vectors written by ``write_embeddings``."""
    return spark.read.schema("customer_id long, embedding array<float>").parquet(path)
