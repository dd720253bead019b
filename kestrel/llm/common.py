"""Helpers that the operators of this package share."""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import tempfile
import time
import zipfile
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import hashing
from kestrel.session import checkpoint_dir

#: What separates words: space and the five ASCII control spaces.
SPACE = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it many times in ``body``.

    A column that a lambda mentions is evaluated again for every element; a
    lambda variable is not.
    """
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Maximal runs of non-space characters; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE, -1), lambda w: w != "")


def n_words(text: Column) -> Column:
    """Number of words, without building them."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage through the cluster's shared checkpoint folder.

    Also lets Spark's cleaner drop the shuffle files of frames that are gone.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    out = df.checkpoint()
    release(spark)
    return out


#: Spark's own setting: a query's shuffle files go when it ends.
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut_and_free(df: DataFrame) -> DataFrame:
    """``cut`` for large frames: the shuffle files that led to ``df`` are dropped at once.

    ``df`` must not be used again afterwards; whoever does pays for its shuffles anew.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    before = spark.conf.get(_FREE)
    spark.conf.set(_FREE, "true")
    try:
        return df.select("*").checkpoint()
    finally:
        spark.conf.set(_FREE, before)


def release(spark: SparkSession) -> None:
    """Collect the driver's garbage, so that the cleaner sees which shuffles nobody can read again.

    Spark does this by itself every half hour only; until then the files stay on all executors' disks.
    The first round frees what Python holds, the second what that had held in turn.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows and bytes of one Arrow batch between Spark and Python, at most (one row may be larger).
BATCH_ROWS, BATCH_BYTES = 2000, 4 << 20


#: What a worker keeps from task to task: module -> function that forgets it.
FORGET: dict[str, Callable[[], None]] = {}


def tidy(run: Callable) -> Callable:
    """A batch function whose worker gives its free memory back when a task ends.

    Workers live on for the tasks and stages to come, next to other workers.  One
    that turns to another operator forgets what it kept for the last.
    """
    @functools.wraps(run)
    def inner(*args):
        for module, forget in FORGET.items():
            if module != run.__module__:
                forget()
        try:
            yield from run(*args)
        finally:
            give_back()
    return inner


def tidy_group(run: Callable) -> Callable:
    """The same for a function of one group."""
    @functools.wraps(run)
    def inner(key, group):
        try:
            return run(key, group)
        finally:
            give_back()
    return inner


def give_back() -> None:
    """Return free memory of this Python process to the machine."""
    hashing.forget()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, and bound the batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    sc = spark.sparkContext
    if getattr(sc, "_kestrel_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.join(tempfile.mkdtemp(prefix="kestrel-zip-"), "kestrel_package.zip")
    with zipfile.ZipFile(name, "w") as z:
        for folder, _, files in os.walk(top):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(name)
    sc._kestrel_shipped = True
