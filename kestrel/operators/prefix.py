"""Skew-proof exclusive prefix sums: the two-level (bucketed) scan.

Problem: a window ``partitionBy(key).orderBy(ts, id)`` sends every row of a
key to one task.  The device key is heavily skewed (the "no device"
fingerprint holds most rows), so that plan puts most of the data in one task.

Plan (for each spec = partition keys + optional extra key + weight):

1. ``bucket = floor(ts / bucket_seconds)``.  Distinct counts ("values of
   ``c`` seen before") become weight-1 *marker rows* at the first occurrence
   of each value (one small ``groupBy ... min(struct(ts, id))``), so they are
   plain sums in the same pass.
2. Level 2 - bucket totals: one ``groupBy(keys, spec, key value, bucket)``
   over rows expanded once per spec (partial aggregation map-side, so the
   shuffle carries at most one row per group and map task), then an
   exclusive running sum over buckets per ``(keys, spec, key value)``.  These
   tables have one row per occupied bucket: small, however hot the key.
3. Level 1 - the carries are appended as *carry rows* that sort first in
   their ``(keys, bucket, key value)`` partition; a plain exclusive window
   sum over carry + earlier rows of the bucket is the global prefix.  All
   specs' windows are clustered on ``(keys, bucket)``, so level 1 costs one
   exchange for any number of specs, and no join back is needed.

Only hot keys are split (see ``time_buckets``): a key with more than
``bucket_rows`` rows gets time buckets holding about ``bucket_rows`` rows
each, so it spreads over ``rows / bucket_rows`` tasks; every other key is a
single bucket and needs no carry rows.  Ties in ``ts`` stay in one bucket, so
``(ts, id)`` order is preserved.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.functions.scalars import EXACT_AMOUNT
from kestrel.sources.sinks import stage

DEFAULT_BUCKET_SECONDS = 3600
# Rows of one (key, time bucket) partition, at about: what one task sorts in
# memory.  A key with more rows is split; the bound does not depend on the size
# of the input or the cluster, and neither does any result.
BUCKET_ROWS = 100_000
DEFAULT_BUCKET_ROWS: int | None = None
# Parts into which a hot key's rows are dealt where they learn the key's time range.
PARTS = 64
# Time cells a bucket: buckets are cut at cell borders so that they hold about
# equally many rows even where a key's rows cluster in time.
CELLS = 16
# Buckets of one key, at most, where they are looked up in an array.
MAX_BUCKETS = 1024


@dataclass(frozen=True)
class PrefixSpec:
    name: str                 # output column
    extra_key: str | None     # additional partition column (besides the common keys)
    weight: Column | None     # per-row value to accumulate (null = 0)
    dtype: str = "long"       # accumulation type ("long" or an exact decimal)
    distinct_of: str | None = None  # count distinct values of this column instead
    agg: str = "sum"          # "sum" or "max" (max of earlier rows = the latest earlier value
                              # for a non-decreasing column, i.e. a lag of the time column)


def _markers(df: DataFrame, keys: list[str], i: int, s: PrefixSpec, time_col: str,
             id_col: str, b: str) -> DataFrame:
    """First occurrence of each ``distinct_of`` value as a weight-1 marker row
    placed right after the real row it marks (same time, id and bucket)."""
    grp = [*keys, *([s.extra_key] if s.extra_key else []), s.distinct_of]
    first = df.groupBy(*grp).agg(F.min(F.struct(time_col, id_col, b)).alias("_f"))
    return first.select(
        *keys, F.col(f"_f.{time_col}").alias(time_col), F.col(f"_f.{id_col}").alias(id_col),
        F.col(f"_f.{b}").alias(b),
        (F.col(s.extra_key).cast("long") if s.extra_key else F.lit(0).cast("long")).alias(f"_k{i}"),
        F.lit(1).cast("long").alias(f"_w{i}"), F.lit(2).alias("_kind"))


def time_buckets(df: DataFrame, keys: list[str], time_col: str, out: str,
                 bucket_rows: int | None, bucket_seconds: int | None) -> DataFrame:
    """Add the bucket column.

    ``bucket_seconds``: fixed-width time buckets for every key.  Otherwise a key
    with more than ``bucket_rows`` rows (a null key included) is split into
    buckets of about that many rows: its time range is cut into ``CELLS`` cells
    per bucket, the cells' row counts are summed up in order, and every
    ``bucket_rows`` rows begin a new bucket.  All other keys are bucket 0.  The rows
    meet their key's time range by (key, part of a hash of the time) and their cell by (key,
    cell), so that a hot key is no single task there either.  Both
    tables that are joined back have at most ``PARTS * rows / bucket_rows`` rows;
    adaptive execution broadcasts them where they measure small.  Rows without a
    time come first in a bucket of their own.
    """
    if bucket_seconds:
        return df.withColumn(out, F.floor(F.col(time_col) / bucket_seconds))
    bucket_rows = bucket_rows or BUCKET_ROWS
    t = F.col(time_col)
    hot = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(t).alias("_t0"),
                                 F.max(t).alias("_t1"))
             .filter(F.col("_n") > bucket_rows)
             .select(*[F.col(k).alias(f"_h_{k}") for k in keys], "_t0", F.greatest(
                 F.floor((F.col("_t1") - F.col("_t0") + 1) * bucket_rows / (F.col("_n") * CELLS)),
                 F.lit(1)).alias("_bw"), F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("_h_part")))
    df = df.withColumn("_part", F.pmod(F.hash(t), F.lit(PARTS)))

    def same(left: DataFrame, right: DataFrame, prefix: str):
        cond = F.lit(True)
        for k in keys:
            cond = cond & left[k].eqNullSafe(right[f"{prefix}{k}"])
        return cond

    cells = df.join(hot, same(df, hot, "_h_") & (df["_part"] == hot["_h_part"]), "left")
    cells = cells.drop("_part", "_h_part", *[f"_h_{k}" for k in keys])
    cells = cells.withColumn("_cell", F.floor((t - F.col("_t0")) / F.col("_bw"))).drop("_t0", "_bw")
    filled = cells.filter(F.col("_cell").isNotNull()).groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    place = filled.select(
        *[F.col(k).alias(f"_c_{k}") for k in keys], F.col("_cell").alias("_c_cell"),
        F.floor(F.coalesce(F.sum("_n").over(before), F.lit(0)) / bucket_rows).alias("_place"))
    out_df = cells.join(place, same(cells, place, "_c_") & (cells["_cell"] == place["_c_cell"]), "left")
    bucket = F.when(t.isNull(), F.lit(-1)).otherwise(F.coalesce("_place", F.lit(0)))
    return out_df.withColumn(out, bucket).drop("_cell", "_c_cell", "_place", *[f"_c_{k}" for k in keys])


def placed_buckets(df: DataFrame, keys: list[str], time_col: str, out: str, bucket_rows: int) -> DataFrame:
    """``time_buckets`` by row count without moving a row: each hot key's buckets are one small array.

    ``df`` is read once for the keys' sizes and once for the sizes of their cells, both as partial aggregates.
    A key's buckets are an array with the bucket of each cell, so that a row looks its own up. A key has at most
    ``MAX_BUCKETS`` of them (a longer one gets larger buckets), so an array holds at most ``CELLS`` times as many. Both tables
    are staged, so Spark knows how large they are when it chooses how to join them.
    """
    t = F.col(time_col)

    def same(left: DataFrame, right: DataFrame):
        cond = F.lit(True)
        for k in keys:
            cond = cond & left[k].eqNullSafe(right[f"_h_{k}"])
        return cond

    own = [F.col(k).alias(f"_h_{k}") for k in keys]
    held = [f"_h_{k}" for k in keys]
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(t).alias("_t0"), F.max(t).alias("_t1"))
    size = F.greatest(F.lit(bucket_rows), F.ceil(F.col("_n") / MAX_BUCKETS))
    width = F.greatest(F.floor((F.col("_t1") - F.col("_t0") + 1) * size / (F.col("_n") * CELLS)), F.lit(1))
    hot = stage(hot.filter(F.col("_n") > bucket_rows).select(*own, "_t0", width.alias("_bw"), size.alias("_size")), "hot-keys")
    cell = F.floor((t - F.col("_t0")) / F.col("_bw")).cast("int")
    filled = df.select(*keys, time_col).where(t.isNotNull())
    filled = filled.join(hot, same(filled, hot)).select(*held, "_t0", "_bw", "_size", cell.alias("_cell"))
    filled = filled.groupBy(*held, "_t0", "_bw", "_size", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*held).orderBy("_cell")
    before = F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    step = filled.select(*held, "_t0", "_bw", "_cell", F.floor(before / F.col("_size")).cast("int").alias("_place"),
                         (F.coalesce(F.lead("_cell").over(w), F.col("_cell") + 1) - F.col("_cell")).alias("_cells"))
    runs = F.array_sort(F.collect_list(F.struct("_cell", "_place", "_cells")))
    places = step.groupBy(*held, "_t0", "_bw").agg(
        F.flatten(F.transform(runs, lambda x: F.array_repeat(x["_place"], x["_cells"]))).alias("_places"))
    places = stage(places, "places")
    placed = df.join(places, same(df, places), "left")
    bucket = F.when(t.isNull(), F.lit(-1)).otherwise(F.coalesce(F.get("_places", cell), F.lit(0)))
    return placed.withColumn(out, bucket).drop(*held, "_t0", "_bw", "_places")


def exclusive_prefix(df: DataFrame, keys: list[str], specs: list[PrefixSpec], *,
                     time_col: str = "ets", id_col: str = "event_id",
                     bucket_rows: int | None = DEFAULT_BUCKET_ROWS,
                     bucket_seconds: int | None = None) -> DataFrame:
    """Add, for each spec, the sum of ``weight`` over strictly earlier rows
    (by ``(time_col, id_col)``) with equal ``keys`` and equal ``extra_key``."""
    b = "_pb"
    base = time_buckets(df, keys, time_col, b, bucket_rows, bucket_seconds)
    wcols = {}
    for i, s in enumerate(specs):
        wcols[f"_w{i}"] = (F.lit(None).cast(s.dtype) if s.distinct_of else s.weight.cast(s.dtype))
        wcols[f"_k{i}"] = (F.col(s.extra_key).cast("long") if s.extra_key
                           else F.lit(0).cast("long"))
    base = base.withColumns(wcols).withColumn("_kind", F.lit(1))
    marks = [_markers(base, keys, i, s, time_col, id_col, b)
             for i, s in enumerate(specs) if s.distinct_of]
    stream = base
    for m in marks:
        stream = stream.unionByName(m, allowMissingColumns=True)

    # Level 2: one expanded aggregation for all specs (counts stay in long,
    # exact decimals only for the specs that need them, maxima separately).
    is_max = [s.agg == "max" for s in specs]
    is_dec = [s.dtype != "long" and not is_max[i] for i, s in enumerate(specs)]

    def field(i: int, kind: str, dtype: str) -> Column:
        own = ({"l": not is_dec[i] and not is_max[i], "d": is_dec[i], "m": is_max[i]})[kind]
        return (F.col(f"_w{i}").cast(dtype) if own else F.lit(None).cast(dtype)).alias(f"w{kind}")

    exp = stream.select(*keys, b, F.explode(F.array(*[
        F.struct(F.lit(i).alias("sid"), F.col(f"_k{i}").alias("kv"), field(i, "l", "long"),
                 field(i, "d", EXACT_AMOUNT), field(i, "m", "long"))
        for i in range(len(specs))])).alias("_e"))
    tot = (exp.groupBy(*keys, F.col("_e.sid").alias("_sid"), F.col("_e.kv").alias("_kv"), b)
              .agg(F.sum(F.col("_e.wl")).alias("_tl"), F.sum(F.col("_e.wd")).alias("_td"),
                   F.max(F.col("_e.wm")).alias("_tm")))
    wl2 = (Window.partitionBy(*keys, "_sid", "_kv").orderBy(b)
           .rowsBetween(Window.unboundedPreceding, -1))
    carry = tot.withColumns({"_cl": F.sum("_tl").over(wl2), "_cd": F.sum("_td").over(wl2),
                             "_cm": F.max("_tm").over(wl2)})
    carry = carry.filter((F.coalesce(F.col("_cl"), F.lit(0)) != 0)
                         | (F.coalesce(F.col("_cd"), F.lit(0)) != 0)
                         | F.col("_cm").isNotNull())
    carry_cols = {}
    for i, s in enumerate(specs):
        hit = F.col("_sid") == i
        val = F.col("_cm") if is_max[i] else (F.col("_cd") if is_dec[i] else F.col("_cl"))
        carry_cols[f"_w{i}"] = F.when(hit, val).cast(s.dtype)
        carry_cols[f"_k{i}"] = F.when(hit, F.col("_kv"))
    carry = (carry.withColumns(carry_cols).withColumn("_kind", F.lit(0))
                  .drop("_sid", "_kv", "_tl", "_td", "_tm", "_cl", "_cd", "_cm"))

    allrows = stream.unionByName(carry, allowMissingColumns=True)
    allrows = allrows.repartition(*keys, b)
    out = {}
    # carry rows first, then (time, id); a marker sorts right after its row
    car = F.when(F.col("_kind") == 0, F.lit(0)).otherwise(F.lit(1))
    for i, s in enumerate(specs):
        w = (Window.partitionBy(*keys, b, f"_k{i}")
             .orderBy(car, time_col, id_col, "_kind")
             .rowsBetween(Window.unboundedPreceding, -1))
        if s.agg == "max":
            out[s.name] = F.max(f"_w{i}").over(w)
        else:
            out[s.name] = F.coalesce(F.sum(f"_w{i}").over(w), F.lit(0).cast(s.dtype))
    res = allrows.withColumns(out).filter(F.col("_kind") == 1)
    return res.drop(b, "_kind", *wcols.keys())
