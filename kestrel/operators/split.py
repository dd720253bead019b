"""Prefix statistics of split keys: many groups, one stream, one exchange.

A *group* is a window specification ``(keys, group keys)`` in ``(time, id)`` order; a
*measure* of it is a statistic over all earlier rows: a sum, a maximum, or the
values of the last row.  A window over one hot key is one task.  Here a hot
key is cut into time buckets (``prefix.time_buckets``) and every bucket is its own
window partition, headed by one *carry row* for each group value that occurs in it:

1. totals per (keys, group, group value, bucket), with partial aggregation;
2. the running statistic over earlier buckets of the same group value, one row an
   occupied bucket, is the carry;
3. carry rows and data rows meet by (keys, bucket), once for all groups.  In the
   window of group g the carry rows of other groups have the group value null, so they
   stand apart; g's own stand first, and what they hold counts like earlier rows.

The carry of "last" is the last row itself, as the greatest (time, id, values) struct:
a lag over a bucket border needs nothing else.  A group value that is open over the
border (a session, a day, an hour, a transition) is a value with a carry; one that
is closed has none.  Rows without a time come first and form a bucket of their own.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators.prefix import BUCKET_ROWS, placed_buckets
from kestrel.sources.sinks import stage

#: Stands for a null group value, so that null marks the rows of other groups only.
_NULL_KEY = -(2**63)


@dataclass(frozen=True)
class Measure:
    """``kind`` "sum" or "max" of ``value`` over earlier rows, or "last": ``value`` of the row before."""
    name: str
    kind: str
    value: Column
    dtype: str


@dataclass(frozen=True)
class Group:
    """Measures over rows with equal ``by`` (at most two integer columns) besides the main keys."""
    by: tuple[Column, ...]
    measures: tuple[Measure, ...]


def _agg(kind: str) -> Callable[[Column], Column]:
    return F.sum if kind == "sum" else F.max


def _slots(groups: list[Group]) -> tuple[dict[tuple[str, str, int], str], list[list[str]]]:
    """Shared total columns: measures of different groups use the same column if kind and type agree."""
    slots: dict[tuple[str, str, int], str] = {}
    used = []
    for g in groups:
        seen: dict[tuple[str, str], int] = {}
        own = []
        for m in g.measures:
            k = (m.kind, m.dtype)
            seen[k] = seen.get(k, 0) + 1
            own.append(slots.setdefault((*k, seen[k]), f"_s{len(slots)}"))
        used.append(own)
    return slots, used


def prefix_groups(df: DataFrame, keys: list[str], groups: list[Group], *, time_col: str = "ets",
                  id_col: str = "event_id", bucket_rows: int | None = None, saved: bool = False) -> DataFrame:
    """Add every measure: the statistic over strictly earlier rows of its group, null if there is none.

    A key of up to ``bucket_rows`` rows is one task; a longer one is split.  ``last`` values
    are structs; their first two fields are the time and id of the row, which order it.
    The rows are read for the buckets, the totals and the windows, so they are staged
    first, as Parquet, of which each reader takes its columns only; ``saved`` rows are cheap to read already.
    """
    b = "_pb"
    df = df if saved else stage(df, "split")
    base = placed_buckets(df, keys, time_col, b, bucket_rows or BUCKET_ROWS)
    slots, used = _slots(groups)
    types = {name: dtype for (_, dtype, _), name in slots.items()}
    kinds = {name: kind for (kind, _, _), name in slots.items()}

    def by(g: Group, j: int) -> Column:
        return F.coalesce(g.by[j].cast("long"), F.lit(_NULL_KEY)) if j < len(g.by) else F.lit(0).cast("long")

    def value(m: Measure) -> Column:
        return m.value.cast(m.dtype)

    def total(i: int) -> list[Column]:
        have = dict(zip(used[i], groups[i].measures))
        return [(value(have[s]) if s in have else F.lit(None).cast(types[s])).alias(s) for s in slots.values()]

    # groups with "last" are aggregated on their own: a struct maximum sorts its rows
    lone = [i for i, g in enumerate(groups) if any(m.kind == "last" for m in g.measures)]
    many = [i for i in range(len(groups)) if i not in lone]
    parts = [base.select(*keys, b, F.lit(i).alias("_g"), by(groups[i], 0).alias("_v1"), by(groups[i], 1).alias("_v2"), *total(i))
             for i in lone]
    if many:
        wide = [s for s in slots.values() if kinds[s] != "last"]
        one = [F.struct(F.lit(i).alias("_g"), by(groups[i], 0).alias("_v1"), by(groups[i], 1).alias("_v2"),
                        *[c for c, s in zip(total(i), slots.values()) if s in wide]) for i in many]
        flat = base.select(*keys, b, F.explode(F.array(*one)).alias("_e")).select(*keys, b, "_e.*")
        parts.append(flat.withColumns({s: F.lit(None).cast(types[s]) for s in slots.values() if s not in wide}))
    spec = [*keys, "_g", "_v1", "_v2"]
    carries = []
    for p in parts:
        tot = p.groupBy(*spec, b).agg(*[_agg(kinds[s])(s).alias(s) for s in slots.values()])
        before = Window.partitionBy(*spec).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
        c = tot.select(*spec, b, *[_agg(kinds[s])(s).over(before).alias(s) for s in slots.values()],
                       F.row_number().over(Window.partitionBy(*spec).orderBy(b)).alias("_occupied"))
        carries.append(c.where("_occupied > 1").drop("_occupied"))

    rows = base.withColumns({"_g": F.lit(None).cast("int")})
    for c in carries:
        rows = rows.unionByName(c, allowMissingColumns=True)
    rows = rows.repartition(*keys, b)
    data = F.col("_g").isNull()
    own, out = {}, {}
    for i, g in enumerate(groups):
        for j in range(max(1, len(g.by))):
            own[f"_k{i}_{j}"] = F.when(data, by(g, j)).when(F.col("_g") == i, F.col(f"_v{j + 1}"))
    rows = rows.withColumns({**own, "_kind": F.when(data, 1).otherwise(0)})
    for i, g in enumerate(groups):
        # the greatest "last" so far is the one of the row before: equal times and ids are ordered by it
        lasts = {m.name: F.when(data, value(m)).otherwise(F.col(s)) for s, m in zip(used[i], g.measures) if m.kind == "last"}
        w = (Window.partitionBy(*keys, b, *[f"_k{i}_{j}" for j in range(max(1, len(g.by)))])
             .orderBy("_kind", time_col, id_col, *lasts.values()))
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        for s, m in zip(used[i], g.measures):
            out[m.name] = (F.lag(lasts[m.name], 1).over(w) if m.kind == "last" else
                           _agg(m.kind)(F.when(data, value(m)).otherwise(F.col(s))).over(before))
    return rows.withColumns(out).where(data).drop(b, "_g", "_v1", "_v2", "_kind", *own, *slots.values())


def with_halo(df: DataFrame, keys: list[str], index: str, n: int, carried: list[str],
              columns: Callable[[object], dict[str, Column]], rows: int) -> DataFrame:
    """Windows over at most the ``n`` rows before, for keys of any length.

    ``index`` counts the rows of a key from 1.  Every ``rows`` of them are one
    partition; the last ``n`` before a border are copied to the next partition
    (to the next ones, if those are shorter than ``n``) with their ``carried`` columns.
    ``columns`` gets the window specification and returns the output columns.
    """
    at = F.col(index) - 1
    own = F.floor(at / rows)
    reach = F.floor((at + n) / rows)
    data = df.withColumns({"_hb": own, "_own": F.lit(True)})
    halo = df.where(reach > own).select(
        *keys, index, *carried, F.explode(F.sequence(own + 1, reach)).alias("_hb"), F.lit(False).alias("_own"))
    both = data.unionByName(halo, allowMissingColumns=True).repartition(*keys, "_hb")
    w = Window.partitionBy(*keys, "_hb").orderBy(index)
    return both.withColumns(columns(w)).where("_own").drop("_hb", "_own")


def long_keys(df: DataFrame, keys: list[str], limit: int, rows: Column | None = None) -> DataFrame | None:
    """The keys of more than ``limit`` rows, as ``_long_<key>``; None if there are none.

    There are at most rows / limit of them; only the key columns are read. ``rows`` counts a key's rows
    where ``df`` is not the rows themselves.
    """
    long = df.groupBy(*keys).agg((F.count(F.lit(1)) if rows is None else rows).alias("_n")).where(F.col("_n") > limit)
    long = long.select(*[F.col(k).alias(f"_long_{k}") for k in keys])
    return None if long.isEmpty() else long


def packed(df: DataFrame, plain: list[str], out: str = "_row") -> DataFrame:
    """``df`` with all columns but ``plain`` in one struct, which costs added stream rows (where it is null) one word."""
    rest = [c for c in df.columns if c not in plain]
    return df.select(*plain, F.struct(*rest).alias(out))


def unpacked(df: DataFrame, names: list[str], plain: list[str], made: list[str], packed_as: str = "_row") -> DataFrame:
    """The columns ``names`` of a ``packed`` frame in their old order, and the columns ``made`` since then."""
    return df.select(*[F.col(c) if c in plain else F.col(f"{packed_as}.`{c}`").alias(c) for c in names], *made)


def parted(df: DataFrame, keys: list[str], long: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of all other keys, and those of the long ones; a null key is a key."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & df[k].eqNullSafe(long[f"_long_{k}"])
    return df.join(long, cond, "left_anti"), df.join(long, cond, "left_semi")


def by_rows(df: DataFrame, keys: list[str], limit: int, few: Callable[[DataFrame], DataFrame],
            many: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``few`` for keys of up to ``limit`` rows and ``many`` for the others, one plan a key.

    Both plans must give the same rows; the limit is a bound on one task's work.
    Without long keys, ``df`` goes through ``few`` with its partitioning and nothing else.
    """
    long = long_keys(df, keys, limit)
    if long is None:
        return few(df)
    short, rest = parted(df, keys, long)
    return few(short).unionByName(many(rest))
