"""Customer (W, F), rolling (R) and profile (A1, A2) blocks for customers of any size.

The plain blocks keep a customer in one task: one exchange, one sort a window
specification, and for rolling frames a cost of rows times frame length.  That is right
for customers up to a bound (``BUCKET_ROWS``, ``FRAME_ROWS``) and only for them.  Longer
customers take the plans below, which cut a customer by time or by row number; the
values are the same.

* W1-W21, F1-F6: prefix statistics of split keys (``split.prefix_groups``).
* W22, W23: partitions by row number with the last 100 rows before as halo.
* R1, R2, R4, R6: ``+w`` at ``t``, ``-w`` at ``t + p``, summed over strictly earlier times.
* R5: an occurrence at ``t`` adds the part of ``(t, t + p]`` that the one before it (``t0``)
  did not cover, ``(max(t, t0 + p), t + p]``; the parts are disjoint, so the running
  sum of their ends counts distinct values.
* R3: blocks of one period; ``[t - p, t)`` is the part of t's block before t and the part of the
  block before that from ``t - p`` on, a running maximum forward and one backward.
* A1, A2: ranks within the customer from a scan over its distinct amounts, dealt by range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions.scalars import EXACT_AMOUNT
from kestrel.functions.windows import last_n
from kestrel.operators import customer as C
from kestrel.operators import priors as P
from kestrel.operators import rolling as R
from kestrel.operators.prefix import BUCKET_ROWS
from kestrel.operators.scoring import ordered_cumsum
from kestrel.operators.split import Group, Measure, by_rows, packed, prefix_groups, with_halo
from kestrel.sources.sinks import stage

KEY = ["customer_id"]
#: Rows of a customer up to which rolling frames are scanned row by row.
FRAME_ROWS = 10_000
#: Values of the row before that the lag features read, after its time and id.
_LAST = ["amt", "amt_abs", "mcc_code_i", "session_id", "operating_system_type", "screen_w", "timezone"]

#: Columns that the split rolling windows read.
ROLLED = ["customer_id", "event_id", "ets", "mcc_code_i", "amt_abs", "phone_voip_call_state", "tz_changed"]


class _Asked:
    """Measures asked for so far, by group; equal measures are computed once."""

    def __init__(self):
        self.groups: dict[tuple[str, ...], tuple[tuple[Column, ...], dict[str, Measure]]] = {}

    def get(self, by: dict[str, Column], what: str, kind: str, value: Column, dtype: str = "long") -> Column:
        label = tuple(by)
        _, measures = self.groups.setdefault(label, (tuple(by.values()), {}))
        name = "_m_" + "_".join([*label, what])
        measures[what] = Measure(name, kind, value, dtype)
        return F.col(name)

    def listed(self) -> list[Group]:
        return [Group(by, tuple(m.values())) for by, m in self.groups.values()]


def _by(*cols: str) -> dict[str, Column]:
    return {c: F.col(c) for c in cols}


def _first_time(asked: _Asked, by: dict[str, Column]) -> Column:
    """Time of the group's first row; null if that row has none (rows without a time come first)."""
    timeless = asked.get(by, "timeless", "sum", F.col("ets").isNull().cast("long"))
    latest = asked.get(by, "neg", "max", -F.col("ets"))
    return F.when(F.coalesce(timeless, F.lit(0)) == 0, F.when(
        F.col("ets").isNotNull(), F.least(F.col("ets"), -latest)))


def _prefix_columns(blocks: tuple[str, ...], asked: _Asked, last_type: str) -> dict[str, Column]:
    """The window columns of the plain blocks, by name, over measures of split groups."""
    out: dict[str, Column] = {}
    amount = F.col("amt").cast(EXACT_AMOUNT)

    def number(by: dict[str, Column]) -> Column:
        return (F.coalesce(asked.get(by, "n", "sum", F.lit(1)), F.lit(0)) + 1).cast("int")

    def total(by: dict[str, Column], what: str, value: Column) -> Column:
        return F.coalesce(asked.get(by, what, "sum", value, EXACT_AMOUNT).cast("double"), F.lit(0.0))

    def last(field: str) -> Column:
        names = ["ets", "event_id", *_LAST]
        return asked.get({}, "last", "last", F.struct(*names), last_type)[field]

    day = {"day": F.unix_date("event_date")}
    if "counts" in blocks:
        out["cust_event_idx"] = number({})
        for key in [*[k for _, k in C.SAME_KEY_COUNTS], *C.LOG_CNT_COLS]:
            out[f"_rn_{key}"] = number(_by(key))
        out["_rn_combo"] = number(_by("channel_indicator_sub_type", "operating_system_type"))
    elif set(blocks) & {*C._NEEDS_INDEX, "moving_avg"}:
        out.update({"cust_event_idx": number({}), "_rn_event_desc": number(_by("event_desc"))})
    if "lag" in blocks:
        out.update({"prev_ets": last("ets"), "prev_amt": last("amt"), "_lag_sess": last("session_id"),
                    "_prev_os": last("operating_system_type"), "_prev_sw": last("screen_w"), "_prev_tz": last("timezone")})
        out.update({f"_p_{name}": asked.get(_by(key), "ets", "max", F.col("ets")) for name, key in C.SINCE_SAME})
    if set(blocks) & {"lag", "markov"}:
        out["_lag_mcc"] = last("mcc_code_i")
    if "amount" in blocks:
        out.update({"_s1": total({}, "amt", amount), "_prev_abs": last("amt_abs"),
                    "_s2": total({}, "sq", (F.col("amt") * F.col("amt")).cast(EXACT_AMOUNT)),
                    "_pmax": asked.get({}, "abs", "max", F.col("amt_abs"), "double"),
                    "_desc_sum": total(_by("event_desc"), "amt", amount)})
    if "session_day" in blocks:
        out.update({
            "_sess_sum": total(_by("session_id"), "amt", amount), "_sess_first": _first_time(asked, _by("session_id")),
            "_day_sum": total(day, "abs", F.col("amt_abs").cast(EXACT_AMOUNT)),
            "today_max_amount": F.coalesce(asked.get(day, "max", "max", F.col("amt_abs"), "double"), F.lit(0.0)),
            "_rn_day": number(day), "_rn_hour": number({"hours": F.floor(F.col("ets") / 3600)}),
            "_first_ets": _first_time(asked, {})})
    if "feedback" in blocks:
        for by, names in (({}, ("cust_prev_red_lbl_cnt", "cust_prev_yellow_lbl_cnt", "cust_prev_labeled_cnt")),
                          (_by("event_desc"), ("cnt_prev_red_same_desc_lbl", "cnt_prev_yellow_same_desc_lbl",
                                               "cnt_prev_labeled_same_desc"))):
            for flag, name in zip(("is_red_lbl", "is_yellow_lbl", "is_labeled_fb"), names):
                out[name] = F.coalesce(asked.get(by, flag, "sum", F.col(flag)), F.lit(0)).cast("int")
        for flag, name in (("is_red_lbl", "_prev_red_ets"), ("is_yellow_lbl", "_prev_yel_ets")):
            out[name] = asked.get({}, f"{flag}_ets", "max", F.when(F.col(flag) == 1, F.col("ets")))
    return out


def customer_split(tl: DataFrame, blocks: tuple[str, ...] = C.ALL_BLOCKS, bucket_rows: int | None = None) -> DataFrame:
    """``customer.customer_features`` for customers of any size: no window holds more than about ``bucket_rows`` rows."""
    rows = bucket_rows or BUCKET_ROWS
    kind = dict(tl.dtypes)
    fields = ", ".join(f"{c}: {kind[c]}" for c in ["ets", "event_id", *_LAST] if c in kind)
    asked = _Asked()
    out = _prefix_columns(blocks, asked, f"struct<{fields}>")
    df = prefix_groups(tl, KEY, asked.listed(), bucket_rows=rows).withColumns(out)
    if "moving_avg" in blocks:
        df = with_halo(df, KEY, "cust_event_idx", max(C.MOVING_AVG_N), ["amt", "hour"], C.moving_avg_windows, rows)
    for d in C.derived_columns(blocks):
        df = df.withColumns(d)
    if "markov" in blocks:
        steps = _Asked()
        pair = {"_pc": _by("prev_mcc_code_i"), "_bc": _by("prev_mcc_code_i", "mcc_code_i")}
        cols = {name: F.coalesce(steps.get(by, "n", "sum", F.lit(1)), F.lit(0)) for name, by in pair.items()}
        df = prefix_groups(df, KEY, steps.listed(), bucket_rows=rows).withColumns(cols)
        for d in C._markov_derived():
            df = df.withColumns(d)
    keep = set(C.customer_features(tl, blocks).columns)
    return df.select(*[c for c in df.columns if c in keep])


def customer_block(tl: DataFrame, blocks: tuple[str, ...] = C.ALL_BLOCKS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """W and F: plain windows for customers of up to ``bucket_rows`` rows, the split plan for the others."""
    return by_rows(tl, KEY, bucket_rows, lambda df: C.customer_features(df, blocks),
                   lambda df: customer_split(df, blocks, bucket_rows))


def target_encoding_split(df: DataFrame, key: str, target: str = "target_bin", alpha: float = 10.0,
                          prior_rate: float | None = None, name: str | None = None,
                          bucket_rows: int | None = None) -> DataFrame:
    """F6 for customers of any size: ``customer.target_encoding`` over split groups."""
    name = name or f"te_{key}"
    y = F.col(target).cast(EXACT_AMOUNT)
    group = Group((F.col(key),), (Measure("_te_s", "sum", y, EXACT_AMOUNT),
                                  Measure("_te_n", "sum", F.col(target).isNotNull().cast("long"), "long")))
    rate = F.lit(float(prior_rate)) if prior_rate is not None else F.coalesce(F.col("_p"), F.lit(0.0))
    if prior_rate is None:
        days = C.daily_rate(df, target)
        df = df.join(days, df["event_date"] == days["_te_day"], "left").drop("_te_day")
    df = prefix_groups(df, KEY, [group], bucket_rows=bucket_rows)
    s, n = F.coalesce(F.col("_te_s").cast("double"), F.lit(0.0)), F.coalesce(F.col("_te_n"), F.lit(0))
    return df.withColumn(name, (s + alpha * rate) / (n + alpha)).drop("_te_s", "_te_n", "_p")


# ---------------------------------------------------------------- rolling

def _saved(df: DataFrame) -> DataFrame:
    """A lineage cut in front of a stream that reads its rows many times, each time some of their columns."""
    return stage(df, "rolling")


def _stream(rows: DataFrame, order: int, parts: list[tuple[Column, Column | None, dict[str, Column]]],
            types: dict[str, str]) -> DataFrame:
    """Stream rows of each event, from one scan: (time, condition, values) a part."""
    made = []
    for time, cond, values in parts:
        row = F.struct(time.alias("_t"), *[values.get(n, F.lit(None)).cast(kind).alias(n) for n, kind in types.items()])
        made.append(row if cond is None else F.when(cond, row))
    out = rows.select("customer_id", "event_id", F.explode(F.array(*made)).alias("_e")).where(F.col("_e").isNotNull())
    return out.select("customer_id", "event_id", "_e.*", F.lit(order).alias("_ord"), F.lit(0).alias("_q"))


def rolling_split(df: DataFrame, live: Column | None = None, bucket_rows: int | None = None) -> DataFrame:
    """``rolling.rolling_features`` for customers of any size, linear in rows whatever the windows' lengths."""
    names = df.columns
    # the stream has several rows an event: only what the windows read are columns of it, the others one struct
    df = packed(df.withColumn("_on", R._live(live)), ["_on", *ROLLED])
    on, live = F.col("_on"), F.col("_on")
    counted = on & F.col("mcc_code_i").isNotNull()
    before = Group((F.col("mcc_code_i"),), (Measure("_prev_same", "max", F.when(on, F.col("ets")), "long"),))
    df = _saved(prefix_groups(df, KEY, [before], bucket_rows=bucket_rows))
    events = df.where(on)
    t, one = F.col("ets"), F.lit(1).cast("long")
    specs = R._invertible_specs(live)
    span = {name: p for name, p, _, _ in specs} | dict(R.DISTINCT_WINDOWS)
    dtype = {name: "long" if kind == "count" else EXACT_AMOUNT for name, _, _, kind in specs} | {
        name: "long" for name, _ in R.DISTINCT_WINDOWS}
    weight = {name: w for name, _, w, _ in specs} | {name: F.when(counted, one) for name, _ in R.DISTINCT_WINDOWS}
    mx, day = R.MAX_WINDOW

    def late(p: int) -> Column:
        """The part begins later: the occurrence before still covers t."""
        return F.coalesce(F.col("_prev_same") + p > t, F.lit(False))

    stream = df.withColumns({"_t": t, "_ord": F.lit(0), "_q": F.lit(1)})
    starts = {f"_w_{n}": F.when(~late(p), weight[n]) if (n, p) in R.DISTINCT_WINDOWS else weight[n] for n, p in span.items()}
    parts = [(t, None, {**starts, "_mx": F.col("amt_abs")})]
    parts += [(t + p, None, {f"_w_{n}": -weight[n] for n, q in span.items() if q == p}) for p in sorted(set(span.values()))]
    parts += [(F.col("_prev_same") + p, late(p), {f"_w_{n}": weight[n]}) for n, p in R.DISTINCT_WINDOWS]
    types = {f"_w_{n}": kind for n, kind in dtype.items()} | {"_mx": "double"}
    stream = stream.unionByName(_stream(events, 1, parts, types), allowMissingColumns=True)
    # within one second: the questions first, so that only strictly earlier times count
    stream = stream.withColumn("_oid", F.struct("_ord", "event_id"))
    sums = Group((), tuple(Measure(f"_sum_{n}", "sum", F.col(f"_w_{n}"), dtype[n]) for n in span))
    ahead = Group((F.floor(F.col("_t") / day),), (Measure("_fore", "max", F.col("_mx"), "double"),))
    df = prefix_groups(stream, KEY, [sums, ahead], time_col="_t", id_col="_oid", bucket_rows=bucket_rows, saved=True)
    df = _saved(df.where("_q = 1").drop("_mx", "_oid", *[f"_w_{n}" for n in span]))

    # backward in time: values first, as the window holds t - p itself
    back = df.withColumns({"_t": -t, "_ord": F.lit(1), "_block": F.floor(t / day)})
    old = _stream(events, 0, [(-(t + day), None, {"_mx": F.col("amt_abs"), "_block": F.floor(t / day) + 1})],
                  {"_mx": "double", "_block": "long"})
    back = back.unionByName(old, allowMissingColumns=True).withColumn("_oid", F.struct("_ord", "event_id"))
    behind = Group((F.col("_block"),), (Measure("_back", "max", F.col("_mx"), "double"),))
    df = prefix_groups(back, KEY, [behind], time_col="_t", id_col="_oid", bucket_rows=bucket_rows, saved=True).where("_q = 1")

    cols = {}
    for n in span:
        s = F.col(f"_sum_{n}")
        if dtype[n] == "long":
            cols[n] = R._timed(F.coalesce(s, F.lit(0)), F.lit(0)).cast("int" if (n, span[n]) in R.DISTINCT_WINDOWS else "long")
        else:
            cols[n] = R._timed(F.coalesce(s.cast("double"), F.lit(0.0)), F.lit(0.0))
    cols[mx] = R._timed(F.greatest("_fore", "_back"), F.lit(None).cast("double"))
    df = df.withColumns(cols).drop("_t", "_ord", "_q", "_oid", "_mx", "_block", "_prev_same", "_fore", "_back",
                                   *[f"_sum_{n}" for n in span])
    made = [c for c in df.columns if c not in ("_on", "_row", *ROLLED)]
    df = df.select(*[F.col(c) if c in ROLLED else F.col(f"_row.`{c}`").alias(c) for c in names], *made)
    return df.withColumns(R.ratio_columns())


def rolling_block(df: DataFrame, method: str = "frame", live: Column | None = None, frame_rows: int = FRAME_ROWS) -> DataFrame:
    """Frames for customers of up to ``frame_rows`` rows, the linear split plan for the others."""
    return by_rows(df, KEY, frame_rows, lambda d: R.rolling_features(d, method, live),
                   lambda d: rolling_split(d, live, max(frame_rows, 1)))


# ---------------------------------------------------------------- profiles

def profiles_split(pretrain: DataFrame) -> DataFrame:
    """``priors.customer_profiles`` for customers of any size.

    The ranks within a customer come from one scan over its distinct amounts, dealt by range of
    (customer, amount); all else is a hash aggregate with partial sums.
    """
    amt = F.col("amt")
    counts = pretrain.where(amt.isNotNull()).groupBy(*KEY, "amt").agg(F.count(F.lit(1)).alias("n"))
    ranks = ordered_cumsum(counts, "amt", ["n"], KEY)
    size = counts.groupBy(*[F.col(k).alias("_c") for k in KEY]).agg(F.sum("n").alias("_n"))
    x = ranks.join(size, F.col("customer_id").eqNullSafe(F.col("_c"))).drop("_c")
    n = F.col("_n")

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("cum_n") < rank) & (rank <= F.col("cum_n") + F.col("n")), amt))

    picked = x.groupBy(F.col("customer_id").alias("_c")).agg(
        at(F.floor((n + 1) / 2)).alias("_lo"), at(F.ceil((n + 1) / 2)).alias("_hi"),
        at(F.round((n - 1) * P.PROFILE_QUANTILE, 0) + 1).alias("profile_amt_p95"))
    base = pretrain.groupBy(*KEY).agg(*P.profile_aggregates())
    prof = base.join(picked, F.col("customer_id").eqNullSafe(F.col("_c")), "left").withColumn(
        "profile_amt_median", (F.col("_lo") + F.col("_hi")) / 2)
    return P.profile_columns(prof)


def profile_block(pretrain: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """A1 and A2: rank windows for customers of up to ``bucket_rows`` rows, the range scan for the others."""
    return by_rows(pretrain, KEY, bucket_rows, P.customer_profiles, profiles_split)
