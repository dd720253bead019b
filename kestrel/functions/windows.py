"""Window specifications shared by the timeline operators.

Every per-customer spec starts with ``customer_id`` so that one hash
exchange on ``customer_id`` satisfies all of them (Spark only needs a
clustered distribution on a subset of the partition keys); each spec then
costs one sort, not one shuffle.  Order is always explicit:
``(event_ts, event_id)`` (T2).
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

ORDER = ("event_ts", "event_id")
CUSTOMER = "customer_id"
DEVICE = "device_fp_i"


def wc() -> WindowSpec:
    return Window.partitionBy(CUSTOMER).orderBy(*ORDER)


def wk(*keys: str | Column) -> WindowSpec:
    return Window.partitionBy(CUSTOMER, *keys).orderBy(*ORDER)


def prior(w: WindowSpec) -> WindowSpec:
    """Frame of all earlier rows, current row excluded."""
    return w.rowsBetween(Window.unboundedPreceding, -1)


def last_n(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-n, -1)


def whole(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def wr(seconds: int, key: str = CUSTOMER, time_col: str = "ets") -> WindowSpec:
    """Left-closed time range ``[t - seconds, t)`` over integer epoch seconds (T5)."""
    return Window.partitionBy(key).orderBy(time_col).rangeBetween(-seconds, -1)


def since(ts_now: Column, ts_prev: Column, missing: int = -1) -> Column:
    """Whole seconds between two epoch-second columns; ``missing`` when no previous."""
    return F.when(ts_prev.isNotNull(), ts_now - ts_prev).otherwise(F.lit(missing))
