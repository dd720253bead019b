"""Attach a one-row aggregate (global mean, median, total) to every row.

The one-row side is broadcast (its size is one row by construction) and
joined on a constant, so the big side is never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Exact type of every running amount sum: 26 integer and 12 fractional digits,
#: so results do not depend on the order of summation or on the plan.
EXACT_AMOUNT = "decimal(38,12)"


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    g = "_one_row_key"
    small = F.broadcast(one_row.withColumn(g, F.lit(0)))
    return df.withColumn(g, F.lit(0)).join(small, g, "inner").drop(g)
