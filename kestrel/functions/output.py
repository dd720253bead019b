"""Result normalisation for comparisons with the SQL oracle.

Integral columns become ``bigint``; fractional columns become ``double``
rounded to 6 places as ``round(x * 1e6) / 1e6`` (the same binary operation in
every engine, so exact-half cases agree; ``+ 0.0`` folds negative zero);
strings stay.  The oracle SQL applies the same rule to its own columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def normalize(df: DataFrame, digits: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, _INTEGRAL):
            cols.append(c.cast("long").alias(f.name))
        elif isinstance(f.dataType, _FRACTIONAL):
            scale = float(10 ** digits)
            cols.append((F.round(c.cast("double") * scale, 0) / scale + F.lit(0.0)).alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)
