"""Null-handling expressions that reproduce pandas semantics on Spark.

pandas has one missing value (NaN); Spark has NULL and NaN, and ``NaN > 25``
is true in Spark. Sources turn NaN into NULL once (``nan_to_null``), then every
comparison used as a 0/1 flag goes through ``flag`` so that a missing operand
counts as "no hit".
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(cond: Column) -> Column:
    """Boolean condition with NULL treated as false."""
    return F.coalesce(cond, F.lit(False))


def nan_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Replace NaN by NULL in every floating column (or the given ones)."""
    float_types = (T.DoubleType, T.FloatType)
    targets = [f.name for f in df.schema.fields
               if isinstance(f.dataType, float_types) and (cols is None or f.name in cols)]
    if not targets:
        return df
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType))
                           for c in targets})


def rowwise_mean(cols: list[str | Column]) -> Column:
    """Mean across columns, skipping nulls; null when all are null."""
    cs = [_c(c) for c in cols]
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in cs])
    n = reduce(lambda a, b: a + b, [F.when(c.isNotNull(), F.lit(1)).otherwise(F.lit(0)) for c in cs])
    return F.try_divide(total, n.cast("double"))


def sum_or_zero(x: str | Column, zero_type: str = "double") -> Column:
    """pandas ``sum``: an all-null group sums to 0 (Spark gives NULL)."""
    return F.coalesce(F.sum(_c(x)), F.lit(0).cast(zero_type))
