"""Standalone window operators: run ids, rolling sums, spine fill.

The mart builder computes runs without run ids (position in run); these
operators expose the row-level forms for callers that want them.

Precondition (as for the mart): one row per key and time step, i.e. a panel
aggregated from raw readings first. A window partition then holds one key's
calendar (years x steps), however large or skewed the raw data is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def run_ids(df: DataFrame, keys: list[str], order_col: str, flag_col: str) -> DataFrame:
    """Per row: ``run_id`` (1 + number of flag changes so far in the key) and
    ``run_length`` (number of flagged rows in the row's run; 0 for runs of
    unflagged rows)."""
    w = Window.partitionBy(*keys).orderBy(order_col)
    prev = F.lag(F.col(flag_col)).over(w)
    change = F.when(prev.isNull() | (prev != F.col(flag_col)), F.lit(1)).otherwise(F.lit(0))
    out = df.withColumn("__chg", change)
    out = out.withColumn("run_id", F.sum("__chg").over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("long"))
    wr = Window.partitionBy(*keys, "run_id")
    return (out.withColumn("run_length", F.sum(F.col(flag_col)).over(wr).cast("long"))
            .drop("__chg"))


def rolling_sum(df: DataFrame, keys: list[str], order_col: str, value_col: str, n: int,
                out_col: str, ndigits: int | None = None) -> DataFrame:
    """Sum of the last ``n`` rows (current included), defined only when all
    ``n`` values are present (pandas ``rolling(n, min_periods=n)``)."""
    w = Window.partitionBy(*keys).orderBy(order_col).rowsBetween(-(n - 1), Window.currentRow)
    s = F.sum(value_col).over(w)
    if ndigits is not None:
        s = F.round(s, ndigits)
    return df.withColumn(out_col, F.when(F.count(value_col).over(w) == F.lit(n), s))


def spine_fill(spine: DataFrame, counts: DataFrame, keys: list[str], cols: list[str],
               fill: int = 0) -> DataFrame:
    """All keys of ``spine`` with the count columns, missing -> ``fill``."""
    out = spine.join(counts, keys, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(fill)).cast("long") for c in cols})
