"""Exact ranks inside bounded cells without a global sort and without a hot task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rank_in_cells(df: DataFrame, cell: str, order: list[Column], rows_per_task: int = 65_536
                  ) -> tuple[DataFrame, DataFrame]:
    """Number the rows of every cell from 0, in an order fixed by ``order``.

    ``cell`` takes a bounded number of integer values (lengths, curve cells). A cell may
    hold any share of the rows: it is cut into 2^b buckets by the leading bits of a hash
    of ``order``, with b chosen from the cell's own count so that a bucket holds about
    ``rows_per_task`` rows at every input size. Ranks are the bucket's offset plus the
    position inside the bucket. Rows equal in every ``order`` column get ranks in
    arbitrary order among themselves.

    Returns (rows with ``_rank`` (long), counts per cell ``(cell, _n)``). ``df`` is read
    three times; pass a table that is cheap to read.
    """
    counts = df.groupBy(cell).agg(F.count(F.lit(1)).alias("_n"))
    bits = counts.select(cell, F.greatest(
        F.lit(0), F.ceil(F.log2(F.col("_n") / F.lit(rows_per_task)))).cast("int").alias("_b"))
    # bits has one row per cell: the number of cells is bounded by the caller's quantiser
    h = df.withColumn("_h", F.xxhash64(*order)).join(F.broadcast(bits), cell)
    h = h.withColumn("_s", F.when(F.col("_b") == 0, F.lit(0).cast("long")).otherwise(
        F.expr("shiftrightunsigned(_h, 64 - _b)"))).drop("_b")
    per = h.groupBy(cell, "_s").agg(F.count(F.lit(1)).alias("_m"))
    before = Window.partitionBy(cell).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select(cell, "_s", F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(cell, "_s").orderBy("_h", *order)
    ranked = (h.join(offsets, [cell, "_s"])
              .withColumn("_rank", F.col("_off") + F.row_number().over(inside) - 1)
              .drop("_s", "_off", "_h"))
    return ranked, counts
