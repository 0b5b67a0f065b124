"""Exact quantiles, global and per key, in one way at every size and without a one-task merge.

1. Every column's values are counted (``groupBy(column, value)``: repeated values combine
   in the map tasks and collapse to one row).
2. The distinct values are range-partitioned by (column, value); each partition reports how
   many rows of each column it stands for.
3. Those sums say which partition holds each needed rank; only these partitions are
   ordered and summed up, each on its own, and give the one value asked for.

The quantile q of n values interpolates linearly between ranks floor((n-1)q) and
ceil((n-1)q), as ``percentile`` does.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harvestlens.session import stored


def global_quantiles(df: DataFrame, cols: list[str], qs: list[float]) -> dict:
    """{(col, q): exact quantile}; NULL and NaN are ignored, an empty column gives None."""
    pairs = [F.struct(F.lit(i).alias("k"), F.nanvl(F.col(c).cast("double"), F.lit(None)).alias("v"))
             for i, c in enumerate(cols)]
    counts = (df.select(F.inline(F.array(*pairs))).filter("v is not null")
              .groupBy("k", "v").agg(F.count(F.lit(1)).alias("c")))
    # written once: the partition numbers must stay as they are
    ranged = (counts.repartitionByRange("k", "v").withColumn("p", F.spark_partition_id())
              .checkpoint(eager=True))
    parts: dict[int, list[tuple[int, int]]] = {}
    for r in ranged.groupBy("k", "p").agg(F.sum("c").alias("c")).collect():  # a row per partition and column
        parts.setdefault(r["k"], []).append((r["p"], r["c"]))

    wanted = {}  # (column, rank) -> (partition, rank inside it)
    for k, _ in enumerate(cols):
        held = sorted(parts.get(k, []))
        n = sum(c for _, c in held)
        for q in qs if n else []:
            for rank in {math.floor((n - 1) * q), math.ceil((n - 1) * q)}:
                before = 0
                for p, c in held:
                    if rank < before + c:
                        wanted[k, rank] = (p, rank - before)
                        break
                    before += c
    found = {}
    if wanted:
        up_to = F.sum("c").over(Window.partitionBy("p", "k").orderBy("v"))
        summed = (ranged.filter(F.col("p").isin(sorted({p for p, _ in wanted.values()})))
                  .withColumn("s", up_to))
        hits = [(F.col("k") == k) & (F.col("p") == p) & (F.col("s") > at) & (F.col("s") - F.col("c") <= at)
                for (k, _), (p, at) in wanted.items()]
        by_place = {}
        for r in summed.filter(reduce(lambda a, b: a | b, hits)).select("k", "p", "v", "s", "c").collect():
            by_place.setdefault((r["k"], r["p"]), []).append(r)
        for (k, rank), (p, at) in wanted.items():
            found[k, rank] = next(r["v"] for r in by_place[k, p] if r["s"] - r["c"] <= at < r["s"])

    out: dict = {}
    for k, c in enumerate(cols):
        n = sum(x for _, x in parts.get(k, []))
        for q in qs:
            if not n:
                out[c, q] = None
                continue
            at = (n - 1) * q
            a, b = math.floor(at), math.ceil(at)
            va, vb = found[k, a], found[k, b]
            out[c, q] = va if a == b else (b - at) * va + (at - a) * vb
    return out


# ---- quantiles per key, from a table of value counts

BUCKETS = 64              # most value ranges a column is cut into
ROWS_PER_BUCKET = 200_000  # counted values from which a column gets another range


def value_counts(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """(keys, k, v, c): how often column number k has the value v under the keys; NULL and
    NaN are counted as a null value. One pass; repeated values combine in the map tasks."""
    pairs = [F.struct(F.lit(i).alias("k"), F.nanvl(F.col(c).cast("double"), F.lit(None)).alias("v"))
             for i, c in enumerate(cols)]
    return (df.select(*keys, F.inline(F.array(*pairs)))
            .groupBy(*keys, "k", "v").agg(F.count(F.lit(1)).alias("c")))


def value_ranges(counts: DataFrame) -> tuple[dict[int, list[float]], dict[int, int]]:
    """(bounds that cut each column's values into ranges of about equal numbers of rows of
    ``counts``, missing values per column), from one aggregate with one row per column."""
    shares = [i / BUCKETS for i in range(1, BUCKETS)]
    bounds, missing = {}, {}
    for r in counts.groupBy("k").agg(F.count("v").alias("n"), F.percentile_approx("v", shares, 10 * BUCKETS).alias("at"),
                                     F.sum(F.when(F.col("v").isNull(), F.col("c")).otherwise(0)).alias("missing")).collect():
        step = max(1, BUCKETS // max(1, -(-r["n"] // ROWS_PER_BUCKET)))
        bounds[r["k"]] = sorted(set((r["at"] or [])[step - 1::step]))
        missing[r["k"]] = r["missing"]
    return bounds, missing


def _range_of(bounds: dict[int, list[float]]):
    """Number of the range that v of column k falls into."""
    cut = {k: b for k, b in bounds.items() if b}
    if not cut:
        return F.lit(0)
    of = F.create_map(*[F.lit(x) for k, b in cut.items() for x in (k, b)])
    below = F.size(F.filter(of[F.col("k")], lambda x: x < F.col("v")))
    return F.greatest(F.coalesce(below, F.lit(0)), F.lit(0))


def keyed_quantiles(counts: DataFrame, keys: list[str], qs: list[float],
                    bounds: dict[int, list[float]] | None = None) -> DataFrame:
    """(keys, k, q0, q1, ...): exact quantiles of each column under each key, interpolated as
    ``percentile`` does; keys without a value have no row.

    ``counts`` as of :func:`value_counts`, possibly of finer keys; rows with a null key count
    for no key. No task holds a key: sums over the value ranges say in which of them a rank
    lies, and only those ranges' values are ordered. With ``bounds`` a key of any share of
    the rows is cut into as many parts as they say."""
    rows = counts.dropna(subset=[*keys, "v"]).select(*keys, "k", "v", "c", _range_of(bounds or {}).alias("b"))
    by = [*keys, "k"]
    sums = rows.groupBy(*by, "b").agg(F.sum("c").alias("s"))
    every = Window.partitionBy(*by)
    upto = every.orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = sums.select(*by, "b", "s", (F.sum("s").over(upto) - F.col("s")).alias("before"), F.sum("s").over(every).alias("n"))

    def at(q):
        return (F.col("n") - 1) * F.lit(float(q))

    ranks = [f(at(q)) for q in qs for f in (F.floor, F.ceil)]
    held = reduce(lambda a, b: a | b, [(x >= F.col("before")) & (x < F.col("before") + F.col("s")) for x in ranks])
    wanted = placed.filter(held).drop("s")
    up = Window.partitionBy(*by, "b").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = rows.join(wanted, [*by, "b"]).withColumn("t", F.col("before") + F.sum("c").over(up))

    def value(x):
        return F.max(F.when((x >= F.col("t") - F.col("c")) & (x < F.col("t")), F.col("v")))

    picked = seen.groupBy(*by, "n").agg(*[value(x).alias(f"_{i}") for i, x in enumerate(ranks)])
    out = []
    for i, q in enumerate(qs):
        low, high = F.col(f"_{2 * i}"), F.col(f"_{2 * i + 1}")
        exact = F.floor(at(q)) == F.ceil(at(q))
        out.append(F.when(exact, low).otherwise((F.ceil(at(q)) - at(q)) * low + (at(q) - F.floor(at(q))) * high).alias(f"q{i}"))
    return picked.select(*by, *out)


def quantile_columns(rows: DataFrame, keys: list[str], wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """(keys, one column per name): quantile q of a column under the keys, for ``wanted``
    {name: (column, q)}. The counts are written to the shared folder: ``rows`` is read once."""
    cols = sorted({c for c, _ in wanted.values()})
    qs = sorted({q for _, q in wanted.values()})
    counts = stored(value_counts(rows, keys, cols), "counts")
    bounds, _ = value_ranges(counts)
    by_column = keyed_quantiles(counts, keys, qs, bounds)
    return by_column.groupBy(*keys).agg(*[
        F.max(F.when(F.col("k") == cols.index(c), F.col(f"q{qs.index(q)}"))).alias(name)
        for name, (c, q) in wanted.items()])
