"""Windows cut in time: run and rolling operators that never hold a whole key.

A key's rows are cut into blocks of time. What one block must know of the others is small
and is folded in time order from one row per block:

* positions: rows per block, summed up, give every row its rank in the key;
* rolling sums: rows are dealt by rank into stretches of at least the window's length, and
  the last n-1 rows of each stretch are sent to the next one as a margin;
* runs: a block is summed up by its rows, the flagged rows at its start and at its end, its
  longest run and the flagged rows of long runs inside; two neighbours' summaries combine
  into the summary of both, whatever the cut.

No task sees more than a block (or a stretch and its margin) of a key, so a key of any
share of the rows, or of any length in time, is spread like others. Results equal those of
the window forms in ``runs`` and ``mart``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = 86_400
BLOCK_SECONDS = 30 * DAY
STRETCH_ROWS = 4096


def time_block(time_col: str, seconds: int = BLOCK_SECONDS) -> Column:
    """Number of the block that a date or time falls into."""
    return F.floor(F.unix_timestamp(F.col(time_col).cast("timestamp")) / F.lit(seconds))


def _ordered(keys: list[str], by: str, end: int) -> Window:
    return Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, end)


def positions(df: DataFrame, keys: list[str], order_col: str, seconds: int = BLOCK_SECONDS,
              out_col: str = "pos") -> DataFrame:
    """Rank of every row in its key, from 1 in time order."""
    cut = df.withColumn("__block", time_block(order_col, seconds))
    sizes = cut.groupBy(*keys, "__block").agg(F.count(F.lit(1)).alias("__n"))
    starts = sizes.select(*keys, "__block", F.coalesce(F.sum("__n").over(_ordered(keys, "__block", -1)), F.lit(0)).alias("__start"))
    inside = F.row_number().over(Window.partitionBy(*keys, "__block").orderBy(order_col))
    return (cut.withColumn("__rn", inside).join(_null_safe(starts, keys + ["__block"]), _on(cut, keys + ["__block"]))
            .withColumn(out_col, F.col("__start") + F.col("__rn"))
            .select(*df.columns, out_col))


def _null_safe(right: DataFrame, keys: list[str]) -> DataFrame:
    return right.withColumnsRenamed({k: f"__r_{k}" for k in keys})


def _on(left: DataFrame, keys: list[str]) -> Column:
    """Null keys are keys too, as in a window's partitions."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    return cond


def rolling_sum(df: DataFrame, keys: list[str], order_col: str, value_col: str, n: int, out_col: str,
                ndigits: int | None = None, seconds: int = BLOCK_SECONDS, stretch: int = STRETCH_ROWS) -> DataFrame:
    """As :func:`runs.rolling_sum`: the sum of the last ``n`` rows, where all have a value."""
    stretch = max(stretch, n)
    at = positions(df, keys, order_col, seconds, "__pos")
    no = F.floor((F.col("__pos") - 1) / stretch)
    # a row near its stretch's end also goes to the next stretch, as margin
    near_end = (F.col("__pos") - 1) % stretch >= stretch - (n - 1)
    dealt = at.withColumn("__s", F.explode(F.when(near_end, F.array(no, no + 1)).otherwise(F.array(no))))
    w = Window.partitionBy(*keys, "__s").orderBy("__pos").rowsBetween(-(n - 1), Window.currentRow)
    s = F.sum(value_col).over(w)
    if ndigits is not None:
        s = F.round(s, ndigits)
    return (dealt.withColumn(out_col, F.when(F.count(value_col).over(w) == F.lit(n), s))
            .filter(F.col("__s") == no).select(*df.columns, out_col))


def run_ids(df: DataFrame, keys: list[str], order_col: str, flag_col: str, seconds: int = BLOCK_SECONDS) -> DataFrame:
    """As :func:`runs.run_ids`: number of the row's run and, for flagged rows, its length."""
    cut = df.withColumn("__block", time_block(order_col, seconds))
    w = Window.partitionBy(*keys, "__block").orderBy(order_col)
    prev = F.lag(flag_col).over(w)
    rows = cut.withColumns({"__rn": F.row_number().over(w),
                            "__chg": F.when((F.col("__rn") > 1) & (prev.isNull() | (prev != F.col(flag_col))), 1).otherwise(0)})
    rows = rows.withColumn("__inside", F.sum("__chg").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    ends = rows.groupBy(*keys, "__block").agg(
        F.min_by(flag_col, "__rn").alias("__first"), F.max_by(flag_col, "__rn").alias("__last"),
        F.sum("__chg").alias("__n"))
    before = F.lag("__last").over(Window.partitionBy(*keys).orderBy("__block"))
    starts = ends.select(*keys, "__block", "__n",
                         F.when(before.isNull() | (before != F.col("__first")), 1).otherwise(0).alias("__new"))
    starts = starts.select(*keys, "__block", "__new", F.coalesce(
        F.sum(F.col("__n") + F.col("__new")).over(_ordered(keys, "__block", -1)), F.lit(0)).alias("__before"))
    numbered = (rows.join(_null_safe(starts, keys + ["__block"]), _on(rows, keys + ["__block"]))
                .withColumn("run_id", (F.col("__before") + F.col("__new") + F.col("__inside")).cast("long"))
                .select(*df.columns, "run_id"))
    lengths = numbered.groupBy(*keys, "run_id").agg(F.sum(flag_col).cast("long").alias("run_length"))
    return (numbered.join(_null_safe(lengths, keys + ["run_id"]), _on(numbered, keys + ["run_id"]))
            .select(*df.columns, "run_id", "run_length"))


# ---- run summaries

SUMMARY = "struct<n:bigint,head:bigint,tail:bigint,best:bigint,inner:bigint>"


def block_summaries(df: DataFrame, keys: list[str], order_col: str, flags: dict[str, tuple[Column, int]],
                    seconds: int = BLOCK_SECONDS) -> DataFrame:
    """One row per key and block with a summary struct per name of ``flags``: (condition,
    least length of a long run). n: rows; head, tail: flagged rows at the start and end;
    best: longest run; inner: rows of long runs that touch neither end."""
    cut = df.select(*keys, order_col, time_block(order_col, seconds).alias("__block"),
                    *[F.coalesce(c, F.lit(False)).alias(f"__f_{i}") for i, (c, _) in enumerate(flags.values())])
    w = Window.partitionBy(*keys, "__block").orderBy(order_col)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = cut.withColumn("__rn", F.row_number().over(w))
    pos, ends = {}, {}
    for i in range(len(flags)):
        f = F.col(f"__f_{i}")
        broken = F.max(F.when(~f, F.col("__rn"))).over(running)
        pos[f"__p_{i}"] = F.when(f, F.col("__rn") - F.coalesce(broken, F.lit(0))).otherwise(0)
        # the row after a run closes it; a run at the block's end has none
        ends[f"__e_{i}"] = F.lead(~f).over(w)
    rows = rows.withColumns(pos).withColumns(ends)
    n = F.count(F.lit(1))
    aggs = []
    for i, (name, (_, least)) in enumerate(flags.items()):
        f, p, closed = F.col(f"__f_{i}"), F.col(f"__p_{i}"), F.col(f"__e_{i}")
        gaps = F.when(~f, F.col("__rn"))
        long_inside = closed & (p >= least) & (p < F.col("__rn"))
        aggs.append(F.struct(
            n.alias("n"), F.coalesce(F.min(gaps) - 1, n).cast("long").alias("head"),
            F.coalesce(n - F.max(gaps), n).cast("long").alias("tail"), F.max(p).cast("long").alias("best"),
            F.coalesce(F.sum(F.when(f & long_inside, p)), F.lit(0)).cast("long").alias("inner")).alias(name))
    return rows.groupBy(*keys, "__block").agg(*aggs)


def combine(a: Column, b: Column, least: int) -> Column:
    """Summary of two neighbouring blocks, the earlier one first (associative)."""
    joint = a["tail"] + b["head"]
    # the run across the cut is inside if it reaches neither outer end
    inside = (a["tail"] < a["n"]) & (b["head"] < b["n"]) & (joint >= least)
    return F.struct(
        (a["n"] + b["n"]).alias("n"),
        F.when(a["head"] == a["n"], a["n"] + b["head"]).otherwise(a["head"]).alias("head"),
        F.when(b["tail"] == b["n"], b["n"] + a["tail"]).otherwise(b["tail"]).alias("tail"),
        F.greatest(a["best"], b["best"], joint).alias("best"),
        (a["inner"] + b["inner"] + F.when(inside, joint).otherwise(0)).alias("inner")).cast(SUMMARY)


def folded(summaries: DataFrame, keys: list[str], flags: dict[str, tuple[Column, int]]) -> DataFrame:
    """(keys, <name>_best, <name>_long): longest run and rows in long runs of every key. Only
    its blocks' summaries meet, in time order."""
    zero = F.lit(0).cast("long")
    empty = F.struct(*[zero.alias(c) for c in ("n", "head", "tail", "best", "inner")]).cast(SUMMARY)
    out = summaries.groupBy(*keys).agg(*[
        F.sort_array(F.collect_list(F.struct("__block", F.col(name).alias("s")))).alias(name) for name in flags])
    def fold(least):
        return lambda a, x: combine(a, x["s"], least)

    cols = []
    for name, (_, least) in flags.items():
        out = out.withColumn(name, F.aggregate(name, empty, fold(least)))
        s = F.col(name)
        edge = F.when(s["head"] >= least, s["head"]).otherwise(0) + F.when(
            (s["head"] < s["n"]) & (s["tail"] >= least), s["tail"]).otherwise(0)
        cols += [s["best"].alias(f"{name}_best"), (s["inner"] + edge).alias(f"{name}_long")]
    return out.select(*keys, *cols)


def run_summaries(df: DataFrame, keys: list[str], order_col: str, flags: dict[str, tuple[Column, int]],
                  seconds: int = BLOCK_SECONDS) -> DataFrame:
    """Longest run and rows in long runs per key, from blocks of time."""
    return folded(block_summaries(df, keys, order_col, flags, seconds), keys, flags)
