"""Operator 10: shards cut from a Hilbert curve over the documents' metadata.

Every document becomes a point (size, source, lang), each dimension quantised to
2^bits cells; documents are ordered by the cell's index on the Hilbert curve, and the
order is cut into runs. Neighbours on the curve are neighbours in every dimension, so
each shard covers a small box and min/max statistics prune on any of the columns.

Only built-in columns and SQL functions are used. Texts are read once to take size and
checksum; everything after works on a metadata table of a few dozen bytes per document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize
from .ranks import rank_in_cells

DIMS, BITS = 3, 4


def _gray(i: int) -> int:
    return i ^ (i >> 1)


def curve_tables(n: int = DIMS) -> tuple[list[int], list[int], list[int]]:
    """Per sub-cube w of the n-cube in curve order: entry corner, direction of the
    intra-cube step; and the rank of each corner in Gray order."""
    size = 1 << n

    def trailing_ones(i: int) -> int:
        return ((i ^ (i + 1)).bit_length() - 1) if i & 1 else 0

    entry = [0] + [_gray(2 * ((w - 1) // 2)) for w in range(1, size)]
    turn = [0] + [(trailing_ones(w - 1) if w % 2 == 0 else trailing_ones(w)) % n for w in range(1, size)]
    rank = [0] * size
    for i in range(size):
        rank[_gray(i)] = i
    return entry, turn, rank


def hilbert_index(cells: list[Column], bits: int = BITS) -> Column:
    """Index of an integer point (each coordinate in 0 .. 2^bits - 1) on the curve.

    One fold over the bit levels, from the most significant; the state is the entry
    corner ``e`` and direction ``d`` of the current sub-cube."""
    n = len(cells)
    mask = (1 << n) - 1
    entry, turn, rank = (F.array(*[F.lit(v) for v in t]) for t in curve_tables(n))

    def rotate(x: Column, left: Column) -> Column:  # n-bit rotation by a column
        k = left % n
        up = F.call_function("shiftleft", x, k).bitwiseAND(F.lit(mask))
        return up.bitwiseOR(F.call_function("shiftright", x, F.lit(n) - k))

    def step(acc: Column, level: Column) -> Column:
        corner = reduce(lambda a, b: a + b, [
            F.call_function("shiftright", c, level).bitwiseAND(F.lit(1)) * (1 << j)
            for j, c in enumerate(cells)])
        local = rotate(corner.bitwiseXOR(acc["e"]), F.lit(n) - ((acc["d"] + 1) % n))
        w = F.get(rank, local)
        return F.struct(
            (acc["h"] * (1 << n) + w).cast("int").alias("h"),
            acc["e"].bitwiseXOR(rotate(F.get(entry, w), acc["d"] + 1)).cast("int").alias("e"),
            ((acc["d"] + F.get(turn, w) + 1) % n).cast("int").alias("d"))

    start = F.struct(F.lit(0).alias("h"), F.lit(0).alias("e"), F.lit(0).alias("d"))
    return F.aggregate(F.array(*[F.lit(i) for i in range(bits - 1, -1, -1)]), start, step)["h"]


def _ordinal(name: str, prefix: int) -> Column:
    """A long that orders strings as their bytes after the ``prefix`` shared characters
    (six bytes of them); null sorts first."""
    tail = F.substring(F.hex(F.encode(F.expr(f"substring({name}, {prefix + 1}, 6)"), "UTF-8")), 1, 12)
    return F.coalesce(F.conv(F.rpad(tail, 12, "0"), 16, 10).cast("long"), F.lit(-1).cast("long"))


def _shared_prefix(a: str | None, b: str | None) -> int:
    a, b = a or "", b or ""
    same = 0
    while same < min(len(a), len(b)) and a[same] == b[same]:
        same += 1
    return same


def _quantise(value: Column, bounds: list) -> Column:
    """Number of cut points at or below the value."""
    cuts = F.array(*[F.lit(int(b)).cast("long") for b in bounds])
    return F.size(F.filter(cuts, lambda c: c <= value))


def hilbert_shards(docs: DataFrame, shards: int = 40, bits: int = BITS) -> DataFrame:
    """Deal the documents into ``shards`` runs of the curve, sizes in rows at most one apart.

    Returns doc_id, lang, source, size (UTF-8 bytes + 16; null text: 16), text_crc32
    (null text: that of the empty text), cell (curve index), law = 'rows', shard, slot (place in the shard, gapless
    from 0) and grown_shard (null under this law).

    Cells are cut at quantiles of each dimension over all rows; source and lang enter by
    the order of their bytes after their common prefix. Inside a cell the order is that
    of a hash of (doc_id, text checksum, size): ties and repeated rows take consecutive
    or any slots, every row exactly one. Null metadata sorts before all values. With
    fewer rows than shards some shards stay empty; an empty table gives an empty result. Of a
    text of any length only its size and checksum are kept.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    meta = materialize(docs.select(
        "doc_id", "lang", "source",
        (F.octet_length(text).cast("long") + 16).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32")))
    # one small row of statistics over all rows: extremes of the strings ...
    low = meta.agg(*[f(c).alias(f"{n}_{c}") for c in ("source", "lang")
                     for n, f in (("min", F.min), ("max", F.max))]).first()
    value = {"size": F.col("size")} | {
        c: _ordinal(c, _shared_prefix(low[f"min_{c}"], low[f"max_{c}"])) for c in ("source", "lang")}
    # ... and the cut points of every dimension
    at = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = meta.agg(*[F.percentile_approx(v, at, 10_000).alias(c) for c, v in value.items()]).first()
    cells = [_quantise(v, cuts[c] or []) for c, v in value.items()]
    placed = materialize(meta.select("*", *[c.alias(f"_c{i}") for i, c in enumerate(cells)])
                         .withColumn("cell", hilbert_index([F.col(f"_c{i}") for i in range(len(cells))], bits))
                         .drop(*[f"_c{i}" for i in range(len(cells))]))
    ranked, counts = rank_in_cells(placed, "cell", [F.col("doc_id"), F.col("text_crc32"), F.col("size")])
    # at most 2^(3 * bits) cells: their running sum is a bounded window
    all_before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("cell", F.coalesce(F.sum("_n").over(all_before), F.lit(0)).alias("_start"),
                           F.sum("_n").over(Window.partitionBy()).alias("_total"))
    place = F.col("_start") + F.col("_rank")
    shard = F.expr(f"(_place * {shards}) div _total")
    first = F.expr(f"(_shard * _total + {shards} - 1) div {shards}")
    return (ranked.join(F.broadcast(starts), "cell")
            .withColumn("_place", place).withColumn("_shard", shard)
            .select("doc_id", "lang", "source", "size", "text_crc32", "cell",
                    F.lit("rows").alias("law"), F.col("_shard").cast("int").alias("shard"),
                    (F.col("_place") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard")))


def op10_hilbert_sharding(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return hilbert_shards(docs).drop("lang", "source")
