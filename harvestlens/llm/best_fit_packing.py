"""Operator 2: pack documents into sequences by large-item matching and best fit.

1. Every text is tokenized where it lies; a document longer than the capacity is cut into
   full pieces and a rest. What goes on is one narrow row per piece.
2. The packing depends on lengths alone, and there are at most ``capacity`` lengths: the
   histogram over all pieces (a bounded table) decides how many bins of which content
   there are. Pieces above one third of the capacity are matched greedily, two to a bin
   at most; the smaller ones go, longest first, to the bin with the tightest gap.
3. Each piece gets its number among the pieces of its length (exact, without a global
   sort) and finds its bin and offset in the bounded plan.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, materialize, read_table
from .ranks import rank_in_cells
from .word_bpe import load

CAPACITY = 4096
END_ID = 1

PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long, text_hash long")


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID,
           vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, text_hash and, on
    request, the token ids themselves (``ids``, binary of little-endian uint32)."""
    end = int(end_id).to_bytes(4, "little")

    def cut(batches):
        bpe = load(str(vocabulary or vocabulary_path()))
        for batch in batches:
            doc, no, start, length, crc, sent, ids = [], [], [], [], [], [], []
            for d, h, text in zip(*(batch.column(i) for i in range(3))):
                whole = bpe.ids(text.as_py() or "") + end
                for k, at in enumerate(range(0, len(whole), 4 * capacity)):
                    part = whole[at:at + 4 * capacity]
                    doc.append(d.as_py())
                    no.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    sent.append(h.as_py())
                    if with_ids:
                        ids.append(part)
            columns = [pa.array(doc, pa.int64()), pa.array(no, pa.int32())] + [
                pa.array(x, pa.int64()) for x in (start, length, crc, sent)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "text_hash"]
            if with_ids:
                columns.append(pa.array(ids, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text"), "text")
    return map_arrow(rows, cut, PIECES + (", ids binary" if with_ids else ""))


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple]:
    """Allocations (length, first_rank, count, per_bin, first_bin, offset): the pieces of
    ``length`` numbered first_rank .. first_rank + count - 1 go to bins first_bin, ...,
    ``per_bin`` to a bin, starting at ``offset``. Bounded by the number of lengths and the
    splits between them, whatever the number of pieces."""
    left = {n: c for n, c in histogram.items() if c}
    plan: list[tuple] = []
    used = dict.fromkeys(left, 0)
    open_bins: list[tuple[int, int, int]] = []  # (gap, first bin, bins), sorted
    bins = 0

    def put(length, count, per_bin, first_bin, offset):
        plan.append((length, used[length], count, per_bin, first_bin, offset))
        used[length] += count
        left[length] -= count

    # large pieces: the longest with the longest partner that fits
    large = sorted(n for n in left if 3 * n > capacity)
    for n in reversed(large):
        while left[n]:
            at = bisect_left(large, min(n, capacity - n) + 1) - 1
            while at >= 0 and not left[large[at]]:
                at -= 1
            if at >= 0 and large[at] == n and left[n] == 1:
                at -= 1
                while at >= 0 and not left[large[at]]:
                    at -= 1
            partner = large[at] if at >= 0 else None
            if partner is None:
                k = left[n]
                put(n, k, 1, bins, 0)
                gap = capacity - n
            elif partner == n:
                k = left[n] // 2
                put(n, 2 * k, 2, bins, 0)
                gap = capacity - 2 * n
            else:
                k = min(left[n], left[partner])
                put(n, k, 1, bins, 0)
                put(partner, k, 1, bins, n)
                gap = capacity - n - partner
            if gap:
                insort(open_bins, (gap, bins, k))
            bins += k

    # small pieces: longest first, into the tightest gap that takes one
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            at = bisect_left(open_bins, (n, -1, -1))
            if at < len(open_bins):
                gap, first, k = open_bins.pop(at)
            else:
                gap, first, k = capacity, bins, -(-left[n] // (capacity // n))
                bins += k
            per = gap // n
            full = min(k, left[n] // per)
            if full:
                put(n, full * per, per, first, capacity - gap)
                if gap - per * n:
                    insort(open_bins, (gap - per * n, first, full))
            rest = k - full
            if rest and left[n]:  # the last pieces: fewer than fill one bin's gap
                m = left[n]
                put(n, m, m, first + full, capacity - gap)
                if gap - m * n:
                    insort(open_bins, (gap - m * n, first + full, 1))
                full, rest = full + 1, rest - 1
            if rest:
                insort(open_bins, (gap, first + full, rest))
    return plan


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID,
         vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """Place every piece of every document: the columns of ``pieces`` without text_hash,
    sequence_id and offset (long).

    Null and empty texts are the end token alone; very long texts are cut into full pieces. Rows that repeat a doc_id are documents
    of their own. Equal pieces take each other's places in arbitrary order. An empty
    table packs into no sequences.
    """
    cut = materialize(pieces(docs, capacity, end_id, vocabulary, with_ids))
    narrow = cut.select("*", F.col("length").cast("int").alias("cell"))
    ranked, counts = rank_in_cells(narrow, "cell", [F.col(c) for c in
                                                    ("doc_id", "piece", "ids_crc32", "text_hash")])
    # at most `capacity` rows
    histogram = {r["cell"]: r["_n"] for r in counts.collect()}
    plan = sorted(plan_packing(histogram, capacity))
    table = np.array(plan, dtype=np.int64).reshape(-1, 6)
    # (length, first_rank) as one sortable number per allocation
    first_of = {n: i for i, n in reversed(list(enumerate(table[:, 0].tolist())))}
    last_of = {n: i + 1 for i, n in enumerate(table[:, 0].tolist())}

    def place(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            row = np.empty(len(length), dtype=np.int64)
            for n in np.unique(length).tolist():
                mine = length == n
                part = table[first_of[n]:last_of[n], 1]
                row[mine] = first_of[n] + np.searchsorted(part, rank[mine], side="right") - 1
            _, start, _, per, first, offset = table[row].T
            k = rank - start
            kept = [c for c in batch.schema.names if c not in ("text_hash", "cell", "_rank")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept]
                + [pa.array(first + k // per), pa.array(offset + (k % per) * length)],
                kept + ["sequence_id", "offset"])

    kept = PIECES.replace(", text_hash long", "") + (", ids binary" if with_ids else "")
    return map_arrow(ranked, place, kept + ", sequence_id long, offset long")


def op2_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))
