"""Operator 8: remove repeated substrings, by prefix-free parsing.

1. Parse. Rolling-hash triggers cut every text into phrases, and every ``length``-byte
   string belongs to the trigger found in its first bytes, wherever it occurs. All strings
   of one trigger are the windows of its context: a left part (the end of the phrase
   before the trigger) and a right part (the phrases from the trigger on).
2. Triggers are keyed by a hash of the bytes right of them that all their windows share. A
   key seen once has no repeated window. A key seen only with one context has nothing but
   repeated windows.
3. For the rest, the distinct contexts of a key are sorted twice: by right part (the order
   of the parse's suffixes) and by reversed left part (the order of the dictionary's).
   With the common-prefix lengths of neighbours, two windows are equal just if they share
   both classes: of their left bytes in the one order and of their right bytes in the
   other. No position of the corpus is sorted one by one.
4. The repeated windows' bytes are merged per document and cut out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KEY, doc_key, map_arrow, materialize, read_table
from .phrases import SEGMENT, Hashes, parse
from .textnum import U, groups, mix

LENGTH = 200
SPAN = 150            # rolling hashes among which a string's trigger is chosen
GROUP_LIMIT = 20_000  # distinct contexts of a key compared in one task
BATCH = 20_000        # contexts handled at once

PARSED = "key long, ctx long, _d long, _t long, first long, span int, back int"


def _segments(column: pa.Array, length: int):
    """(rows, offsets, bytes, shift) pieces of a text column: many short texts together, a
    very long text in overlapping parts of SEGMENT starts."""
    sizes = [0 if not t.is_valid else t.as_buffer().size for t in column]
    for a, b in groups(sizes, SEGMENT):
        parts = [column[i].as_buffer().to_pybytes() if sizes[i] else b"" for i in range(a, b)]
        if b - a == 1 and sizes[a] > 2 * SEGMENT:
            text = np.frombuffer(parts[0], dtype=np.uint8)
            for at in range(0, max(sizes[a] - length + 1, 1), SEGMENT):
                part = text[at:at + SEGMENT + length - 1]
                yield np.array([a]), np.array([0, len(part)]), part, at
        else:
            yield (np.arange(a, b), np.cumsum([0, *sizes[a:b]]),
                   np.frombuffer(b"".join(parts), dtype=np.uint8), 0)


def parsed(docs: DataFrame, length: int = LENGTH, span: int = SPAN) -> DataFrame:
    """One row per trigger: key, hash of the context, document, place of the first window,
    number of further windows, and the trigger's distance from the first."""
    shared = length - span + 1

    def run(batches):
        for batch in batches:
            for rows, offsets, data, shift in _segments(batch.column(2), length):
                text, trigger, first, last, h0, h1 = parse(data, offsets, length, span)
                if not len(text):
                    continue
                back = trigger - first
                with np.errstate(over="ignore"):
                    ctx = mix(h1.of(first, last + length) + back.astype(U))
                take = batch.select([0, 1]).take(pa.array(rows[text]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h0.of(trigger, trigger + shared).view(np.int64)), pa.array(ctx.view(np.int64)),
                     take.column(0), take.column(1), pa.array(first - offsets[text] + shift),
                     pa.array((last - first).astype(np.int32)), pa.array(back.astype(np.int32))],
                    [c.split()[0] for c in PARSED.split(", ")])

    return map_arrow(docs.select(*doc_key(), "text"), run, PARSED)


def _contexts(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes (left, right) of the wanted contexts, from one document of each."""
    per_doc = wanted.groupBy("rep._d", "rep._t").agg(
        F.collect_list(F.struct("key", "ctx", "n", "rep.first", "rep.span", "rep.back")).alias("w"))
    rows = per_doc.join(docs.select(*doc_key(), "text"), KEY).select("text", "w")
    schema = "key long, ctx long, n long, span int, back int, left binary, right binary"

    def run(batches):
        for batch in batches:
            for text, w in zip(batch.column(0), batch.column(1)):
                data = text.as_buffer().to_pybytes()
                out = []
                for c in w.as_py():
                    at = c["first"] + c["back"]
                    out.append((c["key"], c["ctx"], c["n"], c["span"], c["back"],
                                data[c["first"]:at], data[at:c["first"] + c["span"] + length]))
                names = [x.split()[0] for x in schema.split(", ")]
                types = [pa.int64()] * 3 + [pa.int32()] * 2 + [pa.binary()] * 2
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names)

    # rows that repeat doc_id and text bring the same contexts
    return map_arrow(rows, run, schema).dropDuplicates(["key", "ctx"])


def _matrix(parts: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join([p.ljust(width, b"\0") for p in parts]), dtype=np.uint8).reshape(-1, width)


def _sorted_with_common(group: np.ndarray, rows: np.ndarray):
    """Order of the rows by (group, bytes), and with how many bytes each begins like the
    one before it (-1 at the start of a group)."""
    head = group.astype(">u4").view(np.uint8).reshape(-1, 4)
    full = np.ascontiguousarray(np.concatenate((head, rows), axis=1))
    order = np.argsort(full.view(f"V{full.shape[1]}").ravel(), kind="stable")
    sorted_rows, sorted_group = rows[order], group[order]
    differ = sorted_rows[1:] != sorted_rows[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    common[sorted_group[1:] != sorted_group[:-1]] = -1
    return order, np.concatenate(([-1], common))


def repeated_offsets(group: np.ndarray, back: np.ndarray, span: np.ndarray, left: list[bytes],
                     right: list[bytes], length: int = LENGTH, width: int = SPAN) -> np.ndarray:
    """For every context and t the truth of: its window beginning t bytes left of the
    trigger stands in another context of its group too (contexts of a group differ)."""
    by_right, common_right = _sorted_with_common(group, _matrix(right, length))
    by_left, common_left = _sorted_with_common(group, _matrix([x[::-1] for x in left], width))
    n = len(group)
    out = np.zeros((n, width), dtype=bool)
    suffix, phrase = np.empty(n, np.int64), np.empty(n, np.int64)
    for t in range(width):
        on = np.flatnonzero((t <= back) & (t >= back - span))
        if len(on) < 2:
            continue
        suffix[by_right] = np.cumsum(common_right < length - t)
        phrase[by_left] = np.cumsum(common_left < t)
        _, where, count = np.unique(phrase[on] * (n + 1) + suffix[on], return_inverse=True, return_counts=True)
        out[on, t] = count[where] > 1
    return out


RUNS = "key long, ctx long, lo int, hi int"


def _runs(table: pa.Table, length: int, span: int) -> pa.RecordBatch:
    back, wide = table["back"].to_numpy(), table["span"].to_numpy()
    group = np.unique(table["key"].to_numpy(), return_inverse=True)[1].astype(np.uint32)
    found = repeated_offsets(group, back, wide, table["left"].to_pylist(), table["right"].to_pylist(),
                             length, span)
    found &= (table["n"].to_numpy() == 1)[:, None]  # the others are repeated whole
    edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, begin = np.nonzero(edge == 1)
    end = np.nonzero(edge == -1)[1] - 1
    keys, ctxs = table["key"].to_numpy()[row], table["ctx"].to_numpy()[row]
    return pa.RecordBatch.from_arrays(
        [pa.array(keys), pa.array(ctxs), pa.array((back[row] - end).astype(np.int32)),
         pa.array((back[row] - begin).astype(np.int32))], ["key", "ctx", "lo", "hi"])


def _compare(contexts: DataFrame, length: int, span: int) -> DataFrame:
    """Repeated windows lo .. hi (from the context's first) of contexts seen once; whole
    groups lie in one partition, a bounded number of contexts is held at a time."""
    def run(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < BATCH:
                continue
            table = pa.Table.from_batches(held)
            key = table["key"].to_numpy()
            cut = np.flatnonzero(key[1:] != key[:-1])
            if len(cut):  # the last group may go on in the next batch
                at = int(cut[-1]) + 1
                yield _runs(table.slice(0, at), length, span)
                held = table.slice(at).to_batches()
                rows = table.num_rows - at
        if rows:
            yield _runs(pa.Table.from_batches(held), length, span)

    return map_arrow(contexts.repartition("key").sortWithinPartitions("key"), run, RUNS)


def _compare_large(contexts: DataFrame, length: int) -> DataFrame:
    """The same for groups too large for one task: their windows are counted by hash, and
    the count combines in the map tasks."""
    schema = "key long, ctx long, n long, lo int, w0 long, w1 long"

    def run(batches):
        for batch in batches:
            for key, ctx, n, span, back, left, right in zip(*(batch.column(i).to_pylist() for i in range(7))):
                data = np.frombuffer(left + right, dtype=np.uint8)
                lo = np.arange(span + 1)
                w = [Hashes(data, k).of(lo, lo + length).view(np.int64) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(lo), x, np.int64)) for x in (key, ctx, n)]
                    + [pa.array(lo.astype(np.int32)), pa.array(w[0]), pa.array(w[1])],
                    [x.split()[0] for x in schema.split(", ")])

    windows = map_arrow(contexts, run, schema)
    again = windows.groupBy("key", "w0", "w1").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    return (windows.filter("n = 1").join(again, ["key", "w0", "w1"], "left_semi")
            .select("key", "ctx", "lo", F.col("lo").alias("hi")))


def repeated_spans(docs: DataFrame, length: int = LENGTH, span: int = SPAN,
                   group_limit: int = GROUP_LIMIT) -> DataFrame:
    """(_d, _t, a, b): byte ranges [a, b) of the documents that are covered by strings of
    ``length`` bytes starting at more than one place; ranges may overlap."""
    rows = parsed(docs, length, span)
    again = (rows.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("ctx").alias("x"), F.max("ctx").alias("y"))
             .filter("c > 1").select("key", (F.col("x") != F.col("y")).alias("mixed")))
    places = materialize(rows.join(again, "key"))
    whole = places.filter("not mixed").select(*KEY, "first", (F.col("first") + F.col("span")).alias("last"))
    mixed = places.filter("mixed")
    kinds = materialize(mixed.groupBy("key", "ctx").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(*KEY, "first", "span", "back")).alias("rep")))
    contexts = materialize(_contexts(docs, kinds, length))
    large = materialize(kinds.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter(
        F.col("c") > group_limit).select("key"))
    runs = kinds.filter("n > 1").select("key", "ctx", F.lit(0).alias("lo"), F.col("rep.span").alias("hi"))
    if large.isEmpty():
        runs = runs.union(_compare(contexts, length, span))
    else:
        runs = runs.union(_compare(contexts.join(large, "key", "left_anti"), length, span)).union(
            _compare_large(contexts.join(large, "key", "left_semi"), length))
    part = mixed.join(materialize(runs), ["key", "ctx"]).select(
        *KEY, (F.col("first") + F.col("lo")).alias("first"), (F.col("first") + F.col("hi")).alias("last"))
    return whole.union(part).select(*KEY, F.col("first").alias("a"), (F.col("last") + length).alias("b"))


RESULT = ("n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def substring_dedup(docs: DataFrame, length: int = LENGTH, span: int = SPAN,
                    group_limit: int = GROUP_LIMIT, with_bytes: bool = False) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that also starts elsewhere.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 and on
    request ``kept`` (the remaining bytes; cuts may fall inside a UTF-8 character).

    All occurrences go, the first included, judged on the input; matches never cross
    documents. Null and empty texts have 0 bytes. Rows that repeat doc_id and text are
    places of their own, so both lose what they share; both get the same result row.
    """
    spans = repeated_spans(docs, length, span, group_limit).groupBy(*KEY).agg(
        F.collect_list(F.struct("a", "b")).alias("spans"))
    rows = (docs.select("doc_id", *doc_key(), "text").join(spans, KEY, "left")
            .select(F.col("doc_id").cast("long"), "text", F.col("spans.a").alias("a"), F.col("spans.b").alias("b")))

    def run(batches):
        for batch in batches:
            out = []
            for text, a, b in zip(*(batch.column(i) for i in (1, 2, 3))):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                keep, spans, at = [], 0, 0
                if a.is_valid:
                    start, end = a.values.to_numpy(), b.values.to_numpy()
                    order = np.argsort(start, kind="stable")
                    start, reach = start[order], np.maximum.accumulate(end[order])
                    new = np.flatnonzero(np.concatenate(([True], start[1:] > reach[:-1])))
                    spans = len(new)
                    for s, e in zip(start[new].tolist(), reach[np.append(new[1:], len(start)) - 1].tolist()):
                        keep.append(data[at:s])
                        at = e
                keep.append(data[at:])
                kept = b"".join(keep)
                out.append((len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
            columns = [batch.column(0)] + [pa.array([r[i] for r in out], t) for i, t in enumerate(
                [pa.int64()] * 3 + [pa.string()] + [pa.binary()] * with_bytes)]
            yield pa.RecordBatch.from_arrays(
                columns, ["doc_id"] + [c.split()[0] for c in RESULT.split(", ")] + ["kept"] * with_bytes)

    return map_arrow(rows, run, "doc_id long, " + RESULT + (", kept binary" if with_bytes else ""))


def op8_prefix_free_dedup(spark, sf_dir: str) -> DataFrame:
    return substring_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
