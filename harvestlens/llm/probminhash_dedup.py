"""Operator 4: near-duplicate documents by ProbMinHash, banding and exact verification.

1. Signatures. Each distinct five-word shingle of a document is a Poisson process of
   arrivals at random registers, its rate the weight; a register keeps the earliest
   arrival. Processes stop at the latest time any register still waits for. Registers of
   two documents agree with the probability Jaccard of their weights. Links are by the
   plain Jaccard, so every shingle weighs 1, however often it is repeated: then the two
   are the same.
2. Documents of equal words form one class; classes meet in buckets of equal bands.
3. Every class is verified against its bucket's smallest member. In buckets that this does
   not join into one component, classes of different components are compared by
   signature, block by block. Those that come near to another meet once more with their
   shingle sets, and are verified where two blocks meet: a pair never becomes a row, two
   blocks tell at most one link for each component they join. Where near pairs are many,
   first each class's nearest are verified, as long as that joins many, then all that are
   left. A round reads only the buckets that the one before left split.
4. Verified links (Jaccard of the shingle sets at or above the threshold) are closed to
   components; the smallest document of each stays.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import KEY, doc_key, map_arrow, materialize, read_table, ship
from .components import components
from .textnum import U, groups, mix, sequence_hash, shingles, word_hashes

BANDS, ROWS = 32, 6
WIDTH, THRESHOLD = 5, 0.8
BLOCK = 512
BLOCK_SHINGLES = 1 << 20  # about as many shingles of a bucket go into one block
PAIRS_PER_NODE = 32.0  # above that, a round verifies the nearest pairs first
BROADCAST_ROWS = 1_000_000


def _node() -> Column:
    """A document as one value; the smallest is the one with the smallest doc_id."""
    return F.struct(F.col("_n").alias("n"), F.col("_d").alias("d"), F.col("_t").alias("t"))


def weighted_sets(texts: list[bytes], width: int = WIDTH):
    """(shingle, owner, count) with every owner's shingles once, plus word hashes, owners."""
    h, who = word_hashes(texts)
    s, owner = shingles(h, who, len(texts), width)
    order = np.lexsort((s, owner))
    s, owner = s[order], owner[order]
    new = np.ones(len(s), dtype=bool)
    new[1:] = (s[1:] != s[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return s[at], owner[at], np.diff(np.append(at, len(s))), h, who


def signatures(element: np.ndarray, owner: np.ndarray, weight: np.ndarray, n: int, m: int,
               at_once: int = 1 << 17) -> np.ndarray:
    """ProbMinHash registers (n x m, uint64) of n weighted sets given as one list.

    Processes advance together, one arrival a round, ``at_once`` of them at a time; a
    process leaves when its next arrival comes later than every register of its set."""
    earliest = np.full(n * m, np.inf)
    register = np.zeros(n * m, dtype=U)
    for low in range(0, len(element), at_once):
        e, o, w = (x[low:low + at_once] for x in (element, owner, weight))
        t = np.zeros(len(e))
        step = 0
        while len(e):
            step += 1
            draw = mix(e + U(step * 0xD1342543DE82EF95 % (1 << 64)))
            t = t - np.log((draw >> U(11)).astype(np.float64) * 2.0 ** -53 + 2.0 ** -54) / w
            last = earliest.reshape(n, m).max(axis=1)
            on = t < last[o]
            e, o, w, t, draw = e[on], o[on], w[on], t[on], draw[on]
            slot = o * m + (mix(draw) % U(m)).astype(np.int64)
            np.minimum.at(earliest, slot, t)
            won = earliest[slot] == t
            register[slot[won]] = e[won]
    return register.reshape(n, m)


def _in_groups(column):
    """(first row, texts as lower-cased UTF-8) of consecutive rows of bounded size: only one
    group is copied at a time."""
    sizes = [t.as_buffer().size if t.is_valid else 0 for t in column]
    for a, b in groups(sizes):
        yield a, [(t.as_py() or "").encode().lower() for t in column.slice(a, b - a)]


SIGNED = ("_n boolean, _d long, _t long, c1 long, c2 long, size int, bands array<long>, sig binary")


def signed(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, width: int = WIDTH) -> DataFrame:
    """Per document with words: identity, hash of its words (c1, c2), number of shingles,
    band keys, and the registers' low bytes for estimates."""
    m = bands * rows

    def run(batches):
        for batch in batches:
            for a, texts in _in_groups(batch.column(3)):
                n = len(texts)
                s, owner, _, h, who = weighted_sets(texts, width)
                reg = signatures(s, owner, np.ones(len(s)), n, m)
                size = np.bincount(owner, minlength=n)
                key = np.zeros((n, bands), dtype=U)
                for k in range(rows):
                    key = mix(key ^ reg.reshape(n, bands, rows)[:, :, k])
                some = np.flatnonzero(size)
                if not len(some):
                    continue
                key = np.ascontiguousarray(key[some]).view(np.int64)
                low = (mix(reg[some]) & U(255)).astype(np.uint8)
                take = batch.slice(a, n).select([0, 1, 2]).take(pa.array(some))
                yield pa.RecordBatch.from_arrays(
                    [take.column(0), take.column(1), take.column(2),
                     *(pa.array(sequence_hash(h, who, n, z)[some].view(np.int64)) for z in (1, 2)),
                     pa.array(size[some], pa.int32()),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1) * bands, pa.int32()),
                                              pa.array(key.ravel())),
                     pa.array([r.tobytes() for r in low], pa.binary())],
                    [c.split()[0] for c in SIGNED.split(", ")])

    return map_arrow(docs.select(F.col("doc_id").isNull().alias("_n"), *doc_key(), "text"), run, SIGNED)


def _shingle_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(node, set) of the wanted nodes, from the texts. The wanted side is broadcast if its
    counted rows are few; beyond that the texts meet it in an ordinary join."""
    few = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    rows = (docs.select(F.col("doc_id").isNull().alias("_n"), *doc_key(), "text")
            .join(few.select(F.col("node.n").alias("_n"), F.col("node.d").alias("_d"),
                             F.col("node.t").alias("_t")), ["_n", *KEY], "left_semi"))

    def run(batches):
        for batch in batches:
            for a, texts in _in_groups(batch.column(3)):
                s, owner, *_ = weighted_sets(texts, width)
                ends = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(texts)))))
                part = batch.slice(a, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(3)),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(s.view(np.int64)))],
                    ["_n", "_d", "_t", "set"])

    sets = map_arrow(rows, run, "_n boolean, _d long, _t long, set array<long>")
    # rows that repeat doc_id and text bring equal sets
    return sets.groupBy(_node().alias("node")).agg(F.any_value("set").alias("set"))


def verified(docs: DataFrame, pairs: DataFrame, threshold: float, width: int) -> DataFrame:
    """(u, v, jaccard) of the pairs (u, v) whose shingle sets are similar enough."""
    nodes = materialize(pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct())
    sets = materialize(_shingle_sets(docs, nodes, width))
    both = (pairs.join(sets.select(F.col("node").alias("u"), F.col("set").alias("su")), "u")
            .join(sets.select(F.col("node").alias("v"), F.col("set").alias("sv")), "v"))
    common = F.size(F.array_intersect("su", "sv"))
    return (both.withColumn("k", common)
            .select("u", "v", (F.col("k") / (F.size("su") + F.size("sv") - F.col("k"))).alias("jaccard"))
            .filter(F.col("jaccard") >= threshold))


def _near_in_length(a: Column, b: Column, threshold: float) -> Column:
    return F.least(a, b) >= threshold * F.greatest(a, b)


def _block_pairs(rows: DataFrame, parts: Column, *columns) -> DataFrame:
    """``rows`` (band, key, node, comp, size, sig, bands), each sent to all the pairs of blocks
    (i, j) that its own block is in: every two members of a bucket meet in one group of band,
    key, i, j. A bucket is cut into ``parts`` blocks by the node's hash, so that a group is
    bounded for buckets of any size."""
    rows = rows.withColumn("parts", parts.cast("int")).withColumn("b", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    # block b meets every block: it is sent to the pairs (b, x) and (x, b)
    return rows.withColumn("x", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "band", "key", F.least("b", "x").alias("i"), F.greatest("b", "x").alias("j"),
        (F.col("b") <= F.col("x")).alias("left"), "parts", "node", F.xxhash64("comp").alias("h"),
        "size", "sig", "bands", *columns).groupBy("band", "key", "i", "j")


def _near(table: pa.Table, threshold: float, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(left rows, right rows, share of equal registers of each two, those that come near) of
    one group of ``_block_pairs``; -1 for two of one component, that lie too far apart in
    length or that already met in a band before."""
    floor = threshold - 4 * math.sqrt(threshold * (1 - threshold) / m)
    sig = np.frombuffer(b"".join(table["sig"].to_pylist()), dtype=np.uint8).reshape(-1, m)
    comp = table["h"].to_numpy()
    size = table["size"].to_numpy()
    keys = table["bands"].combine_chunks().flatten().to_numpy().reshape(len(sig), -1)
    keys = keys[:, :table["band"][0].as_py()]  # those of the bands before
    same = table["i"][0].as_py() == table["j"][0].as_py()
    left = np.flatnonzero(table["left"].to_numpy(zero_copy_only=False))
    right = left if same else np.setdiff1d(np.arange(len(sig)), left)
    match = np.full((len(left), len(right)), -1.0)
    for row, a in enumerate(left.tolist()):
        on = np.flatnonzero((comp[right] != comp[a]) & ((right > a) | (not same)) & (
            np.minimum(size[right], size[a]) >= threshold * np.maximum(size[right], size[a])))
        on = on[~(keys[right[on]] == keys[a]).any(axis=1)]
        if len(on):
            match[row, on] = (sig[right[on]] == sig[a]).mean(axis=1)
    return left, right, match, match >= floor


def _with_near(rows: DataFrame, threshold: float, m: int, block: int = BLOCK) -> DataFrame:
    """The rows (band, key, c and those of ``_block_pairs``) that come near by signature to
    another component's in their bucket."""
    def run(table: pa.Table) -> pa.Table:
        left, right, _, near = _near(table, threshold, m)
        some = np.union1d(left[near.any(axis=1)], right[near.any(axis=0)])
        return table.select(["band", "key", "node"]).take(pa.array(some, pa.int64()))

    ship(rows.sparkSession)
    some = _block_pairs(rows, F.ceil(F.col("c") / block)).applyInArrow(run, rows.select("band", "key", "node").schema)
    return rows.join(some, ["band", "key", "node"], "left_semi")


def _joining(left: np.ndarray, right: np.ndarray, near: np.ndarray, comp: np.ndarray, ends: np.ndarray,
             elements: np.ndarray, threshold: float) -> tuple[list[int], list[int]]:
    """The links among the ``near`` pairs that join components (a forest): row ``r`` has the
    sorted set elements[ends[r]:ends[r + 1]]. Rows that links have joined are not compared."""
    label = np.unique(comp, return_inverse=True)[1]
    us, vs = [], []
    for row in np.flatnonzero(near.any(axis=1)).tolist():
        a = left[row]
        to = right[near[row]]
        to = to[label[to] != label[a]]
        if not len(to):
            continue
        own, n = elements[ends[a]:ends[a + 1]], ends[to + 1] - ends[to]
        starts = np.cumsum(n) - n
        theirs = elements[np.repeat(ends[to] - starts, n) + np.arange(n.sum())]
        at = np.minimum(np.searchsorted(own, theirs), len(own) - 1)
        common = np.add.reduceat((own[at] == theirs).astype(np.int64), starts)
        for v in to[common / (len(own) + n - common) >= threshold].tolist():
            if label[v] != label[a]:
                label[label == label[v]] = label[a]
                us.append(int(a))
                vs.append(v)
    return us, vs


def _cross_pairs(rows: DataFrame, sets: DataFrame, threshold: float, m: int, per_node: float,
                 block: int = BLOCK) -> DataFrame:
    """Links (u, v) between components, by verified pairs of a bucket's nodes that come near
    by signature; a pair that meets in several bands is verified in the first of them. Where
    two blocks have more than their share of ``per_node`` near pairs to each of the bucket's
    nodes, only those that are the nearest to one of the two are, and a pair of nulls says
    that there are others.

    rows: band, key, c and total (rows of the bucket and their shingles), node, comp, size,
    sig, bands. sets: node, set."""
    def run(table: pa.Table) -> pa.Table:
        left, right, match, near = _near(table, threshold, m)
        others = bool(near.sum() > per_node * table.num_rows / table["parts"][0].as_py())
        if others:
            nearest = np.zeros_like(near)
            nearest[np.arange(len(left)), match.argmax(axis=1)] = True
            nearest[match.argmax(axis=0), np.arange(len(right))] = True
            near &= nearest
        held = table["set"].combine_chunks()
        ends = held.offsets.to_numpy().astype(np.int64)
        us, vs = _joining(left, right, near, table["h"].to_numpy(), ends - ends[0],
                          held.flatten().to_numpy().view(U), threshold)
        place = table["comp"].combine_chunks()
        return pa.table({"u": place.take(pa.array([*us, *[None] * others], pa.int64())),
                         "v": place.take(pa.array([*vs, *[None] * others], pa.int64()))})

    ship(rows.sparkSession)
    kind = rows.schema["comp"].dataType.simpleString()
    parts = F.ceil(F.greatest(F.col("c") / block, F.col("total") / BLOCK_SHINGLES))
    return (_block_pairs(rows.join(sets, "node"), parts, "comp", "set").applyInArrow(run, f"u {kind}, v {kind}")
            .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())


def _still_split(placed: DataFrame) -> DataFrame:
    """The rows of buckets that lie in several components, with the bucket's rows (c) and
    their shingles (total)."""
    split = (placed.groupBy("band", "key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                               F.count(F.lit(1)).alias("c"), F.sum("size").alias("total"))
             .filter("lo != hi").select("band", "key", "c", "total"))
    return placed.drop("c", "total").join(split, ["band", "key"])


def _merged(df: DataFrame, comp: str, merged: DataFrame | None) -> DataFrame:
    """``df`` with the components of its column ``comp`` replaced by those they went into."""
    if merged is None:
        return df
    into = merged.select(F.col("node").alias(comp), F.col("component").alias("into"))
    return df.join(into, comp, "left").withColumn(comp, F.coalesce("into", comp)).drop("into")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(_d, _t, _n, node, class_node, n_shingles) of every document with words: ``node`` is
    the smallest document of equal words, ``class_node`` the smallest of the class."""
    sig = materialize(signed(docs, bands, rows, width))
    contents = materialize(sig.groupBy("c1", "c2").agg(
        F.min(_node()).alias("node"), F.any_value("size").alias("size"),
        F.any_value("bands").alias("bands"), F.any_value("sig").alias("sig")))
    buckets = contents.select("node", "size", F.posexplode("bands").alias("band", "key"))
    pivots = materialize(buckets.groupBy("band", "key").agg(
        F.min(F.struct("node", "size")).alias("p"), F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c"))
    members = materialize(buckets.join(pivots, ["band", "key"]))
    star = materialize(members.filter(F.col("node") != F.col("p.node"))
                       .filter(_near_in_length(F.col("size"), F.col("p.size"), threshold))
                       .select(F.col("p.node").alias("u"), F.col("node").alias("v")).distinct())
    links = materialize(verified(docs, star, threshold, width))
    comps = materialize(components(links.select("u", "v")))
    # every member meets its component once; the rounds go on with the buckets that are
    # still split and with links between components
    placed = materialize(members.join(comps, "node", "left").select(
        "node", "band", "key", "size", F.coalesce("component", "node").alias("comp")))
    split = materialize(_still_split(placed).join(contents.select("node", "sig", "bands"), "node"))
    open_rows = materialize(_still_split(_with_near(split, threshold, bands * rows)))
    nodes = materialize(open_rows.select("node").distinct())
    sets = materialize(_shingle_sets(docs, nodes, width))
    bridges, merged = None, None
    per_node = PAIRS_PER_NODE
    n = open_rows.count()
    while n:
        found = materialize(_cross_pairs(open_rows, sets, threshold, bands * rows, per_node))
        told = found.agg(F.count("u").alias("links"), F.count(F.lit(1)).alias("n")).first()
        others, new = told["n"] > told["links"], found.filter("u is not null")
        if told["links"]:
            bridges = new if bridges is None else bridges.union(new)
            merged = materialize(components(bridges))
        if not others:
            break
        if told["links"]:
            open_rows = materialize(_still_split(_merged(open_rows, "comp", materialize(components(new)))))
        before, n = n, open_rows.count()
        if n > before / 2:
            per_node = math.inf  # the nearest join little any more: all that are left
    placed = sig.select(*KEY, "_n", "c1", "c2", "size").join(contents.select("c1", "c2", "node"), ["c1", "c2"]).join(
        comps, "node", "left").withColumn("class_node", F.coalesce("component", "node"))
    return _merged(placed, "class_node", merged).select(
        "_n", *KEY, "node", "class_node", F.col("size").alias("n_shingles"))


def dedup(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as struct ``doc`` with class_id (smallest doc_id of the class of
    near duplicates), n_shingles (distinct) and kept.

    Exactly one row of every class is kept, the smallest by doc_id (null last), also where
    rows repeat doc_id and text. Null, empty and wordless texts have no shingles and are
    each a class of their own, always kept; texts of fewer than five words have one
    shingle of all words. Very long texts are hashed in segments; an empty table stays empty.
    """
    found = near_duplicates(docs, **options).distinct()
    rows = docs.select(*doc_key(), F.col("doc_id").isNull().alias("_n"), F.struct("*").alias("doc"))
    copies = Window.partitionBy("_n", *KEY).orderBy("_n", *KEY)
    return (rows.join(found, ["_n", *KEY], "left")
            .withColumn("copy", F.row_number().over(copies))
            .select("doc", *KEY, "_n", F.when(F.col("class_node").isNull(), F.col("doc.doc_id")).when(
                        ~F.col("class_node.n"), F.col("class_node.d")).alias("class_id"),
                    F.coalesce("n_shingles", F.lit(0)).alias("n_shingles"),
                    (F.col("class_node").isNull() | ((F.col("class_node") == _node()) & (F.col("copy") == 1))).alias("kept"))
            .drop(*KEY, "_n"))


def op4_probminhash_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, class_id, n_shingles, kept for every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup(docs).select("doc.doc_id", "class_id", "n_shingles", "kept")
