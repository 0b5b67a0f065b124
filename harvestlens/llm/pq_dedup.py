"""Operator 3: near-duplicate embeddings with an inverted file of product-quantised residuals.

1. Equal vectors become one class with a multiplicity.
2. A bounded sample fits coarse centroids and, on the residuals, one codebook per subspace.
   Every vector is then indexed: its list, its codes, and its quantisation error.
3. Vectors of near lists are packed into groups of bounded size, one row a group, and inside
   a group into cells. Every pair of groups meets once, read from the packed table as often
   as it is needed: no vector is copied to disk for the lists it is compared with.
4. Two cells are compared along the line through their means. Along any line two vectors are
   no farther apart than they are, so those farther apart than the search radius there can't
   be a link, and the others form a band: no link is missed, in vectors of any shape.
5. What is left is bounded by the products in the few directions that hold most of the
   vectors, then by asymmetric distances to the decoded codes: a code farther than the radius
   plus its own quantisation error can't be a link. The rest is decided exactly by cosine in
   double precision.
A pair of groups returns sums of links and a spanning forest, never its pairs, so dense
groups cost rows in proportion to their size.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, materialize, read_table
from .components import components

THRESHOLD = 0.9
SAMPLE = 20_000       # rows, about, of the fit
MAX_LISTS = 1_000
SUBSPACES, CODES = 8, 256
REACH = 0.5  # from here on no link is missed
BLOCK = 2_048         # rows a group has room for, at least, unless they are very long
GROUP_BYTES = 4 << 20  # of vectors in a group, about, where there are many
GROUPS = 16           # at least, where they have room for more than BLOCK rows
CELL = 1_024           # rows of a cell, about
STRIP = 256           # rows of a cell compared at once
THIN = 24             # directions of the first bound, at least
CLOSE = 1e-12         # cosines so close to the threshold are summed pair by pair


def _kmeans(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    centre = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = _nearest(x, centre)
        for d in range(x.shape[1]):
            total = np.bincount(near, weights=x[:, d], minlength=k)
            count = np.bincount(near, minlength=k)
            centre[:, d] = np.where(count > 0, total / np.maximum(count, 1), centre[:, d])
    return centre


def _nearest(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), dtype=np.int64)
    half = (centre ** 2).sum(axis=1) / 2
    for a in range(0, len(x), 4096):
        out[a:a + 4096] = (half - x[a:a + 4096] @ centre.T).argmin(axis=1)
    return out


class Quantiser:
    """Coarse centroids and residual codebooks of unit vectors."""

    def __init__(self, sample: np.ndarray, n: int, threshold: float, reach: float, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.dim = sample.shape[1]
        self.sub = -(-self.dim // SUBSPACES)
        self.radius = math.sqrt(2 - 2 * threshold)
        self.margin = reach * self.radius
        lists = max(1, min(round(math.sqrt(n)), MAX_LISTS, len(sample) // 20))
        self.centre = _kmeans(sample, lists, 10, rng)
        rest = self._split(sample - self.centre[_nearest(sample, self.centre)])
        self.books = [_kmeans(rest[:, m], min(CODES, len(sample)), 8, rng) for m in range(SUBSPACES)]
        # the directions in which unit vectors are longest
        self.axes = np.linalg.eigh(sample.T @ sample)[1][:, ::-1][:, :max(THIN, self.dim // 12)]

    def _split(self, x: np.ndarray) -> np.ndarray:
        wide = np.zeros((len(x), SUBSPACES * self.sub))
        wide[:, :self.dim] = x
        return wide.reshape(len(x), SUBSPACES, self.sub)

    def index(self, x: np.ndarray, own: np.ndarray):
        """(codes, error) of each row of the lists ``own``."""
        rest = self._split(x - self.centre[own])
        codes = np.stack([_nearest(rest[:, m], b) for m, b in enumerate(self.books)], axis=1)
        back = np.stack([b[codes[:, m]] for m, b in enumerate(self.books)], axis=1)
        return codes.astype(np.uint8), np.sqrt(((rest - back) ** 2).sum(axis=(1, 2)))

    def decode(self, own: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """What the codes say of each row."""
        back = np.concatenate([b[codes[:, m]] for m, b in enumerate(self.books)], axis=1)
        return self.centre[own] + back[:, :self.dim]

    def thin(self, x: np.ndarray) -> np.ndarray:
        """Unit rows in few directions, and the length of what is left of them: products of
        such rows are no smaller than those of the rows."""
        short = x @ self.axes
        rest = np.sqrt(np.maximum(1 - (short ** 2).sum(axis=1), 0))
        return np.concatenate([short, rest[:, None]], axis=1).astype(np.float32)

    def places(self) -> np.ndarray:
        """The lists in an order that has near centroids side by side: halved again and again
        along the direction in which they differ most."""
        done, left = [], [np.arange(len(self.centre))]
        while left:
            part = left.pop()
            if len(part) <= 2:
                done.append(part)
            else:
                left += _halves(self.centre, part)[::-1]
        return np.concatenate(done)

    def probes(self, x: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Rows by lists: which lists a query searches (its own always)."""
        square = (self.centre ** 2).sum(axis=1)
        between = np.sqrt(np.maximum(square[:, None] + square - 2 * self.centre @ self.centre.T, 0))
        d = square - 2 * x @ self.centre.T
        # the distance to the boundary times 2 * between; with slack for rounding
        beyond = d - d[np.arange(len(x)), own][:, None]
        found = beyond <= 2 * self.margin * between[own] + 1e-9
        found[np.arange(len(x)), own] = True
        return found

    def met(self, x: np.ndarray, own: np.ndarray, y: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Of rows of x and y side by side: does one probe the other's list?"""
        u, v = self.centre[own], self.centre[other]
        most = 2 * self.margin * np.sqrt(((u - v) ** 2).sum(axis=1)) + 1e-9
        beyond = [((a - q) ** 2).sum(axis=1) - ((a - p) ** 2).sum(axis=1) for a, p, q in ((x, u, v), (y, v, u))]
        return (own == other) | (np.minimum(*beyond) <= most)


def _halves(x: np.ndarray, part: np.ndarray) -> list[np.ndarray]:
    """The rows ``part`` of x, halved along the direction in which they differ most."""
    y = x[part] - x[part].mean(axis=0)
    w = y[(y ** 2).sum(axis=1).argmax()]
    for _ in range(8):
        w = (y @ w) @ y
        w = w / max(np.sqrt(w @ w), 1e-300)
    order = np.argsort(y @ w, kind="stable")
    return [part[order[:len(part) // 2]], part[order[len(part) // 2:]]]


def _unit(column, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return _unit_rows(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim))


def _unit_rows(x: np.ndarray) -> np.ndarray:
    largest = np.abs(x).max(axis=1, keepdims=True)  # keeps the squares in range
    x = x / largest
    return x / np.sqrt((x ** 2).sum(axis=1, keepdims=True))


def _single(vectors: DataFrame) -> bool:
    """Is the embedding in single precision, so that it needs no more?"""
    return vectors.schema["embedding"].dataType.simpleString() == "array<float>"


def classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with h1, h2 where valid, one row per distinct valid vector)."""
    e = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("v"), F.col("embedding").alias("e"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = F.col("vec_id").isNotNull() & finite & F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("valid", F.coalesce(valid, F.lit(False)))
    rows = rows.withColumn("h1", F.when(F.col("valid"), F.xxhash64("v"))).withColumn(
        "h2", F.when(F.col("valid"), F.xxhash64(F.lit(1), F.reverse("v"))))
    distinct = rows.filter("valid").groupBy("h1", "h2").agg(
        F.min("vec_id").alias("i"), F.count(F.lit(1)).alias("m"),
        F.any_value("e" if _single(vectors) else "v").alias("v"))
    return rows.select("vec_id", "h1", "h2"), distinct.select("i", "h1", "h2", "m", "v")


def fit(distinct: DataFrame, n: int, dim: int, threshold: float = THRESHOLD, reach: float = REACH,
        sample: int = SAMPLE) -> Quantiser:
    """Fit on about ``sample`` rows, those with the lowest hash."""
    share = F.expr("shiftrightunsigned(xxhash64(h1, h2), 11)") / F.lit(2.0 ** 53)
    picked = distinct.filter(share * n < sample).select("h1", "h2", "v").orderBy("h1", "h2").toArrow()
    if not picked.num_rows:
        picked = distinct.select("h1", "h2", "v").orderBy("h1", "h2").limit(1).toArrow()
    return Quantiser(_unit(picked["v"], dim), n, threshold, reach)


def _forest(linked: np.ndarray, q_id: np.ndarray, s_id: np.ndarray):
    """Links (u, v) of vectors, numbered by id, that connect what the matrix connects."""
    n = int(max(q_id.max(), s_id.max())) + 1
    label = np.arange(n)
    q_on, s_on = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    part = linked[np.ix_(q_on, s_on)]
    while True:
        lq, ls = label[q_id[q_on]], label[s_id[s_on]]
        nq = np.minimum(lq, np.where(part, ls[None, :], n).min(axis=1))
        ns = np.minimum(ls, np.where(part, nq[:, None], n).min(axis=0))
        before = label.copy()
        np.minimum.at(label, q_id[q_on], nq)
        np.minimum.at(label, s_id[s_on], ns)
        label = label[label]
        if (label == before).all():
            break
    u = np.flatnonzero(label != np.arange(n))
    return u, label[u]


def _spanning(n: int, u: np.ndarray, v: np.ndarray):
    """Links (u, v) that connect the numbers below n as those given do."""
    label = np.arange(n)
    while True:
        lu, lv = label[u], label[v]
        if (lu == lv).all():
            break
        np.minimum.at(label, np.maximum(lu, lv), np.minimum(lu, lv))
        while (label[label] != label).any():
            label = label[label]
    u = np.flatnonzero(label != np.arange(n))
    return u, label[u]


OUT = "i long, h1 long, h2 long, links long, j long, g1 long, g2 long"
KEYS = ["i", "h1", "h2"]
# one row a group: numbers of its rows as bytes, and where its cells begin
GROUP = "g int, i binary, h1 binary, h2 binary, m binary, v binary, own binary, codes binary, error binary, cells binary"


def _cells(x: np.ndarray, place: np.ndarray):
    """(rows in order, where cells begin): lists of few rows share a cell, those of many are
    cut."""
    order = np.argsort(place, kind="stable")
    parts, low = [], 0
    for high in [*(np.flatnonzero(np.diff(place[order])) + 1).tolist(), len(order)]:
        if high - low >= CELL // 2 or high == len(order):
            parts.append(order[low:high])
            low = high
    done, left = [], parts[::-1]
    while left:
        part = left.pop()
        if len(part) <= 2 * CELL:
            done.append(part)
        else:
            left += _halves(x, part)[::-1]
    return np.concatenate(done), np.cumsum([0, *(len(p) for p in done)])


def _pack(quantiser: Quantiser):
    """The row of a group."""
    place = np.argsort(quantiser.places())

    def run(key, rows):
        x, own = _unit(rows["v"], quantiser.dim), rows["own"].to_numpy()
        order, cells = _cells(x, place[own])
        codes, error = quantiser.index(x[order], own[order])
        v = rows["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, quantiser.dim)
        blobs = {**{c: rows[c].to_numpy()[order] for c in (*KEYS, "m")}, "v": v[order], "own": own[order],
                 "codes": codes, "error": error, "cells": cells}
        return pa.table({"g": pa.array([key[0].as_py()], pa.int32()), **{c: pa.array([b.tobytes()], pa.binary()) for c, b in blobs.items()}})

    return run


class _Group:
    """A packed group, as one side of a meeting."""

    def __init__(self, row: dict, side: str, quantiser: Quantiser, single: bool):
        def blob(name, kind):
            return np.frombuffer(row[f"{side}_{name}"], kind)

        dim = quantiser.dim
        self.g = row[f"{side}_g"]
        self.keys, self.m = [blob(c, np.int64) for c in KEYS], blob("m", np.int64)
        self.v = blob("v", np.float32 if single else np.float64).reshape(-1, dim)
        self.own, self.cells = blob("own", np.int32), blob("cells", np.int64)
        self.codes, self.error = blob("codes", np.uint8).reshape(-1, SUBSPACES), blob("error", np.float64)
        n = len(self.v)
        self.near = np.empty((n, dim), np.float32)
        self.thin = np.empty((n, quantiser.axes.shape[1] + 1), np.float32)
        for k in range(0, n, 2048):  # few rows at a time in double precision
            x = self.rows(slice(k, k + 2048))
            self.near[k:k + 2048], self.thin[k:k + 2048] = x, quantiser.thin(x)
        self.mean = np.add.reduceat(self.near, self.cells[:-1]) / np.diff(self.cells)[:, None].astype(np.float32)

    def __len__(self) -> int:
        return len(self.v)

    def rows(self, at) -> np.ndarray:
        """Unit vectors in double precision."""
        return _unit_rows(self.v[at].astype(np.float64))

    def asked(self) -> np.ndarray:
        """The exact rows, and a column of ones for the bounds of the others."""
        return np.concatenate([self.near, np.ones((len(self.near), 1), np.float32)], axis=1)

    def stored(self, quantiser: Quantiser) -> np.ndarray:
        """The decoded rows, and what a product with an exact row has to reach: the distance
        is the radius plus the row's error at most. In single precision, so with some slack;
        the cosines decide."""
        out = np.empty((len(self), quantiser.dim + 1), np.float32)
        for k in range(0, len(self), 2048):
            at = slice(k, k + 2048)
            back = quantiser.decode(self.own[at], self.codes[at])
            least = (1 + (back ** 2).sum(axis=1) - (quantiser.radius + self.error[at]) ** 2) / 2
            out[at, :-1], out[at, -1] = back, 1e-4 + 2e-7 * quantiser.dim - least
        return out


def _bands(a: _Group, b: _Group, radius: float):
    """Of every pair of cells the rows of a and of b that may link: (strip of a, rows of b,
    are they of one cell?)."""
    slack = 1e-5 + 2e-7 * a.near.shape[1]
    # products of every row with its own mean and with those of the other side, by cell
    own_a, own_b = (np.concatenate([g.near[i:j] @ m for m, i, j in zip(g.mean, g.cells, g.cells[1:])]) for g in (a, b))
    other_a, other_b = b.mean @ a.near.T, a.mean @ b.near.T
    for p in range(len(a.mean)):
        between = np.sqrt(((a.mean[p].astype(np.float64) - b.mean) ** 2).sum(axis=1))
        a0, a1 = a.cells[p], a.cells[p + 1]
        for q in range(p if a is b else 0, len(b.mean)):
            b0, b1 = b.cells[q], b.cells[q + 1]
            if between[q] < 1e-3:
                for k in range(a0, a1, STRIP):
                    yield np.arange(k, min(k + STRIP, a1)), np.arange(b0, b1), a is b and p == q
                continue
            # along the line from b's mean to a's, times its length
            at_a = own_a[a0:a1] - other_a[q, a0:a1]
            at_b = other_b[p, b0:b1] - own_b[b0:b1]
            most = radius * between[q] + slack
            near_a = np.flatnonzero(at_a <= at_b.max() + most)
            if not len(near_a):
                continue
            near_b = np.flatnonzero(at_b >= at_a.min() - most)
            near_a = near_a[np.argsort(at_a[near_a])]
            near_b = near_b[np.argsort(-at_b[near_b])]
            found = np.searchsorted(-at_b[near_b], most - at_a[near_a[::STRIP]], side="right")
            for k, n in enumerate(found.tolist()):
                if not n:
                    break
                yield a0 + near_a[k * STRIP:(k + 1) * STRIP], b0 + near_b[:n], False


def _places(found: np.ndarray) -> np.ndarray:
    """Flat places of what is true; few are, so whole words are looked at first."""
    flat = found.ravel()
    if len(flat) % 8:
        return np.flatnonzero(flat)
    word = np.flatnonzero(flat.view(np.uint64))
    row, column = np.nonzero(flat.reshape(-1, 8)[word])
    return word[row] * 8 + column


def _meet(quantiser: Quantiser, threshold: float, single: bool):
    names = [c.split()[0] for c in OUT.split(", ")]
    narrow = quantiser.margin < quantiser.radius / 2
    least = np.float32(threshold - 1e-5 - 2e-7 * quantiser.dim)

    def links_of(a: _Group, b: _Group):
        """(links of a's rows, of b's rows, spanning links between them); b's rows are
        numbered after a's, or like them if it is the same group."""
        shift = 0 if a is b else len(a)
        total = shift + len(b)
        count, edges, held = np.zeros(total, dtype=np.int64), [], 0
        waiting: list[tuple] = []
        asked, stored = a.asked(), b.stored(quantiser)

        def tell(u, v):
            nonlocal edges, held
            edges.append((u, v))
            held += len(u)
            if held > 1 << 20:
                edges = [_spanning(total, *map(np.concatenate, zip(*edges)))]
                held = len(edges[0][0])

        def exact(ra, rb):
            for k in range(0, len(ra), 8192):
                u, v = ra[k:k + 8192], rb[k:k + 8192]
                some = np.einsum("ij,ij->i", asked[u], stored[v]) >= 0
                u, v = u[some], v[some]
                x, y = a.rows(u), b.rows(v)
                ok = np.einsum("ij,ij->i", x, y) >= threshold
                if narrow:
                    ok &= quantiser.met(x, a.own[u], y, b.own[v])
                u, v = u[ok], v[ok]
                if len(u):
                    np.add.at(count, u, b.m[v])
                    np.add.at(count, shift + v, a.m[u])
                    tell(u, shift + v)

        def dense(ra, rb, near):
            cosine = a.rows(ra) @ b.rows(rb).T
            close = near & (np.abs(cosine - threshold) <= CLOSE)
            exact(*(r[k] for r, k in zip((ra, rb), np.nonzero(close))))
            linked = near & (cosine >= threshold) & ~close
            if linked.any():
                np.add.at(count, ra, linked @ b.m[rb])
                np.add.at(count, shift + rb, a.m[ra] @ linked)
                at = np.concatenate([ra, shift + rb])
                unique, number = np.unique(at, return_inverse=True)
                u, v = _forest(linked, number[:len(ra)], number[len(ra):])
                tell(unique[u], unique[v])

        size = 0
        for ra, rb, inner in _bands(a, b, quantiser.radius):
            near = a.thin[ra] @ b.thin[rb].T >= least
            if inner:  # every pair once
                near &= ra[:, None] < rb
            at = _places(near)
            if len(at) > near.size // 16 and not narrow:  # many: as products of all
                near &= asked[ra] @ stored[rb].T >= 0
                at = _places(near)
                if len(at) > near.size // 16:
                    dense(ra, rb, near)
                    continue
            if not len(at):
                continue
            waiting.append((ra[at // len(rb)], rb[at % len(rb)]))
            size += len(at)
            if size > 1 << 16:
                exact(*map(np.concatenate, zip(*waiting)))
                waiting, size = [], 0
        if waiting:
            exact(*map(np.concatenate, zip(*waiting)))
        u, v = _spanning(total, *map(np.concatenate, zip(*edges))) if edges else (np.zeros(0, np.int64),) * 2
        return count, u, v

    def run(batches):
        a = None
        for batch in batches:
            for row in batch.to_pylist():
                if a is None or a.g != row["a_g"]:
                    a = _Group(row, "a", quantiser, single)
                b = a if row["b_g"] == a.g else _Group(row, "b", quantiser, single)
                count, u, v = links_of(a, b)
                keys = a.keys if a is b else [np.concatenate(k) for k in zip(a.keys, b.keys)]
                some = np.flatnonzero(count)
                null = [pa.nulls(len(some), pa.int64())] * 3
                yield pa.RecordBatch.from_arrays([*(pa.array(k[some]) for k in keys), pa.array(count[some]), *null], names)
                yield pa.RecordBatch.from_arrays([*(pa.array(k[u]) for k in keys), pa.nulls(len(u), pa.int64()),
                                                  *(pa.array(k[v]) for k in keys)], names)

    return run


def pack(distinct: DataFrame, quantiser: Quantiser, block: int = BLOCK) -> DataFrame:
    """The index: a row of ``GROUP`` for each group of vectors of near lists. A list that a
    group has no room for is dealt over several."""
    def assign(batches):
        for batch in (b.slice(k, 2048) for b in batches for k in range(0, b.num_rows, 2048)):
            own = _nearest(_unit(batch.column("v"), quantiser.dim), quantiser.centre)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int32))],
                                             [*batch.schema.names, "own"])

    kind = distinct.schema["v"].dataType
    listed = map_arrow(distinct.select(*KEYS, "m", "v"), assign,
                       f"i long, h1 long, h2 long, m long, v {kind.simpleString()}, own int")
    # a table of at most MAX_LISTS rows
    sizes = {r["own"]: r["count"] for r in listed.groupBy("own").count().collect()}
    width = quantiser.dim * (4 if kind.simpleString() == "array<float>" else 8)
    most = max(1, GROUP_BYTES // width)
    room = min(max(block, min(sum(sizes.values()) // GROUPS, most)), 4 * most)
    first, parts, g, held = {}, {}, 0, 0
    for k in (int(k) for k in quantiser.places() if int(k) in sizes):
        n = sizes[k]
        if held and held + n > room:
            g, held = g + 1, 0
        first[k], parts[k] = g, -(-n // room)
        g, held = (g + parts[k], 0) if n > room else (g, held + n)
    where = F.broadcast(distinct.sparkSession.createDataFrame(
        [(k, first[k], parts[k]) for k in first], "own int, first int, parts int"))
    # the parts of a large list are dealt by hash
    part = F.pmod(F.xxhash64("h1", "h2"), F.col("parts")).cast("int")
    return (listed.join(where, "own").withColumn("g", F.col("first") + part).drop("first", "parts")
            .groupBy("g").applyInArrow(_pack(quantiser), GROUP))


def links(distinct: DataFrame, quantiser: Quantiser, threshold: float = THRESHOLD,
          block: int = BLOCK) -> DataFrame:
    """Rows of ``OUT``: per pair of groups either (node, links) or (node, connected node)."""
    # a file for each group, so that a task needs to hold few of them
    packed = materialize(pack(distinct, quantiser, block), {"spark.sql.files.maxRecordsPerFile": "1"})
    groups = packed.count()
    few = packed.coalesce(max(GROUPS, groups // 8))
    sides = [few.select(*(F.col(c).alias(f"{side}_{c}") for c in few.columns)) for side in "ab"]
    pairs = sides[0].join(sides[1], F.col("a_g") <= F.col("b_g"))
    single = distinct.schema["v"].dataType.simpleString() == "array<float>"
    return materialize(map_arrow(pairs, _meet(quantiser, threshold, single), OUT),
                       {"spark.sql.execution.arrow.maxRecordsPerBatch": "1"})


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, reach: float = REACH,
                    sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links (other rows at cosine >= threshold), component_id (smallest vec_id
    reachable by links, its own included) and kept (vec_id = component_id) of every row.

    Vectors that are null, empty, zero or hold null or non-finite components, or whose vec_id
    is null link with nothing. Vectors of different lengths have no cosine; each length has
    an index of its own. Equal vectors link with each other. Rows that repeat a vec_id with different vectors are compared as
    rows of their own. Links are exact; with a ``reach`` below 0.5 pairs neither of whose
    ends probes the other's list are missed.
    """
    rows, distinct = classes(vectors)
    distinct = materialize(distinct)
    found = distinct.sparkSession.createDataFrame([], OUT)
    # one row per length of vectors
    for r in distinct.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy("dim").collect():
        same = distinct.filter(F.size("v") == r["dim"])
        if r["n"] > 1:
            found = found.union(links(same, fit(same, r["n"], r["dim"], threshold, reach, sample), threshold, block))
    count = found.filter("links is not null").groupBy("h1", "h2").agg(F.sum("links").alias("links"))
    edges = found.filter("links is null").select(F.struct("i", "h1", "h2").alias("u"), F.struct(
        F.col("j").alias("i"), F.col("g1").alias("h1"), F.col("g2").alias("h2")).alias("v"))
    comps = components(edges).select(F.col("node.h1").alias("h1"), F.col("node.h2").alias("h2"),
                                     F.col("component.i").alias("lowest"))
    table = (distinct.select("h1", "h2", "i", "m").join(count, ["h1", "h2"], "left")
             .join(comps, ["h1", "h2"], "left"))
    component = F.coalesce("lowest", "i", "vec_id")
    return (rows.join(table, ["h1", "h2"], "left")
            .select("vec_id", (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("m") - 1, F.lit(0))).alias("n_links"),
                    component.alias("component_id"),
                    F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept")))


def op3_pq_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))
