"""Operator 12: prefix trie of conversations, rolled up by depth bands.

A conversation is a path from the textless root; every distinct sequence of first d turns
is a node. Nodes are found by a prefix sum of position-bound turn hashes, so that a
conversation of any length is cut over many tasks. Subtree sums go through bands of
``band`` levels: a node's value is sent to its ancestors inside its own band only (at most
``band`` rows). The tops of the bands form a tree that is ``band`` times flatter and is
rolled up in the same way, until one band is left; then the finished totals of band tops
are sent down to the band above them, level by level. A tree of depth D takes two times
log_band(D) rounds.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, materialize, read_table

BAND = 8
# turns of a conversation that one task sums up, conversation ids in one piece of a list
BLOCK, IDS_PER_PIECE = 1024, 1024
SHARED, FAMILY = 6, 100  # the contract's rebuilding rule

NODE = ["depth", "k1", "k2"]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos from 1, t1, t2, chars) of every turn, conversations in turn order.

    Null turns come first; rows of one turn number are ordered by a hash of role and text
    (a fixed order; equal rows can't be told apart). Null role or text is empty. Rows
    without conv_id belong to no conversation and are left out. The sort is by range over
    (conversation, turn, hash, row), so a long conversation spans several tasks.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("_turn"),
        F.xxhash64(role, text).alias("t1"), F.xxhash64(F.lit(1), text, role).alias("t2"),
        F.length(text).cast("long").alias("chars"), F.monotonically_increasing_id().alias("_row"))
    order = [F.col("_turn").asc_nulls_first(), F.col("t1"), F.col("t2"), F.col("_row")]
    # the part's number is kept in a table: positions are counted from it below
    parted = materialize(turns.repartitionByRange(F.col("conv_id"), *order)
                         .withColumn("_part", F.spark_partition_id()))
    sizes = parted.groupBy("conv_id", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("conv_id", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("conv_id", "_part").orderBy(*order)
    return (parted.withColumn("_k", F.row_number().over(inside))
            .join(starts, ["conv_id", "_part"])
            .select("conv_id", (F.col("_start") + F.col("_k")).alias("pos"), "t1", "t2", "chars"))


def rebuilt_turns(turns: DataFrame, shared: int = SHARED, family: int = FAMILY) -> tuple[DataFrame, DataFrame]:
    """The contract's conversations: the first h turns come from the family's first
    conversation. ``turns`` as of :func:`ordered_turns`. Returns (turns, conv_id of all)."""
    h = F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % shared
    own_ids = turns.select("conv_id").distinct().select(
        "conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    first = turns.filter(F.col("pos") < shared).select(F.col("conv_id").alias("base"), "pos", "t1", "t2", "chars")
    lent = own_ids.join(first, "base").filter("pos <= h").select("conv_id", "pos", "t1", "t2", "chars")
    # a short or absent first conversation lends fewer turns than h: own turns move up
    short = own_ids.join(first.groupBy("base").agg(F.max("pos").alias("_has")), "base", "left").select(
        "conv_id", "h", F.least(F.col("h"), F.coalesce("_has", F.lit(0))).alias("_lent"))
    own = turns.join(short, "conv_id").filter("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("_lent")).alias("pos"), "t1", "t2", "chars")
    return lent.union(own), own_ids.select("conv_id")


def path_keys(turns: DataFrame, conv_ids: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, depth, k1, k2, p1, p2, chars): the node that each conversation passes at
    each depth from 0, the root, with the key of the node before it (null at the root).

    A node's key hashes two sums of the turns' hashes, each turn's bound to its place. Sums
    run within blocks of ``block`` turns and start from the sums of the blocks before."""
    marked = turns.select("*", F.xxhash64("pos", "t1", "t2").cast("decimal(20,0)").alias("a"),
                          F.xxhash64("t2", "pos", "t1").cast("decimal(20,0)").alias("b"),
                          F.floor((F.col("pos") - 1) / block).alias("_block"))
    zero = F.lit(0).cast("decimal(38,0)")
    sums = marked.groupBy("conv_id", "_block").agg(F.sum("a").alias("sa"), F.sum("b").alias("sb"))
    before = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("conv_id", "_block", F.sum("sa").over(before).alias("a0"),
                         F.sum("sb").over(before).alias("b0")).filter("a0 is not null")
    w = Window.partitionBy("conv_id", "_block").orderBy("pos")

    def upto(c, start, frame):
        return (F.coalesce(F.sum(c).over(frame), zero) + F.coalesce(start, zero)).cast("decimal(38,0)")

    now, past = (w.rowsBetween(Window.unboundedPreceding, end) for end in (0, -1))
    run = (marked.join(starts, ["conv_id", "_block"], "left")
           .select("conv_id", "pos", "chars", upto("a", F.col("a0"), now).alias("sa"), upto("b", F.col("b0"), now).alias("sb"),
                   upto("a", F.col("a0"), past).alias("pa"), upto("b", F.col("b0"), past).alias("pb")))

    def key(depth, x, y):
        return F.xxhash64(depth, x, y), F.xxhash64(y, depth, x)

    d, up = F.col("pos").cast("long"), F.col("pos").cast("long") - 1
    k, p, r = key(d, F.col("sa"), F.col("sb")), key(up, F.col("pa"), F.col("pb")), key(F.lit(0).cast("long"), zero, zero)
    null = F.lit(None).cast("long")
    return run.select("conv_id", d.alias("depth"), k[0].alias("k1"), k[1].alias("k2"),
                      p[0].alias("p1"), p[1].alias("p2"), "chars").union(
        conv_ids.select("conv_id", F.lit(0).cast("long"), r[0], r[1], null, null, F.lit(0).cast("long")))


def subtree_sums(nodes: DataFrame, paths: DataFrame, values: list[str], band: int = BAND) -> DataFrame:
    """(conv_id, depth, sums of ``values``) over each node's subtree, itself included.

    ``nodes``: one row per node, named by its smallest member and depth, with the values.
    ``paths``: (conv_id, depth, rep): for each such member and depth the name of the node
    it passes there. See the module text for the way; both are read some times."""
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    total = [F.sum(v).alias(v) for v in values]

    def lift(rows, step, group, same):
        """Send each row's values to the nodes of ``step``'s level on its path: those in its
        own group of ``group`` depths, not below it (``same``), or those in the group before."""
        at = paths.filter(F.col("depth") % step == 0).select(
            F.col("conv_id").alias("c"), F.col("depth").alias("d"), "rep", F.floor(F.col("depth") / group).alias("g"))
        g = F.floor(F.col("depth") / group)
        here = rows.withColumn("_g", g if same else g - 1)
        on = [F.col("conv_id") == F.col("c"), F.col("_g") == F.col("g")]
        hit = here.join(at, on + ([F.col("d") <= F.col("depth")] if same else []))
        return hit.select(F.col("rep").alias("conv_id"), F.col("d").alias("depth"), *values) \
            .groupBy("conv_id", "depth").agg(*total)

    # up: values of each level's nodes, summed inside the level's bands
    partial, rows, step = [], nodes.select("conv_id", "depth", *values), 1
    while True:
        partial.append(materialize(lift(rows, step, step * band, True)))
        step *= band
        if step > deepest:
            break
        rows = partial[-1].filter(F.col("depth") % step == 0)
    # down: finished totals of the band tops are added to the band above each of them
    done = partial.pop()
    while partial:
        tops = done.filter("depth > 0")
        step //= band
        below = lift(tops, step // band, step, False)
        done = materialize(partial.pop().unionByName(below).groupBy("conv_id", "depth").agg(*total))
    return done


def _digests(batches):
    """SHA-256 of each node's list; its pieces come sorted, one after the other."""
    node, h = None, None

    def out(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate([pa.int64()] * 3 + [pa.string()])],
            NODE + ["ends_sha256"])

    for batch in batches:
        rows = []
        for *key, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if key != node:
                if node is not None:
                    rows.append((*node, h.hexdigest()))
                node, h = key, hashlib.sha256()
            else:
                h.update(b",")
            h.update(ids.encode())
        yield out(rows)
    if node is not None:
        yield out([(*node, h.hexdigest())])


def end_digests(ends: DataFrame, per_piece: int = IDS_PER_PIECE) -> DataFrame:
    """SHA-256 of the ascending ids that end at each node. Ids are joined to pieces of at
    most ``per_piece`` (an id range each) before they meet; a node's pieces are then hashed
    as they stream by, so no list is ever held whole."""
    pieces = ends.groupBy(*NODE, F.floor(F.col("conv_id") / per_piece).alias("_piece")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    in_order = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "_piece").select(*NODE, "ids")
    return map_arrow(in_order, _digests, "depth long, k1 long, k2 long, ends_sha256 string")


def trie(turns: DataFrame, conv_ids: DataFrame, band: int = BAND, block: int = BLOCK) -> DataFrame:
    """One row per node of the trie over the conversations ``conv_ids``, whose turns are
    (conv_id, pos, t1, t2, chars); a conversation may have none.

    Columns: conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256, as the contract has them. Without
    conversations there is no root and no row. Equal conversations share all their nodes.
    """
    paths = materialize(path_keys(turns, conv_ids, block))
    nodes = materialize(paths.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("chars").alias("chars")))
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"),
                                                 F.col("p2").alias("k2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = materialize(nodes.join(children, NODE, "left").fillna(0, ["n_children"]))
    # of the paths only those of the nodes' smallest members are climbed
    climbed = paths.join(nodes.select("conv_id").distinct(), "conv_id", "left_semi").select("conv_id", *NODE)
    rep = materialize(climbed.join(nodes.select(*NODE, F.col("conv_id").alias("rep")), NODE)
                      .select("conv_id", "depth", "rep"))
    sums = subtree_sums(nodes.select(
        "conv_id", "depth", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens")), rep, ["n_leaves", "saved_tokens"], band)
    last = paths.groupBy("conv_id").agg(F.max("depth").alias("depth"))
    ends = end_digests(paths.join(last, ["conv_id", "depth"]).select(*NODE, "conv_id"))
    parent = rep.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("rep").alias("parent_conv_id"))
    return (nodes.join(ends, NODE, "left").join(sums, ["conv_id", "depth"]).join(parent, ["conv_id", "depth"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")))


def op12_conversation_trie(spark, sf_dir: str) -> DataFrame:
    turns = materialize(ordered_turns(read_table(spark, sf_dir, "conversations")))
    return trie(*rebuilt_turns(turns))


# crc32 bit by bit, over the text's bytes (decimal digits)
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(s) + 1), lambda i: ascii(s[i])::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
    lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END))), 4294967295::BIGINT)"""

ORACLE = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_CRC} % {SHARED} AS h
  FROM (SELECT DISTINCT conv_id, conv_id::VARCHAR AS s FROM t)),
r AS (SELECT i.conv_id, 0 AS own, t.pos, t.role, t.text FROM ids i JOIN t ON t.conv_id = i.base AND t.pos <= i.h
  UNION ALL SELECT i.conv_id, 1, t.pos, t.role, t.text FROM ids i JOIN t ON t.conv_id = i.conv_id AND t.pos > i.h),
whole AS (SELECT i.conv_id, coalesce(list({{'role': r.role, 'text': r.text}} ORDER BY r.own, r.pos) FILTER (r.pos IS NOT NULL), []) AS turns
  FROM ids i LEFT JOIN r USING (conv_id) GROUP BY i.conv_id),
steps AS (SELECT conv_id, len(turns) AS n, turns, unnest(range(0, len(turns) + 1)) AS depth FROM whole),
path AS (SELECT conv_id, n, depth, turns[1:depth] AS node FROM steps),
nodes AS (SELECT min(conv_id) AS conv_id, depth, node, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
  FROM path GROUP BY depth, node),
kids AS (SELECT a.node, count(*) AS n_children FROM nodes a JOIN nodes b ON b.depth = a.depth + 1 AND b.node[1:a.depth] = a.node
  GROUP BY a.node),
named AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (node)),
climbed AS (SELECT *, unnest(range(0, depth + 1)) AS up FROM named),
sums AS (SELECT node[1:up] AS node, sum((n_children = 0)::BIGINT) AS n_leaves,
    sum((n_convs - 1) * CASE WHEN depth = 0 THEN 0 ELSE length(node[depth].text) END) AS saved_tokens
  FROM climbed GROUP BY 1)
SELECT a.conv_id, a.depth, p.conv_id AS parent_conv_id, a.n_convs, a.n_children, s.n_leaves::BIGINT AS n_leaves,
  s.saved_tokens::BIGINT AS saved_tokens, a.ends_sha256
FROM named a JOIN sums s ON s.node = a.node
LEFT JOIN named p ON p.depth = a.depth - 1 AND p.node = a.node[1:a.depth - 1]
"""
