"""Connected components of a link table, as DataFrame jobs.

Alternating large-star and small-star rounds: every round replaces links by links to the
smallest neighbour, until each node points at the smallest node of its component. Rounds
needed grow with the logarithm of the number of nodes, chains included. A hub of any
degree is only ever aggregated with ``min`` or joined, never gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["s"]


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns u, v of one orderable type;
    either direction, repeats and loops allowed). component is the smallest node
    reachable. Nodes without a link to another node don't appear."""
    edges = materialize(links.filter("u is not null and v is not null and u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        # now every link leads down from u to v
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        edges = materialize(small)
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
