"""Connected components of an edge list by alternating star rounds, until nothing changes.

Large-star / small-star rounds (Kiveris et al., "Connected Components in
MapReduce and Beyond", SoCC 2014). Each round is written to the shared folder
and read again; the loop ends when two rounds have the same edge count and the
same order-free hash sum. There is no bound on the rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import rewritten


def _both(e: DataFrame) -> DataFrame:
    return e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _stars(s: DataFrame) -> DataFrame:
    """Each node with the smallest of itself and its neighbours."""
    return s.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large(e: DataFrame) -> DataFrame:
    s = _both(e)
    return s.where("v > u").join(_stars(s), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(e: DataFrame) -> DataFrame:
    s = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    m = _stars(s)
    moved = s.join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(m.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge (u, v); component is the smallest node reachable."""
    e = rewritten(edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(),
                  "cc")
    state = _state(e)
    while state[0]:
        e = rewritten(_small(_large(e)), "cc")
        before, state = state, _state(e)
        if state == before:
            break
    # at the fix point every edge leads from a node to the root of its star
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
