"""Connected components of an undirected graph by alternating star operations (Kiveris et al., 2014).

Every edge table stays distributed; each round is two aggregations of minima, which combine before their shuffle, and
two joins, whose hot nodes are joined by broadcast.  Minima and edges are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import meet, written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    """Link each node's larger neighbours to its smallest neighbour.  A node with many neighbours is hot here."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = written(both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "least", n)
    linked = meet(both, least, ["u"], "n").where(F.col("v") > F.col("u")).select(F.least("u", "m").alias("u"), "v")
    return written(linked.where(F.col("u") != F.col("v")).distinct(), "edges", n)


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    """Link each node's smaller neighbours, of which a large star leaves few, and the node to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").select(F.col("m").alias("u"), "v").unionByName(least.select(F.col("m").alias("u"), F.col("u").alias("v")))
    return written(linked.where(F.col("u") != F.col("v")).distinct(), "edges", n)


def components(edges: DataFrame, left: str, right: str, most: int = 60) -> DataFrame:
    """``node, root``: each node with an edge and the smallest node that it reaches.  Nodes are longs; loops and
    repeated edges are allowed, rows with a null are not edges."""
    pairs = edges.select(F.least(left, right).alias("u"), F.greatest(left, right).alias("v"))
    pairs = edges.sparkSession.createDataFrame([], "u long, v long").unionByName(
        pairs.where(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col("u") < F.col("v"))).distinct()
    )
    pairs = written(pairs, "edges")
    state = _state(pairs)
    for _ in range(most):
        if not state[0]:
            break
        pairs = _small_star(_large_star(pairs, state[0]), state[0])
        before, state = state, _state(pairs)
        if before == state:
            break
    else:
        raise RuntimeError(f"components have not settled in {most} rounds")
    return pairs.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(
        pairs.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    )
