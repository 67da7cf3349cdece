"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _down(edges: DataFrame) -> DataFrame:
    """Each link once, from the larger end ``u`` to the smaller end ``v``."""
    return (
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .where("u != v")
        .distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return r[0], r[1]


def connected_components(links: DataFrame, max_rounds: int = 50) -> DataFrame:
    """``u, v``: every linked node but the smallest of its component, and that smallest one.

    ``links`` has the columns ``u`` and ``v``.  Each round hangs every node
    under the smallest neighbour of its neighbours; the number of rounds grows
    with the logarithm of the longest path.  Links never leave the executors:
    minima are aggregated on the map side and joined back.  The side of the minima
    is grouped, so the optimizer cannot split that join: the links of a node with
    very many meet in one task there, as rows of two numbers, streamed.
    """
    edges = materialize(_down(links), "components")
    mark = _mark(edges)
    for _ in range(max_rounds):
        if not mark[0]:
            return edges
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.where("v > u").join(least, "u").select(
            F.col("v").alias("u"), F.least("u", "m").alias("v")
        )
        large = _down(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = materialize(
            _down(small.unionByName(least.withColumnRenamed("m", "v"))), "components"
        )
        last, mark, edges = mark, _mark(new), new
        if mark == last:
            return edges
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
