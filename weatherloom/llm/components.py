"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weatherloom.llm.scratch import Scratch, materialise


def connected_components(edges: DataFrame, keeper: Scratch | None = None) -> DataFrame:
    """(node, root) of every node of ``edges`` (columns ``a`` and ``b``, long).

    Each round maps every node to the neighbour, or itself, that comes first, and
    contracts the edges; the ends of an edge between different roots stay. The
    first round orders nodes by number, which finishes stars around their smallest
    node, later rounds by a new hash, so that a constant share of the nodes is
    expected to go in each and long chains take a logarithmic number of rounds.
    Every round is stored, so a lost executor repeats one round at most; all but the
    result is removed at the end. The result is one of ``keeper``'s tables, if given.
    """
    with Scratch(edges.sparkSession) as scratch:
        roots = _contracted(edges, scratch)
        return keeper.keep(roots, "roots") if keeper else materialise(roots, "roots")


def _contracted(edges: DataFrame, scratch: Scratch) -> DataFrame:
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    roots = nodes.select("node", F.col("node").alias("root"))
    turn = 0
    left = scratch.keep(edges.where("a <> b").select("a", "b"), "edges")
    while not left.isEmpty():
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = F.col("b") if turn == 0 else F.xxhash64("b", F.lit(turn))
        own = F.col("a") if turn == 0 else F.xxhash64("a", F.lit(turn))
        first = both.groupBy("a").agg(
            F.min(order).alias("order"), F.min_by("b", order).alias("b")
        )
        moves = scratch.keep(
            first.select("a", F.when(F.col("order") < own, F.col("b")).otherwise(F.col("a")).alias("to")),
            "moves",
        )
        roots = scratch.keep(
            roots.join(moves.withColumnRenamed("a", "root"), "root", "left").select(
                "node", F.coalesce("to", "root").alias("root")
            ),
            "roots",
        )
        left = scratch.keep(
            left.join(moves.select("a", F.col("to").alias("a2")), "a")
            .join(moves.select(F.col("a").alias("b"), F.col("to").alias("b2")), "b")
            .where("a2 <> b2")
            .select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b"))
            .distinct(),
            "edges",
        )
        turn += 1
    return roots
