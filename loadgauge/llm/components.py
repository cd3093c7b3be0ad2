"""Connected components by randomised contraction.

In each round every node moves to the node of lowest random rank among itself and its neighbours, and edges follow their ends.
Ranks are drawn anew each round, so the nodes that still have edges shrink by a constant factor on any graph, and the
tables never outgrow the edges. Minima are taken before the shuffle; a node with very many edges costs each task one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): nodes have the same root if a path joins them. No edges, no rows."""
    work = stage(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    moves: list[DataFrame] = []
    while not work.isEmpty():
        both = work.unionByName(work.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(len(moves))).alias("rank"), F.col(c).alias("node"))
        best = both.groupBy("a").agg(F.min(rank("b")).alias("best"))
        move = best.select(F.col("a").alias("node"), F.when(F.col("best") < rank("a"), F.col("best.node")).otherwise(F.col("a")).alias("root"))
        moves.append(move := stage(move, "moves"))
        for end in ("a", "b"):
            work = work.join(move, F.col(end) == F.col("node")).withColumn(end, F.col("root")).drop("node", "root")
        work = work.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        work = stage(work, "edges")
    if not moves:
        return work.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = moves[-1]
    for move in reversed(moves[:-1]):
        later = found.select(F.col("node").alias("root"), F.col("root").alias("last"))
        found = move.join(later, "root", "left").select("node", F.coalesce("last", "root").alias("root"))
    return stage(found, "components")
