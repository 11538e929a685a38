"""Connected components of a graph whose edges are a table; nothing of it reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import drop_written, written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with an edge; a component's nodes share a root, one of them.

    Each round every node hooks onto its neighbour of smallest random rank, if that is below its own, and the
    edges shrink to those between different hooks. Random ranks make the number of rounds logarithmic for
    chains too. Each round's edges and roots are written, so a round never recomputes the one before.
    """
    left = written(edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
                   .where("a <> b").distinct(), "cc-edges")
    roots, turn = None, 0
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min(F.struct(F.xxhash64(F.lit(turn), "b").alias("rank"), "b")).alias("best"))
        own = F.struct(F.xxhash64(F.lit(turn), "a").alias("rank"), F.col("a").alias("b"))
        hooks = written(near.select("a", F.least(F.col("best"), own)["b"].alias("hook")), "cc-hooks")
        if roots is None:
            new_roots = hooks.select(F.col("a").alias("node"), F.col("hook").alias("root"))
        else:
            new_roots = written(roots.join(hooks.withColumnRenamed("a", "root"), "root", "left")
                                .select("node", F.coalesce("hook", "root").alias("root")), "cc-roots")
            drop_written(roots)
        to_a = hooks.select("a", F.col("hook").alias("ha"))
        to_b = hooks.select(F.col("a").alias("b"), F.col("hook").alias("hb"))
        less = written(left.join(to_a, "a").join(to_b, "b")
                       .select(F.least("ha", "hb").alias("a"), F.greatest("ha", "hb").alias("b"))
                       .where("a <> b").distinct(), "cc-edges")
        drop_written(left)
        left, turn = less, turn + 1
        roots = new_roots
        if turn > 1:
            drop_written(hooks)
    drop_written(left)
    if roots is None:
        return edges.sparkSession.createDataFrame([], "node long, root long")
    return roots
