"""Connected components by repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wayline.session import materialize, union_rows


def connected_components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """`node`, `root` (smallest node reachable) of every node in `links` (`a`, `b`).

    `known` may give roots of earlier, fewer links. Each round takes the
    smallest root among a node and its neighbours, then the root of that root,
    until nothing changes; rounds are stored, so lineage stays short.
    """
    if known is not None:
        # Links between components that are already known, then the roots of their roots.
        r = known
        ends = links.join(r.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left")
        ends = ends.join(r.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left")
        between = ends.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).filter("a <> b").distinct()
        upper = connected_components(between).select(F.col("node").alias("root"), F.col("root").alias("top"))
        lone = upper.select(F.col("root").alias("node"), F.col("top").alias("root")).join(r.select("node"), "node", "left_anti")
        moved = r.join(upper, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
        return materialize(union_rows(moved, lone), "components")
    both = union_rows(links.select("a", "b"), links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both.distinct(), "component-links")
    roots = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root")).withColumnRenamed("a", "node"), "component-roots")
    while True:
        seen = both.join(roots.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("met"))
        step = roots.join(seen, "node").select("node", F.col("root").alias("old"), F.least("root", "met").alias("root"))
        jump = roots.select(F.col("node").alias("root"), F.col("root").alias("top"))
        step = materialize(step.join(jump, "root").select("node", "old", F.least("root", "top").alias("root")), "component-roots")
        roots = step.select("node", "root")
        if step.filter("old <> root").isEmpty():
            return roots
