"""Connected components of a link table, all in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..stage import Stage


def _state(links: DataFrame) -> tuple:
    """A fingerprint of the whole link table: its rows and the sum of their hashes."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, stage: Stage) -> DataFrame:
    """``node, root`` of every node that has a link ``a, b``; the root is the least node.

    Large and small star steps alternate until the links no longer change. Each step takes minima
    by partial aggregation and joins them back, so the neighbours of a node are never gathered, and
    is written to the stage, so a lost executor costs tasks, not steps.
    """
    now = stage.table(
        links.selectExpr("greatest(a, b) AS a", "least(a, b) AS b").filter("a <> b").distinct(),
        "links-0",
    )
    before, step = None, 0
    while (state := _state(now)) != before:
        before, step = state, step + 1
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").selectExpr("b AS a", "m AS b")
        large = stage.table(large.filter("a <> b").distinct(), f"large-{step}")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").selectExpr("b AS a", "m AS b").union(least)
        now = stage.table(small.filter("a <> b").distinct(), f"links-{step}")
    return now.selectExpr("a AS node", "b AS root").union(now.selectExpr("b", "b").distinct())
