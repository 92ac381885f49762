"""Connected components of a graph given as pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import staged


def components(pairs: DataFrame) -> DataFrame:
    """Columns ``node`` and ``component``, the smallest node reachable by ``a, b``.

    Alternating star steps: every node hangs its larger neighbours on its
    smallest one, then its smaller ones; the number of rounds grows with the
    logarithm of a component's width. Each round goes to the shared folder. Only
    the test whether an edge changed reaches the driver.
    """
    edges = staged(
        pairs.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    while True:
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("low"))
        # Larger neighbours (and the node itself) to the smallest of all.
        large = (
            both.where("b > a")
            .join(low, "a")
            .select(F.col("b").alias("a"), F.least("low", "a").alias("b"))
            .union(low.where("low < a").select("a", F.col("low").alias("b")))
            .distinct()
        )
        # Every node now has smaller neighbours only; all go to the smallest.
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            large.join(low, "a")
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
            .where("a <> b")
            .union(low.select("a", F.col("low").alias("b")))
            .distinct()
        )
        after = staged(small, "edges")
        if after.select("b").distinct().join(
            after.select(F.col("a").alias("b")).distinct(), "b", "left_semi"
        ).isEmpty() and not _split(after):
            return after.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                after.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        edges = after


def _split(edges: DataFrame) -> bool:
    """Whether some node hangs on two others."""
    return not edges.groupBy("a").count().where("count > 1").isEmpty()
