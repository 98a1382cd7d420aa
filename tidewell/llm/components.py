"""Connected components of a graph held as edges, by alternating large-star and small-star rounds.

Each round is two aggregations and two joins, all by node. Minima are pre-aggregated before they are shuffled and the
joins have one unique side, so a node with very many neighbours is split like any skewed join. Nothing is collected
but two numbers a round; each half round ends in a table in the shared folder, and the one before it is removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm._common import discard, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (a > b). Large: neighbours above a node go to the least of its neighbourhood. Small: those below do."""
    if large:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        below = edges.select(
            F.col("a").alias("u"), F.col("b").alias("v"),
        ).join(least, "u").filter("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        out = below.unionAll(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (two long columns a, b, any order) but the roots; root is the component's least node.

    Edges of a node with itself and null ends are ignored; repeated edges count once. No edges, no rows.
    """
    now = written(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        seen = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if seen == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        large = written(_star(now, True), "large")
        before, old, now = seen, now, written(_star(large, False), "edges")
        discard(large)
        discard(old)
