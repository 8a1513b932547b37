"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released, written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One round: the neighbours above a node (large) or those below it and itself (small) go to its least neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.filter("b < a")
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    if large:
        out = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = both.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root): each node of (a, b) edges with the least node it reaches; nodes that are roots are absent.

    The lineage is cut every round by a table in the shared folder; the rounds grow with the logarithm of the
    longest path.  Loops and repeated edges do no harm.
    """
    now = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _state(now)
    if before[0] == 0:
        return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    for _ in range(most_rounds):
        # a forest of stars: nobody has two parents, and no parent has one
        if now.groupBy("a").count().filter("count > 1").isEmpty() and now.join(now.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            break
        now, used = written(_stars(_stars(now, True), False), "edges"), now
        released(used)
        after = _state(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components: the rounds didn't suffice")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
