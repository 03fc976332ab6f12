"""Connected components of a link table, in rounds of joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import materialized


def _written(links: DataFrame) -> tuple[DataFrame, tuple]:
    """The links as a written table, with a fingerprint taken while writing."""
    seen = Observation()
    out = materialized(links.distinct().observe(
        seen, F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")), "links")
    got = seen.get
    return out, (got["n"], got["h"])


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) for every node of links ``(a, b)``.

    Each round hangs every neighbour of a node (itself included) on the smallest
    of them, first from its larger and then from its smaller neighbours;
    the rounds needed grow with the logarithm of the longest path. Every
    round is written to the shared folder, and the rounds end when one
    leaves the links as they are. The driver sees a fingerprint of each.
    """
    current, mark = _written(links.selectExpr("greatest(a, b) AS a", "least(a, b) AS b")
                             .filter("a <> b"))
    while mark[0]:
        both = current.union(current.selectExpr("b AS a", "a AS b"))
        smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        larger = both.filter("b > a").join(smallest, "a").selectExpr("b AS a", "low AS b")
        low = larger.groupBy("a").agg(F.min("b").alias("low"))
        hung = larger.join(low, "a").selectExpr("b AS a", "low AS b").filter("a <> b")
        before = mark
        current, mark = _written(hung.union(low.selectExpr("a", "low AS b")))
        if mark == before:
            break
    return (current.selectExpr("a AS node", "b AS component")
            .union(current.selectExpr("b AS node", "b AS component")).distinct())
