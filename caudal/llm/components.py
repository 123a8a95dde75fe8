"""Connected components of a graph given as edges, over distributed tables.

Large-star and small-star steps in turn: each links the neighbours of a node to the smallest one. The
number of steps grows with the logarithm of the longest path. A star's centre may have any number of
neighbours: its smallest neighbour is found by a pre-aggregated minimum, and rows get it by a
join that can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.shared import keyed_join, scope, staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link neighbours to the least of a node and its neighbours: larger ones, or the smaller and itself."""
    if large:
        edges = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    rows = keyed_join(edges, least, ["a"])
    if large:
        out = rows.filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        out = rows.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select("a", F.col("least").alias("b")))
    return out.filter("a != b").distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether each node is linked to one smaller node, which is linked to none itself; further steps would change nothing."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.filter("up > 1 OR up = 1 AND down = 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of all nodes of edges (a, b); the component is its smallest node."""
    with scope() as work:
        edges = staged(edges.filter("a != b").distinct())
        while True:
            last, edges = edges, staged(_star(_star(edges, large=True), large=False))
            work.drop(last)
            if _stars(edges):
                break
        roots = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
        return work.result(roots.unionByName(roots.select(F.col("component").alias("id"), "component").distinct()))


def refined(first: DataFrame, links: DataFrame) -> DataFrame:
    """(id, component) of the components `first` after further links (a, b) between their smallest nodes.

    A node that `first` does not have is a component of its own so far. Only the links are looked at, which are few.
    """
    if links.isEmpty():
        return first
    with scope() as work:
        second = components(links)
        alone = second.join(first.select(F.col("component").alias("id")).distinct(), "id", "left_anti")
        every = first.unionByName(alone.select("id", F.col("id").alias("component")))
        upper = second.select(F.col("id").alias("component"), F.col("component").alias("_upper"))
        joined = keyed_join(every, upper, ["component"], "left")
        return work.result(joined.select("id", F.coalesce("_upper", "component").alias("component")))
