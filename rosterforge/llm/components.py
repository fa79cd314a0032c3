"""Connected components of links, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.session import durable


def connected(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """`node, root` for every node of `edges` (columns `a`, `b`): root is the smallest node reachable.

    Alternates large-star and small-star rounds, which end in one star per
    component after about log2(nodes) squared rounds at worst.  A round is a
    pre-aggregated minimum per node and a join with it whose one side is unique;
    the minima are written ahead of the join, so that both of its sides have
    shuffles of their own, and a node with a third of all links is split by
    Spark.  Every round is written to the shared folder, which cuts the lineage.
    """
    links = durable(edges.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct(), "links")
    for _ in range(most_rounds):
        # settled: every node has one link upwards or is a root, so the links are stars
        ends = links.selectExpr("a AS node", "1 AS up", "0 AS down").union(links.selectExpr("b AS node", "0 AS up", "1 AS down"))
        ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if ends.where("up > 1 OR (up = 1 AND down = 1)").isEmpty():
            break
        links = durable(_small_star(durable(_large_star(links), "links-large")).distinct(), "links")
    else:
        raise RuntimeError("components did not settle")
    return links.selectExpr("a AS node", "b AS root").union(links.selectExpr("b AS node", "b AS root").distinct())


def _large_star(links: DataFrame) -> DataFrame:
    """Every node's larger neighbours to the smallest of its neighbours and itself."""
    both = links.union(links.selectExpr("b AS a", "a AS b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a", "least(a, m) AS m")
    return both.join(durable(least, "links-least"), "a").where("b > a").selectExpr("b AS a", "m AS b").where("a <> b")


def _small_star(links: DataFrame) -> DataFrame:
    """Every node's smaller neighbours, and itself, to the smallest of them."""
    least = durable(links.groupBy("a").agg(F.min("b").alias("m")), "links-least")
    return links.join(least, "a").selectExpr("b AS a", "m AS b").where("a <> b").union(least.selectExpr("a", "m AS b"))
