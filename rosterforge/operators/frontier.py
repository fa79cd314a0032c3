"""Breadth-first page selection per site, capped, over stored links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterforge import fixed
from rosterforge.session import durable


def crawl(
    starts: DataFrame,
    links: DataFrame,
    loaded: DataFrame,
    max_depth: int = fixed.CRAWL_MAX_DEPTH,
    max_pages: int = fixed.CRAWL_MAX_PAGES,
) -> DataFrame:
    """Pages a first-in-first-out walk of every site visits: `domain, url, depth, pos, loaded`.

    ``starts``: `domain, start_url`; ``links``: as `follow_links` gives them;
    ``loaded``: `url` of every stored page, one row each.  A first-in-first-out
    queue works layer by layer, so each layer is one join of the last layer
    with the links.  A page belongs to the layer that sights it first, at the
    place of its first sighting (parent's place, then link order).  Pages past
    the cap are never visited, so every layer is cut before it is followed:
    a site brings at most ``max_pages`` rows into any join.
    """
    first = starts.select(
        "domain", F.col("start_url").alias("url"), F.lit(0).alias("depth"), F.lit(1).alias("pos"), F.lit(1).alias("used")
    )
    # layers are small and each is read several times later: written once,
    # so that no layer works out the earlier ones again
    layer = durable(_with_loaded(first, loaded), "layer")
    visited = layer
    for depth in range(1, max_depth + 1):
        parents = layer.where("loaded").select(
            "domain", F.col("url").alias("src"), F.col("pos").alias("parent"), "used"
        )
        allowed = links if depth == 1 else links.where("priority")
        sightings = (
            parents.join(allowed, ["domain", "src"])
            .groupBy("domain", F.col("dst").alias("url"))
            .agg(F.min(F.struct("parent", "ord")).alias("at"), F.max("used").alias("used"))
            .join(visited.select("domain", "url"), ["domain", "url"], "left_anti")
        )
        # the rank limit is applied per task before rows of a site meet
        site = Window.partitionBy("domain")
        found = (
            sightings.withColumn("_nth", F.row_number().over(site.orderBy("at")))
            .where(F.col("_nth") < max_pages)
            .withColumn("pos", F.col("used") + F.col("_nth"))
            .where(F.col("pos") <= max_pages)
            .select(
                "domain", "url", F.lit(depth).alias("depth"), "pos", F.max("pos").over(site).alias("used")
            )
        )
        layer = _with_loaded(found, loaded)
        if depth < max_depth:
            layer = durable(layer, "layer")
        visited = visited.unionByName(layer)
    return visited.drop("used")


def _with_loaded(layer: DataFrame, loaded: DataFrame) -> DataFrame:
    known = loaded.select("url", F.lit(True).alias("loaded"))
    return layer.join(known, "url", "left").select(
        "domain", "url", "depth", "pos", "used", F.coalesce("loaded", F.lit(False)).alias("loaded")
    )
