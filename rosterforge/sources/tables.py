"""Stored lookups, manifests and site text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterforge import schemas
from rosterforge.sinks import versions


def place_lookup(spark: SparkSession, root: str) -> DataFrame:
    """Newest version of the place lookup, keyed by the hash of the query."""
    return versions.current(spark, root, schemas.PLACE)


def site_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Newest version of the site manifests, one row per site."""
    return versions.current(spark, root, schemas.SITE_MANIFEST)


def text_files(spark: SparkSession, path: str) -> DataFrame:
    """Stored page texts as `domain, file, ord, text`; the folder is the site.

    A page is one row, so its size is that of a page, not of a site.
    """
    name = F.col("_metadata.file_path")
    return spark.read.text(path, wholetext=True).select(
        F.element_at(F.split(name, "/"), -2).alias("domain"),
        F.element_at(F.split(name, "/"), -1).alias("file"),
        F.element_at(F.split(name, "/"), -1).alias("ord"),
        F.col("value").alias("text"),
    )
