"""Final records to the published tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterforge.operators import publish as p
from rosterforge.operators import selection
from rosterforge.session import durable
from rosterforge.sinks import buckets, versions

REVIEW_COLUMNS = ["daycare_id", "source", "author_name", "rating", "text", "published_time"]


@dataclass(frozen=True)
class Published:
    listings: DataFrame
    reviews: DataFrame
    assets: DataFrame
    enrichments: DataFrame
    drops: DataFrame
    uploads: DataFrame


def build(
    final: DataFrame,
    records: DataFrame,
    research: DataFrame,
    run_time: Column,
    public_base: str = "",
    limit: int | None = None,
) -> Published:
    """All tables of one run.  ``records`` brings `id` and `place`; ``limit``
    takes the first records before any of them is judged.

    ``final`` may carry its rows' positions as `_ord`.

    Rows are judged before anything is written, so a bad row costs only
    itself; children of an unpublished listing are left out.
    """
    final = selection.first_rows(final, limit, "daycare_id")
    if "_ord" in final.columns:  # of one id the last row wins
        final = p.latest(final, ["daycare_id"], [F.col("_ord").desc()]).drop("_ord")
        if "_ord" in records.columns:
            records = p.latest(records, ["id"], [F.col("_ord").desc()])
    whole = F.struct(*final.columns)
    reason = F.coalesce(p.publish_reason(whole, F.lit(None).cast("string")), p.number_reason(whole))
    judged = durable(final.withColumn("reason", reason), "final")
    good = judged.where(F.col("reason").isNull()).drop("reason")
    drops = judged.where(F.col("reason").isNotNull()).select(
        F.col("daycare_id").alias("id"), F.lit("publish").alias("step"), "reason"
    )
    listings = p.listing_rows(good, public_base)
    parents = good.select("daycare_id")
    owned = records.select(
        F.col("id").alias("daycare_id"),
        F.col("place.reviews").alias("reviews"),
        F.col("place.street_view_path").alias("street_view_path"),
    )
    uploads = p.upload_plan(good.join(owned.select("daycare_id", "street_view_path"), "daycare_id", "left"))
    return Published(
        listings,
        p.with_parent(p.review_rows(owned), parents),
        p.asset_rows(uploads, public_base),
        p.with_parent(p.enrichment_rows(research, run_time), parents),
        drops,
        uploads,
    )


def write(spark: SparkSession, tables: Published, root: str) -> dict[str, str]:
    """Next version of every table; running it twice changes nothing."""
    listings = p.upsert(
        versions.current(spark, f"{root}/daycares", tables.listings.schema),
        tables.listings, ["daycare_id"], [F.col("name")],
    )
    fresh_reviews = p.latest(tables.reviews, p.REVIEW_KEY, [F.col("ord").desc()]).select(*REVIEW_COLUMNS)
    reviews = p.upsert(
        versions.current(spark, f"{root}/daycare_reviews", fresh_reviews.schema),
        fresh_reviews, p.REVIEW_KEY, [F.col("text")],
    )
    assets = p.replace_slice(
        versions.current(spark, f"{root}/daycare_assets", tables.assets.schema), tables.assets
    )
    enrichments = p.upsert(
        versions.current(spark, f"{root}/daycare_enrichments", tables.enrichments.schema),
        tables.enrichments, ["daycare_id"], [F.col("updated_at")],
    )
    return {
        "daycares": versions.publish(listings, f"{root}/daycares"),
        "daycare_reviews": versions.publish(reviews, f"{root}/daycare_reviews"),
        "daycare_assets": versions.publish(assets, f"{root}/daycare_assets"),
        "daycare_enrichments": versions.publish(enrichments, f"{root}/daycare_enrichments"),
    }


def write_buckets(tables: Published, root: str, n_buckets: int = buckets.BUCKETS, keep: int = buckets.KEEP) -> dict[str, int | None]:
    """Like `write`, but rewrites only the buckets that the run touches; returns versions.

    Read with `buckets.current`.  A table keeps the number of buckets that it
    was made with.
    """
    size = {"n_buckets": n_buckets, "keep": keep}
    return {
        "daycares": buckets.upsert(tables.listings, f"{root}/daycares", ["daycare_id"], [F.col("name")], **size),
        "daycare_reviews": buckets.upsert(
            tables.reviews, f"{root}/daycare_reviews", p.REVIEW_KEY, [F.col("ord").desc()], REVIEW_COLUMNS, **size
        ),
        "daycare_assets": buckets.replace_slice(tables.assets, f"{root}/daycare_assets", "daycare_id", **size),
        "daycare_enrichments": buckets.upsert(
            tables.enrichments, f"{root}/daycare_enrichments", ["daycare_id"], [F.col("updated_at")], **size
        ),
    }
