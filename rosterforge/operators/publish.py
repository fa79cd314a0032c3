"""Published tables: listings, reviews, assets, enrichments, uploads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterforge import fixed
from rosterforge.functions import text as tx
from rosterforge.functions import urls as u
from rosterforge.functions.replies import epoch_to_timestamp
from rosterforge.operators.ordering import keep_first


# --- gates -----------------------------------------------------------------

def publish_reason(final: Column, crash: Column) -> Column:
    """Why a record cannot be published; null means it can."""
    return (
        F.when(final.isNull(), "missing_final")
        .when(~tx.is_blank(crash), "error_crash")
        .when(tx.is_blank(final["daycare_id"]), "missing_id")
        .when(tx.is_blank(final["name"]), "invalid_name")
    )


# widths of the published numbers
NUMBERS = {"review_score": "decimal(2,1)", "latitude": "decimal(10,7)", "longitude": "decimal(10,7)"}


def number_reason(final: Column) -> Column:
    """Reason of a record with a number that its published column cannot hold, else null."""
    unfit = [final[c].isNotNull() & final[c].try_cast(kind).isNull() for c, kind in NUMBERS.items()]
    return F.when(reduce(lambda a, b: a | b, unfit), "invalid_number")


def review_is_valid(rating: Column) -> Column:
    return F.coalesce(rating.between(1, 5), F.lit(True))


def publish_counts(reasoned: DataFrame, reason: str = "reason") -> DataFrame:
    """Fetched, published and failed rows in one row."""
    return reasoned.agg(
        F.count("*").alias("fetched"),
        F.count_if(F.col(reason).isNull()).alias("published"),
        F.count_if(F.col(reason).isNotNull()).alias("failed"),
    )


# --- listings --------------------------------------------------------------

def location_ewkt(latitude: Column, longitude: Column) -> Column:
    """Point as EWKT text, only from two known, non-zero coordinates."""
    return F.when(
        (latitude != 0) & (longitude != 0),
        F.concat(
            F.lit("SRID=4326;POINT("), longitude.cast("string"), F.lit(" "), latitude.cast("string"), F.lit(")")
        ),
    )


def listing_rows(final: DataFrame, public_base: str = "") -> DataFrame:
    """Rows of the listing table from final records."""
    parts = [F.col("score_breakdown")[p].alias(p) for p in fixed.SCORE_PARTS]
    breakdown = F.struct(
        *parts, F.col("trust_score_explanation").alias("explanation"), F.col("ranking_tier").alias("tier")
    )
    replaced = {
        "score_breakdown": breakdown,
        "thumbnail_url": published_thumbnail(F.col("daycare_id"), F.col("thumbnail_url"), public_base),
        "is_internal": F.coalesce("is_internal", F.lit(False)),
        "website_active": F.coalesce("website_active", F.lit(True)),
        "country": F.coalesce("country", F.lit(fixed.COUNTRY)),
        **{c: F.col(c).try_cast(kind) for c, kind in NUMBERS.items()},
    }
    hidden = {"photos", "trust_score_explanation", "ranking_tier"}
    columns = [replaced.get(c, F.col(c)).alias(c) for c in fixed.FINAL_COLUMNS if c not in hidden]
    return final.select(
        *columns,
        F.lit(fixed.LISTING_STATUS).alias("status"),
        location_ewkt(F.col("latitude"), F.col("longitude")).alias("location"),
    )


# --- uploads and assets ----------------------------------------------------

def is_local(path: Column) -> Column:
    return ~tx.is_blank(path) & ~path.startswith("http")


def thumbnail_target(listing: Column, path: Column) -> Column:
    return F.concat(listing, F.lit("/"), u.base_name(path))


def published_thumbnail(listing: Column, path: Column, public_base: str) -> Column:
    """Public URL of a local thumbnail; other values as they are."""
    return F.when(is_local(path), F.concat(F.lit(public_base), thumbnail_target(listing, path))).otherwise(path)


def photo_target(listing: Column, path: Column) -> Column:
    return F.concat(listing, F.lit("/google_photos/"), u.base_name(path))


def street_view_target(listing: Column) -> Column:
    return F.concat(listing, F.lit("/street_view.jpg"))


def upload_plan(final: DataFrame) -> DataFrame:
    """`daycare_id, kind, local_path, target, content_type` of every upload.

    ``final`` holds final records plus `street_view_path`.
    """
    listing = F.col("daycare_id")
    planned = F.concat(
        F.array(
            F.when(
                is_local(F.col("thumbnail_url")),
                F.struct(
                    F.lit("thumbnail").alias("kind"),
                    F.col("thumbnail_url").alias("local_path"),
                    thumbnail_target(listing, F.col("thumbnail_url")).alias("target"),
                ),
            ),
            F.when(
                ~tx.is_blank(F.col("street_view_path")),
                F.struct(
                    F.lit(fixed.STREET_VIEW_SOURCE).alias("kind"),
                    F.col("street_view_path").alias("local_path"),
                    street_view_target(listing).alias("target"),
                ),
            ),
        ),
        F.transform(
            F.coalesce("photos", F.array().cast("array<string>")),
            lambda p: F.struct(
                F.lit(fixed.PHOTO_SOURCE).alias("kind"),
                p.alias("local_path"),
                photo_target(listing, p).alias("target"),
            ),
        ),
    )
    return (
        final.select("daycare_id", F.explode(F.array_compact(planned)).alias("p"))
        .select("daycare_id", "p.*")
        .withColumn("content_type", u.content_type(F.col("local_path")))
    )


def asset_rows(plan: DataFrame, public_base: str = "") -> DataFrame:
    """Asset table rows of the planned photo and street-view uploads."""
    return plan.where(F.col("kind").isin(fixed.REPLACED_SOURCES)).select(
        "daycare_id",
        F.concat(F.lit(public_base), "target").alias("url"),
        F.lit("image").alias("type"),
        F.col("kind").alias("source"),
    )


def replace_slice(
    old: DataFrame, new: DataFrame, key: str = "daycare_id", source: str = "source",
    sources: list[str] | None = None,
) -> DataFrame:
    """Old rows of replaced sources give way where a key has new rows."""
    keys = new.select(F.col(key).alias("_key")).distinct()
    replaced = (old[key] == keys["_key"]) & old[source].isin(sources or fixed.REPLACED_SOURCES)
    return old.join(keys, replaced, "left_anti").unionByName(new)


# --- reviews and enrichments -----------------------------------------------

REVIEW_KEY = ["daycare_id", "source", "author_name", "published_time"]


def review_rows(records: DataFrame, *more: str) -> DataFrame:
    """One row per review of a record's place; out-of-range ratings are left out.

    `ord` is the place of the review in its record, ``more`` are columns kept.
    """
    rows = records.select("daycare_id", *more, F.posexplode("reviews").alias("ord", "r")).select(
        "daycare_id",
        F.lit(fixed.REVIEW_SOURCE).alias("source"),
        F.col("r.author_name").alias("author_name"),
        F.col("r.rating").alias("rating"),
        F.col("r.text").alias("text"),
        epoch_to_timestamp(F.col("r.time")).alias("published_time"),
        "ord",
        *more,
    )
    return rows.where(review_is_valid(F.col("rating")))


def enrichment_rows(research: DataFrame, run_time: Column) -> DataFrame:
    """Research rows that hold a summary or a source."""
    filled = reduce(
        lambda a, b: a | b,
        [~tx.is_blank(F.col(c)) for c in ("safety_summary", "reputation_summary", "staff_summary")],
    ) | (F.coalesce(F.size("verified_sources"), F.lit(0)) > 0)
    return research.where(filled).select(
        "daycare_id", "safety_summary", "reputation_summary", "staff_summary",
        "operational_info", "verified_sources", run_time.alias("updated_at"),
    )


def with_parent(children: DataFrame, listings: DataFrame, key: str = "daycare_id") -> DataFrame:
    """Child rows whose listing was published."""
    return children.join(listings.select(key), key, "left_semi")


# --- upserts ---------------------------------------------------------------

def latest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Last row per key; null key parts count as equal."""
    return keep_first(rows, keys, order)


def upsert(existing: DataFrame, new: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Next version of a table keyed by ``keys``: new rows win, the last of them.

    ``order`` sorts the newest row first.  A small batch reaches the big table
    as a broadcast anti-join that Spark picks by size, without shuffling it.
    """
    return put(existing, latest(new, keys, order), keys)


def put(existing: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """``fresh``, one row per key, and the old rows of all other keys."""
    marks = fresh.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [existing[k].eqNullSafe(marks[f"_new_{k}"]) for k in keys])
    return existing.join(marks, same, "left_anti").unionByName(fresh)
