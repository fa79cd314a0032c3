"""Place lookup: query text, join, gates, shaping and cache upkeep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterforge import fixed
from rosterforge.functions import matching as match
from rosterforge.functions import text as tx
from rosterforge.functions.urls import clean_url
from rosterforge.operators.ordering import keep_first


def place_query(name: Column, address: Column) -> Column:
    """Search text: the name, then the filled address parts."""
    parts = [tx.blank_to_null(address[p]) for p in ("street", "city", "state", "zip")]
    return tx.strip(F.concat(F.coalesce(name, F.lit("None")), F.lit(" "), F.concat_ws(", ", *parts)))


def street_address(address: Column) -> Column:
    """Register address that starts with the street number."""
    parts = [tx.blank_to_null(address[p]) for p in ("street", "city", "state", "zip")]
    return F.concat_ws(", ", *parts)


def with_query(unified: DataFrame) -> DataFrame:
    query = place_query(F.col("name"), F.col("address"))
    return unified.withColumn("place_query", query).withColumn("query_md5", F.md5("place_query"))


def with_names_agree(df: DataFrame, left: Column, right: Column, column: str) -> DataFrame:
    """Adds the name test of every row's pair as ``column``.

    Spark's own expressions decide what bounds of the ratio can decide; only
    the pairs left open reach the matching kernel, the others travel to it as
    nulls.  No shuffle is needed.
    """
    decided = df.withColumn("_decided", match.names_decided(left, right))
    undecided = F.col("_decided").isNull()
    ratio = match.sequence_ratio(F.when(undecided, F.lower(left)), F.when(undecided, F.lower(right)))
    return decided.withColumn(column, F.coalesce("_decided", match.ratio_agrees(ratio))).drop("_decided")


def join_places(unified: DataFrame, lookup: DataFrame) -> DataFrame:
    """Records with their place reply, found by the hash of the query text."""
    placed = lookup.select("query_md5", F.struct(*[c for c in lookup.columns if c != "query_md5"]).alias("place"))
    return with_query(unified).join(placed, "query_md5", "left")


def with_match(joined: DataFrame) -> DataFrame:
    """Adds `place_match`: does the found place fit the record?"""
    named = with_names_agree(joined, F.col("name"), F.col("place.name"), "_names")
    streets = match.street_numbers_agree(street_address(F.col("address")), F.col("place.address"))
    return named.withColumn("place_match", F.col("_names") & streets).drop("_names")


def gate_reason() -> Column:
    """First place gate a record fails, else null."""
    status = F.col("place.business_status")
    return (
        F.when(F.col("place").isNull(), "place_missing")
        .when(F.col("place.status") == fixed.NOT_FOUND, "place_not_found")
        .when(~F.col("place_match"), "place_mismatch")
        .when(tx.is_blank(status) | (status == fixed.CLOSED_FOR_GOOD), "place_status")
    )


def judge_places(unified: DataFrame, lookup: DataFrame) -> DataFrame:
    """Records with their place and the `drop_reason` of the first gate they fail."""
    return with_match(join_places(unified, lookup)).withColumn("drop_reason", gate_reason())


def split_gate(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    kept = judged.where(F.col("drop_reason").isNull()).drop("drop_reason", "place_match")
    drops = judged.where(F.col("drop_reason").isNotNull()).select(
        "id", "source_state", F.lit("place").alias("step"), F.col("drop_reason").alias("reason"), "_ord"
    )
    return kept, drops


def place_gate(unified: DataFrame, lookup: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records with a usable place, and the drop ledger of the others."""
    return split_gate(judge_places(unified, lookup))


def split_enriched(unified: DataFrame, enriched: DataFrame, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """Records that still need a lookup, and those that already carry a place."""
    ids = enriched.select(key)
    return unified.join(ids, key, "left_anti"), unified.join(ids, key, "left_semi")


def shape_place(reply: Column) -> Column:
    """Raw place reply as the typed place of the lookup table."""
    location = reply["geometry"]["location"]
    reviews = F.transform(reply["reviews"], lambda r: r.dropFields("relative_time_description"))
    return F.struct(
        reply["place_id"].alias("place_id"),
        reply["name"].alias("name"),
        reply["business_status"].alias("business_status"),
        reply["url"].alias("google_maps_url"),
        reply["formatted_address"].alias("address"),
        F.struct(
            reply["formatted_phone_number"].alias("phone"), clean_url(reply["website"]).alias("website")
        ).alias("contact"),
        F.struct(reply["rating"].alias("stars"), reply["user_ratings_total"].alias("count")).alias("rating"),
        F.coalesce(reviews, F.array().cast(_review_type())).alias("reviews"),
        F.slice(F.coalesce(reply["photos"], F.array().cast("array<string>")), 1, fixed.PLACE_PHOTO_LIMIT)
        .alias("photos"),
        reply["opening_hours"].alias("operating_hours"),
        F.struct(location["lat"].alias("lat"), location["lng"].alias("lng")).alias("street_view_metadata"),
    )


def _review_type() -> str:
    return "array<struct<author_name:string,rating:int,text:string,time:bigint>>"


def refreshed_lookup(judged: DataFrame, lookup: DataFrame, fetched: DataFrame) -> DataFrame:
    """Next version of the lookup after one run.

    ``judged`` are the distinct queries of the run with `place_match` against
    the lookup entry they hit; ``fetched`` are fresh replies for queries that
    had no entry (`found`, `place_name`, `place_match`).  A stored hit that no
    longer fits becomes a miss, as does a fresh reply that does not fit or a
    query without any reply; everything else stays.
    """
    stale = judged.where(
        F.col("hit") & (F.coalesce(F.col("status"), F.lit("")) != fixed.NOT_FOUND) & ~F.col("place_match")
    ).select(
        "query_md5",
        F.lit(fixed.NOT_FOUND).alias("status"),
        F.lit(fixed.MISMATCH_CACHED).alias("reason"),
        F.lit(None).cast("string").alias("searched_query"),
        F.struct(F.col("name").alias("query_name"), F.col("place_name").alias("found_name")).alias("metadata"),
    )
    missed = fetched.where(~F.col("found")).select(
        "query_md5",
        F.lit(fixed.NOT_FOUND).alias("status"),
        F.lit(None).cast("string").alias("reason"),
        F.col("place_query").alias("searched_query"),
        F.lit(None).cast("struct<query_name:string,found_name:string>").alias("metadata"),
    )
    unfit = fetched.where(F.col("found") & ~F.col("place_match")).select(
        "query_md5",
        F.lit(fixed.NOT_FOUND).alias("status"),
        F.lit(fixed.MISMATCH).alias("reason"),
        F.lit(None).cast("string").alias("searched_query"),
        F.struct(F.col("name").alias("query_name"), F.col("place_name").alias("found_name")).alias("metadata"),
    )
    fresh = fetched.where(F.col("found") & F.col("place_match")).drop(
        "found", "place_match", "place_name", "place_query"
    )
    changes = stale.unionByName(missed).unionByName(unfit).unionByName(fresh, allowMissingColumns=True)
    changes = keep_first(changes, "query_md5", [F.coalesce("reason", F.lit("")), F.coalesce("status", F.lit(""))])
    changes = changes.select(*[c for c in changes.columns if c in lookup.columns])
    untouched = lookup.join(changes.select("query_md5"), "query_md5", "left_anti")
    return untouched.unionByName(changes, allowMissingColumns=True)
