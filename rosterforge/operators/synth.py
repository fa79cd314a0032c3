"""Synthesis: prompts, replies, validation and the final record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterforge import fixed, schemas
from rosterforge.functions import replies as rp
from rosterforge.functions import text as tx


# --- prompts ---------------------------------------------------------------

def research_address(place_address: Column, address: Column) -> Column:
    parts = [F.coalesce(address[p], F.lit("")) for p in ("street", "city", "state")]
    return tx.first_filled(place_address, F.concat_ws(", ", *parts))


def research_prompt(name: Column, place_address: Column, address: Column, template: str) -> Column:
    """Prompt text; the template is the caller's and has two ``%s``."""
    return F.format_string(template, F.coalesce(name, F.lit("")), research_address(place_address, address))


def context_parts(
    record: Column, website_active: Column, site_text: Column, research: Column, place: Column
) -> Column:
    """Texts the synthesis sees, in order; absent parts are left out."""
    shown = F.substring(site_text, 1, fixed.CONTEXT_TEXT_CAP)
    places = F.struct(
        place["rating"]["stars"].alias("rating_stars"),
        place["rating"]["count"].alias("rating_count"),
        F.coalesce(place["reviews"], F.array().cast("array<struct<author_name:string,rating:int,text:string,time:bigint>>"))
        .alias("reviews"),
        place["operating_hours"].alias("operating_hours"),
    )
    as_json = lambda c: F.to_json(c, {"ignoreNullFields": "false"})
    status = F.when(F.coalesce(website_active, F.lit(False)), "True").otherwise("False")
    parts = F.array(
        F.concat(F.lit("Daycare Basic Data: "), as_json(record)),
        F.concat(F.lit("WEBSITE STATUS: website_active="), status),
        F.when(site_text.isNotNull(), F.concat(F.lit("Website Content: "), shown)),
        F.when(research.isNotNull(), F.concat(F.lit("Insider Research Data: "), as_json(research))),
        F.concat(F.lit("Google Places Data: "), as_json(places)),
    )
    return F.array_compact(parts)


# --- replies ---------------------------------------------------------------

def dedupe_sources(chunks: Column) -> Column:
    """Grounding chunks (`uri, title`) as sources, first of every URL.

    A reply's chunks are one array in one row, so this needs no shuffle.
    """
    linked = F.filter(chunks, lambda c: ~tx.is_blank(c["uri"]))
    # bound once through a one-element array: a lambda works out again
    # whatever it refers to outside of its own variables
    bound = F.array(F.struct(linked.alias("all"), F.transform(linked, lambda c: c["uri"]).alias("urls")))

    def source(found: Column, url: Column) -> Column:
        title = F.get(found["all"], F.array_position(found["urls"], url).cast("int") - 1)["title"]
        named = tx.first_filled(title, url)
        return F.struct(url.alias("url"), named.alias("title"), named.alias("source_name"))

    sources = F.transform(
        bound, lambda found: F.transform(F.array_distinct(found["urls"]), lambda url: source(found, url))
    )
    return F.get(sources, F.lit(0))


def parse_research(replies: DataFrame) -> DataFrame:
    """Research table from stored replies (`daycare_id, reply, chunks, error`).

    Status is ERROR where the call failed, FAILED_PARSE where the reply is not
    a JSON object, else null.
    """
    text = rp.strip_fence(F.col("reply"))
    parsed = replies.withColumn("_text", text).withColumn(
        "_data", rp.parse_object(F.col("_text"), schemas.RESEARCH_REPLY)
    )
    failed = F.col("error").isNotNull()
    good = ~failed & F.col("_data").isNotNull()
    fields = [F.when(good, F.col("_data")[f]).alias(f) for f in schemas.RESEARCH_REPLY.fieldNames()]
    return parsed.select(
        "daycare_id",
        *fields,
        F.when(good, dedupe_sources(F.col("chunks"))).alias("verified_sources"),
        F.when(failed, "ERROR").when(~good, "FAILED_PARSE").alias("status"),
        "error",
        F.when(~failed & ~good, F.substring("reply", 1, fixed.RESEARCH_RAW_CAP)).alias("raw"),
    )


def parse_synthesis(replies: DataFrame) -> DataFrame:
    """Typed synthesis replies; `error` is set where there is none."""
    parsed = replies.withColumn("_data", rp.parse_object(F.col("reply"), schemas.SYNTHESIS_REPLY))
    bad = F.col("error").isNull() & F.col("_data").isNull()
    return parsed.select(
        "daycare_id",
        F.when(F.col("error").isNull(), F.col("_data")).alias("reply"),
        F.coalesce("error", F.when(bad, F.lit("reply is not a JSON object"))).alias("error"),
        F.when(bad, F.substring("reply", 1, fixed.SYNTHESIS_RAW_CAP)).alias("raw"),
    )


# --- validation ------------------------------------------------------------

def tier_of(score: Column) -> Column:
    chosen = None
    for tier, floor in fixed.TIER_FLOORS:
        hit = score >= floor
        chosen = F.when(hit, tier) if chosen is None else chosen.when(hit, tier)
    return chosen


def score_caps(safety: Column, reputation: Column, website_active: Column, review_count: Column) -> Column:
    """Category scores above what the evidence allows, as names."""
    return F.array_compact(
        F.array(
            F.when(
                ~F.coalesce(website_active, F.lit(False)) & (safety > fixed.NO_SITE_SAFETY_MAX),
                "safety_and_transparency",
            ),
            F.when(
                (F.coalesce(review_count, F.lit(0)) == 0) & (reputation > fixed.NO_REVIEWS_REPUTATION_MAX),
                "parent_reputation",
            ),
        )
    )


def _outside(value: Column, allowed: list[str]) -> Column:
    return ~F.coalesce(value.isin(allowed), F.lit(False))


def _not_between(value: Column, low: int, high: int) -> Column:
    return ~F.coalesce(value.between(low, high), F.lit(False))


def violations(reply: Column, candidates: Column) -> Column:
    """Rules a synthesis reply breaks, in a fixed order."""
    ranking, data = reply["ranking"], reply["structured_data"]
    tests = [
        (_outside(data["program_type"], fixed.PROGRAM_TYPES), "program_type"),
        (_outside(data["availability_status"], fixed.AVAILABILITY_STATUSES), "availability_status"),
        (_outside(ranking["ranking_tier"], fixed.RANKING_TIERS), "ranking_tier"),
        (_not_between(ranking["trust_score"], 0, fixed.TOTAL_SCORE_MAX), "trust_score"),
    ]
    for part in fixed.SCORE_PARTS:
        score = ranking["score_breakdown"][part]["score"]
        tests.append((_not_between(score, 0, fixed.PART_SCORE_MAX), part))
    long_text = F.char_length(reply["marketing_content"]["description"]) > fixed.DESCRIPTION_CAP
    thumbnail = reply["media_selection"]["best_thumbnail_path"]
    tests += [
        (F.coalesce(long_text, F.lit(False)), "description"),
        (F.coalesce(F.size(reply["search_tags"]) > fixed.MAX_TAGS, F.lit(False)), "search_tags"),
        (~F.coalesce(F.array_contains(candidates, thumbnail), F.lit(False)), "thumbnail"),
        (
            F.coalesce(tier_of(ranking["trust_score"]) != ranking["ranking_tier"], F.lit(False)),
            "tier_band",
        ),
    ]
    return F.array_compact(F.array(*[F.when(test, name) for test, name in tests]))


# --- final record ----------------------------------------------------------

def final_record(joined: DataFrame, *more: str) -> DataFrame:
    """Final record from `unified` columns joined with `place`, `site`, `reply`
    structs, `target_url` and `image_candidates`; columns named in ``more`` pass through."""
    reply, place, site = F.col("reply"), F.col("place"), F.col("site")
    ranking, data = reply["ranking"], reply["structured_data"]
    marketing = reply["marketing_content"]
    contact, address = F.col("contact"), F.col("address")
    no_text = F.array().cast("array<string>")
    active = F.when(F.col("target_url").isNull(), False).otherwise(
        F.coalesce(site["website_active"], F.lit(True))
    )
    values = {
        "daycare_id": F.col("id"),
        "name": F.col("name"),
        "trust_score": ranking["trust_score"],
        "trust_score_explanation": ranking["trust_score_explanation"],
        "score_breakdown": ranking["score_breakdown"],
        "ranking_tier": ranking["ranking_tier"],
        "review_score": place["rating"]["stars"],
        "review_count": place["rating"]["count"],
        "certifications": F.coalesce(data["certifications"], no_text),
        "capacity": F.col("capacity"),
        "operating_hours": place["operating_hours"],
        "is_internal": F.lit(False),
        "thumbnail_url": reply["media_selection"]["best_thumbnail_path"],
        "headline": marketing["headline"],
        "sub_headline": marketing["sub_headline"],
        "description": tx.truncate_sentence(marketing["description"]),
        "search_tags": F.coalesce(reply["search_tags"], no_text),
        "insights": reply["insider_insight"],
        "google_maps_url": place["google_maps_url"],
        "google_place_id": place["place_id"],
        "website_url": tx.first_filled(place["contact"]["website"], contact["website"]),
        "website_active": active,
        "email": contact["email"],
        "director_name": contact["director_name"],
        "phone": tx.first_filled(place["contact"]["phone"], contact["phone"]),
        "address": tx.first_filled(place["address"], address["street"]),
        "city": address["city"],
        "state": address["state"],
        "zip": address["zip"],
        "country": F.lit(fixed.COUNTRY),
        "latitude": place["street_view_metadata"]["lat"],
        "longitude": place["street_view_metadata"]["lng"],
        "photos": F.coalesce(F.col("image_candidates"), no_text),
    }
    return joined.select(*[values.get(c, data[c] if c not in values else None).alias(c) for c in fixed.FINAL_COLUMNS], *more)
