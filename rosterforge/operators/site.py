"""Stored pages into links, page text, assets and site manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterforge import fixed
from rosterforge.functions import html as h
from rosterforge.functions import urls as u
from rosterforge.functions.images import screen_reason
from rosterforge.functions.text import first_filled, is_blank
from rosterforge.operators.late import where_once
from rosterforge.operators.ordering import keep_first


def extract_links(pages: DataFrame, *keep: str) -> DataFrame:
    """`url, ord, href, link` of every link, resolved against its page.

    ``keep`` names columns of the page that go along, here and below.
    """
    return pages.select("url", *keep, F.posexplode(h.anchors(F.col("html"))).alias("ord", "href")).select(
        "url", *keep, "ord", "href", u.resolve_link(F.col("url"), F.col("href")).alias("link")
    )


def follow_links(links: DataFrame) -> DataFrame:
    """Links the frontier may take: `domain, src, dst, ord, priority`.

    Everything that does not depend on the walk is tested here, before any
    shuffle: form, same site, no blocked word.
    """
    named = links.select(
        u.site_domain(F.col("url")).alias("domain"),
        F.col("url").alias("src"),
        u.normalize_link(F.col("link")).alias("dst"),
        "ord",
    )
    judged = named.select(
        "domain", "src", "dst", "ord",
        u.is_priority_link(F.col("dst")).alias("priority"),
        (
            F.col("dst").startswith("http")
            & (u.site_domain(F.col("dst")) == F.col("domain"))
            & ~u.is_blocked_link(F.col("dst"))
        ).alias("_allowed"),
    )
    return where_once(judged, lambda r: r["_allowed"]).drop("_allowed")


def page_texts(pages: DataFrame, *keep: str) -> DataFrame:
    """Pages with enough readable text, as the site's text files."""
    # one select per stage, so that each intermediate text is worked out once
    shown = pages.select("url", *keep, h.body(F.col("html")).alias("shown"))
    opened = shown.select("url", *keep, "shown", h.content_openings(F.col("shown")).alias("opened"))
    candidates = opened.select("url", *keep, "shown", h.content_texts(F.col("opened")).alias("texts"))
    chosen = candidates.select("url", *keep, h.chosen_text(F.col("texts"), F.col("shown")).alias("text"))
    return where_once(chosen, lambda r: F.char_length(r["text"]) > fixed.PAGE_TEXT_MIN_CHARS).select(
        "url", *keep, "text", u.text_asset_name(F.col("url")).alias("file")
    )


def page_assets(pages: DataFrame, *keep: str) -> DataFrame:
    """Image and PDF references of every page, in page order; http only."""
    images = (
        pages.select("url", *keep, F.posexplode(h.image_tags(F.col("html"))).alias("ord", "tag"))
        .select("url", *keep, "ord", h.image_source(F.col("tag")).alias("src"))
        .select(
            "url", *keep, "ord", F.lit("image").alias("type"),
            u.resolve_link(F.col("url"), F.col("src")).alias("original_url"),
        )
    )
    documents = (
        extract_links(pages, *keep)
        .where(F.col("href").endswith(".pdf"))
        .select("url", *keep, "ord", F.lit("pdf").alias("type"), F.col("link").alias("original_url"))
    )
    named = F.when(F.col("type") == "pdf", u.pdf_asset_name(F.col("original_url"))).otherwise(
        u.image_asset_name(F.col("original_url"))
    )
    return (
        images.unionByName(documents)
        .where(F.col("original_url").startswith("http"))
        .withColumn("asset_name", named)
    )


def screen_assets(assets: DataFrame) -> DataFrame:
    """Assets with the reason they are refused; null means kept."""
    return assets.withColumn(
        "reason", screen_reason(F.col("type"), F.col("size_bytes"), F.col("width"), F.col("height"))
    )


def dedupe_assets(assets: DataFrame, order: list[Column]) -> DataFrame:
    """One asset per site and URL, the first seen."""
    return keep_first(assets, ["domain", "original_url"], order)


def target_url(place_website: Column, register_website: Column) -> Column:
    """Website to visit: the place's, else the register's; null if neither."""
    url = first_filled(place_website, register_website)
    return F.when(~is_blank(url), url)


def start_urls(records: DataFrame, order: str = "_ord") -> DataFrame:
    """One start URL per site: that of the first record naming the site."""
    named = records.where(F.col("target_url").isNotNull()).select(
        u.site_domain(F.col("target_url")).alias("domain"), F.col("target_url").alias("start_url"), order
    )
    # an aggregate, so that a site named by a third of all records shrinks
    # to one row per task before the exchange
    return named.groupBy("domain").agg(F.min_by("start_url", F.struct(order, "start_url")).alias("start_url"))


def sites_to_visit(starts: DataFrame, manifest: DataFrame) -> DataFrame:
    """Sites without a stored manifest; the others are reused as they are."""
    return starts.join(manifest.select("domain"), "domain", "left_anti")


def attach_sites(records: DataFrame, sites: DataFrame) -> DataFrame:
    """Records with their site's row under `site`, null where there is none."""
    packed = sites.select("domain", F.struct(*[c for c in sites.columns if c != "domain"]).alias("site"))
    with_domain = records.withColumn("domain", u.site_domain(F.col("target_url")))
    return with_domain.join(packed, "domain", "left")


def site_manifest(visits: DataFrame, assets: DataFrame, run_time: Column) -> DataFrame:
    """Counts per visited site.  ``visits`` has `domain, url, depth, loaded`."""
    counted = visits.groupBy("domain").agg(
        F.min_by("url", "pos").alias("root_url"),
        F.count("*").cast("int").alias("pages_crawled"),
        F.count_if("loaded").cast("int").alias("pages_successful"),
    )
    found = assets.groupBy("domain").agg(F.count("*").cast("int").alias("assets_found"))
    return counted.join(found, "domain", "left").select(
        "domain", "root_url", run_time.alias("timestamp"), "pages_crawled", "pages_successful",
        F.coalesce("assets_found", F.lit(0)).alias("assets_found"),
        (F.col("pages_successful") > 0).alias("website_active"),
    )
