"""Unified records to final records, one table per stage."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterforge import fixed
from rosterforge.operators import images, ledger, model_calls, places, refine, selection, site, synth
from rosterforge.operators.frontier import crawl
from rosterforge.session import durable


@dataclass(frozen=True)
class EnrichResult:
    final: DataFrame
    research: DataFrame
    records: DataFrame
    drops: DataFrame
    retries: DataFrame
    usage: DataFrame

    def to_publish(self) -> DataFrame:
        """`final` with the rows' positions, so that of one id the last row is published."""
        return synth.final_record(self.records, "_ord")


def select_input(
    unified: DataFrame, done: DataFrame | None = None, ids: DataFrame | None = None, limit: int | None = None
) -> DataFrame:
    """Records of one run: not yet done, of the wanted ids, the first of those."""
    rows = unified if done is None else selection.not_done(unified, done)
    rows = rows if ids is None else selection.only_ids(rows, ids)
    return selection.first_rows(rows, limit)


def site_stage(records: DataFrame, pages: DataFrame, run_time: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Manifest, text files and media of the sites the records name.

    A site named by many records is walked once.  Links are extracted once
    and written, since every layer of the walk joins them.
    """
    starts = site.start_urls(records)
    stored = pages.select("url").distinct()
    links = durable(site.follow_links(site.extract_links(pages)), "links")
    visits = durable(crawl(starts, links, stored), "visits")
    # the visited pages, a few per site, are read twice: texts and media
    chosen = durable(
        pages.select("url", "html").join(visits.where("loaded").select("domain", "url", "pos"), "url"), "chosen"
    )
    texts = site.page_texts(chosen, "domain", "pos")
    files = texts.select("domain", "file", F.col("pos").alias("ord"), "text")
    media = site.page_assets(chosen, "domain", "pos")
    unique = site.dedupe_assets(
        media, [F.col("pos"), F.col("type"), F.col("ord")]
    )
    listed = unique.select("domain", "original_url").unionByName(
        texts.select("domain", F.col("url").alias("original_url"))
    )
    return site.site_manifest(visits, listed, run_time), files, unique


def refine_stage(
    manifest: DataFrame, files: DataFrame, media: DataFrame, prompts: DataFrame | None, documents: DataFrame | None
) -> DataFrame:
    """One refined row per site.  ``media`` brings `local_path, size_bytes`
    and, for images, `vector`; ``documents`` the extracted text of PDFs.

    Images without a vector could not be read and are left out, as long as
    their site has one with a vector; else the first valid paths stand in.
    """
    pictures = media.where(F.col("type") == "image").withColumn("path", F.col("local_path"))
    ranked = (
        images.first_images(pictures, "domain")
        if prompts is None
        else images.rank_images(pictures, prompts, "domain")
    )
    score = F.lit(0.0) if prompts is None else -F.col("score")
    read = F.lit(True) if prompts is None else F.col("vector").isNotNull()
    best = ranked.groupBy("domain").agg(
        F.array_sort(F.collect_list(F.struct(score.alias("s"), F.col("path").alias("p"), read.alias("read")))).alias("v")
    )
    shown = F.filter("v", lambda x: x["read"])
    best = best.select(
        "domain", F.transform(F.when(F.size(shown) > 0, shown).otherwise(F.col("v")), lambda x: x["p"]).alias("verified_images")
    )
    top = refine.rank_documents(media.where(F.col("type") == "pdf"), "domain")
    papers = top.groupBy("domain").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "ord", F.col("local_path").alias("p"))))
        .alias("v")
    ).select("domain", F.transform("v", lambda x: x["p"]).alias("pdf_assets"))
    chosen_documents = None
    if documents is not None:
        chosen_documents = documents.join(top.select("domain", F.col("local_path").alias("file"), "ord"), ["domain", "file"])
    bodies = refine.site_bodies(files, chosen_documents)
    raw = pictures.groupBy("domain").agg(F.count("*").alias("original_images"))
    texts = files.groupBy("domain").agg(F.count("*").alias("original_text_files"))
    nothing = F.array().cast("array<string>")
    return (
        manifest.join(best, "domain", "left").join(papers, "domain", "left").join(bodies, "domain", "left")
        .join(raw, "domain", "left").join(texts, "domain", "left")
        .select(
            "domain",
            F.coalesce("verified_images", nothing).alias("verified_images"),
            F.coalesce("pdf_assets", nothing).alias("pdf_assets"),
            F.col("body"),
            "website_active",
            F.struct(
                F.coalesce("original_images", F.lit(0)).alias("original_images"),
                F.coalesce("original_text_files", F.lit(0)).alias("original_text_files"),
            ).alias("raw_stats"),
        )
    )


def run(
    unified: DataFrame,
    lookup: DataFrame,
    sites: DataFrame,
    research_function: Callable,
    synthesis_function: Callable,
    research_template: str,
    store: str,
    run_time: Column,
    **settings,
) -> EnrichResult:
    """All stages.  ``sites`` is the refined-site table; paid calls come after
    every gate and their replies are stored before they are parsed."""
    # written once: the gate holds the only Python rule before the paid calls
    kept, drops = places.split_gate(durable(places.judge_places(unified, lookup), "judged"))
    kept = kept.withColumn(
        "target_url", site.target_url(F.col("place.contact.website"), F.col("contact.website"))
    )
    asked = kept.select(
        F.col("id").alias("daycare_id"),
        synth.research_prompt(F.col("name"), F.col("place.address"), F.col("address"), research_template)
        .alias("prompt"),
    )
    answers = model_calls.run_model(asked, research_function, fixed.RESEARCH_STEP, store, **settings)
    research = synth.parse_research(answers)
    joined = site.attach_sites(kept, sites).join(
        research.select(F.col("daycare_id").alias("id"), F.struct(*research.columns[1:]).alias("research")), "id", "left"
    )
    joined = joined.withColumn(
        "image_candidates", images.image_candidates(F.col("site.verified_images"), F.col("place.photos"))
    )
    basic = F.struct("id", "name", "type", "license_date", "address", "contact", "capacity", "ages_served", "schedule")
    context = synth.context_parts(
        basic, F.col("site.website_active"), F.col("site.body"), F.col("research"), F.col("place")
    )
    final_asked = joined.select(F.col("id").alias("daycare_id"), F.array_join(context, "\n").alias("prompt"))
    final_answers = model_calls.run_model(final_asked, synthesis_function, fixed.SYNTHESIS_STEP, store, **settings)
    parsed = synth.parse_synthesis(final_answers)
    whole = durable(
        joined.join(
            parsed.select(F.col("daycare_id").alias("id"), "reply", F.col("error").alias("synthesis_error")), "id", "left"
        ),
        "assembled",
    )
    outcomes = whole.select(
        F.struct(*unified.columns).alias("original_record"),
        F.col("research.status").alias("research_status"),
        F.col("research.error").alias("research_error"),
        "synthesis_error",
    )
    usage = answers.unionByName(final_answers).select("step", "input_tokens", "output_tokens")
    finished = ledger.finished_rows(whole)
    return EnrichResult(
        synth.final_record(finished), research, finished, drops, ledger.retry_rows(outcomes, run_time), usage
    )

