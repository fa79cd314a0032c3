"""Synthesis queries: prompts, replies, validation, the final record."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterforge import fixed, schemas
from rosterforge.catalog import base as b
from rosterforge.catalog.base import pick, query, sql_pick, table
from rosterforge.functions import text as tx
from rosterforge.operators import model_calls, synth
from rosterforge.session import durable_path


def _last(x: str, mark: str) -> str:
    return f"CASE WHEN contains({x}, '{mark}') THEN length({x}) - strpos(reverse({x}), '{mark}') ELSE -1 END"


def sql_truncate(x: str) -> str:
    head = f"substr({x}, 1, 1000)"
    sentence = f"greatest({_last(head, '.')}, {_last(head, '!')}, {_last(head, '?')})"
    space = _last(head, " ")
    return (
        f"CASE WHEN COALESCE(length({x}), 0) = 0 THEN '' WHEN length({x}) <= 1000 THEN {x}"
        f" WHEN {sentence} > 850 THEN substr({head}, 1, {sentence} + 1)"
        f" WHEN {space} >= 0 THEN substr({head}, 1, {space}) || '...' ELSE {head} || '...' END"
    )


@query(
    "q_truncate_sentence",
    f"""WITH t AS (SELECT doc_id, CASE WHEN doc_id % 11 = 4 THEN replace(replace(replace(text, '.', ','), '!', ','), '?', ',')
  WHEN doc_id % 11 = 5 THEN regexp_replace(text, '[ .!?]', '_', 'g') WHEN doc_id % 11 = 6 THEN NULL ELSE text END AS t FROM documents)
SELECT doc_id, {sql_truncate("t")} AS cut FROM t""",
)
def q_truncate_sentence(spark, sf):
    text = F.expr(
        """CASE WHEN doc_id % 11 = 4 THEN translate(text, '.!?', ',,,') WHEN doc_id % 11 = 5 THEN translate(text, ' .!?', '____')
        WHEN doc_id % 11 = 6 THEN NULL ELSE text END"""
    )
    documents = table(spark, sf, "documents", "doc_id", "text").select("doc_id", text.alias("t"))
    return documents.select("doc_id", tx.truncate_sentence(F.col("t")).alias("cut"))


@query(
    "q_prompt_text",
    f"""SELECT c_custkey, 'Research ''' || c_name || ''' at ''' || COALESCE(NULLIF({sql_pick("c_custkey", "1 Main St, Austin", "", None)}, ''),
  c_custkey || ' Main St, ' || COALESCE({sql_pick("c_custkey // 3", "Austin", None)}, '') || ', TX') || '''.' AS prompt FROM customer""",
)
def q_prompt_text(spark, sf):
    address = F.struct(
        F.expr("concat(c_custkey, ' Main St')").alias("street"), pick("c_custkey div 3", "Austin", None).alias("city"), F.lit("TX").alias("state")
    )
    rows = table(spark, sf, "customer").select(
        "c_custkey", "c_name", pick("c_custkey", "1 Main St, Austin", "", None).alias("place_address"), address.alias("address")
    )
    return rows.select(
        "c_custkey",
        synth.research_prompt(F.col("c_name"), F.col("place_address"), F.col("address"), "Research '%s' at '%s'.").alias("prompt"),
    )


@query(
    "q_context_assemble",
    """WITH d AS (SELECT doc_id, lang, source, text, doc_id % 3 = 0 AS active, doc_id % 4 = 1 AS no_text, doc_id % 5 = 2 AS no_research FROM documents),
p AS (SELECT doc_id, 'Daycare Basic Data: {"id":' || doc_id || ',"lang":"' || lang || '"}' AS a,
  'WEBSITE STATUS: website_active=' || CASE WHEN active THEN 'True' ELSE 'False' END AS s,
  CASE WHEN NOT no_text THEN 'Website Content: ' || substr(text, 1, 20000) END AS w,
  CASE WHEN NOT no_research THEN 'Insider Research Data: {"source":"' || source || '","note":null}' END AS r,
  'Google Places Data: {"rating_stars":4.5,"rating_count":' || (doc_id % 90) || ',"reviews":[],"operating_hours":null}' AS g FROM d)
SELECT doc_id, md5(concat_ws(chr(10), a, s, w, r, g)) AS context_md5, CAST(length(concat_ws(chr(10), a, s, w, r, g)) AS BIGINT) AS chars FROM p""",
)
def q_context_assemble(spark, sf):
    place = F.struct(
        F.struct(F.lit(4.5).alias("stars"), (F.col("doc_id") % 90).cast("int").alias("count")).alias("rating"),
        F.lit(None).cast("array<struct<author_name:string,rating:int,text:string,time:bigint>>").alias("reviews"),
        F.lit(None).cast("string").alias("operating_hours"),
    )
    research = F.when(
        F.col("doc_id") % 5 != 2, F.struct(F.col("source").alias("source"), F.lit(None).cast("string").alias("note"))
    )
    parts = synth.context_parts(
        F.struct(F.col("doc_id").alias("id"), "lang"), F.col("doc_id") % 3 == 0, F.when(F.col("doc_id") % 4 != 1, F.col("text")), research, place
    )
    rows = table(spark, sf, "documents", "doc_id", "lang", "source", "text").select("doc_id", F.array_join(parts, "\n").alias("context"))
    return rows.select("doc_id", F.md5("context").alias("context_md5"), F.char_length("context").cast("long").alias("chars"))


# --- replies ----------------------------------------------------------------

_BODY = "concat('{\"safety_summary\": \"s', event_id, '\", \"reputation_summary\": ', CASE WHEN event_id % 3 = 0 THEN 'null' ELSE '\"r\"' END, ', \"operational_info\": ', props, '}')"
_SQL_BODY = "'{\"safety_summary\": \"s' || event_id || '\", \"reputation_summary\": ' || CASE WHEN event_id % 3 = 0 THEN 'null' ELSE '\"r\"' END || ', \"operational_info\": ' || props || '}'"
_FORMS = [
    f"={_BODY}", f"=concat('```json\\n', {_BODY}, '\\n```')", f"=concat(' ```', {_BODY}, '``` ')", f"=substr({_BODY}, 1, 40)",
    "[1, 2]", "", f"=concat(repeat('not json ', 50), {_BODY})",
]
_SQL_FORMS = [
    f"={_SQL_BODY}", f"='```json' || chr(10) || {_SQL_BODY} || chr(10) || '```'", f"=' ```' || {_SQL_BODY} || '``` '", f"=substr({_SQL_BODY}, 1, 40)",
    "[1, 2]", "", f"=repeat('not json ', 50) || {_SQL_BODY}",
]


@query(
    "q_reply_parse",
    f"""WITH r AS (SELECT event_id, {sql_pick("event_id", *_SQL_FORMS)} AS reply, CASE WHEN event_id % 11 = 7 THEN 'timeout' END AS error FROM events),
s AS (SELECT event_id, reply, error, {b.sql_strip("reply")} AS t FROM r),
u AS (SELECT event_id, reply, error, CASE WHEN starts_with(t, '```json') THEN substr(t, 8, greatest(length(t) - 10, 0))
  WHEN starts_with(t, '```') THEN substr(t, 4, greatest(length(t) - 6, 0)) ELSE t END AS t FROM s),
v AS (SELECT event_id, reply, error, t, json_valid(t) AND starts_with({b.sql_strip("t")}, '{{') AND error IS NULL AS good FROM u)
SELECT event_id, CASE WHEN error IS NOT NULL THEN 'ERROR' WHEN NOT good THEN 'FAILED_PARSE' END AS status,
  CASE WHEN good THEN json_extract_string(t, '$.safety_summary') END AS safety_summary,
  CASE WHEN good THEN json_extract_string(t, '$.reputation_summary') END AS reputation_summary, error,
  CASE WHEN error IS NULL AND NOT good THEN substr(reply, 1, 200) END AS raw FROM v""",
)
def q_reply_parse(spark, sf):
    replies = table(spark, sf, "events").select(
        F.col("event_id").alias("daycare_id"), pick("event_id", *_FORMS).alias("reply"),
        F.expr("CASE WHEN event_id % 11 = 7 THEN 'timeout' END").alias("error"),
        F.array().cast("array<struct<uri:string,title:string>>").alias("chunks"),
    )
    return synth.parse_research(replies).select(
        F.col("daycare_id").alias("event_id"), "status", "safety_summary", "reputation_summary", "error", "raw"
    )


@query(
    "q_sources_dedupe",
    """WITH w AS (SELECT conv_id, turn, list_transform(string_split(regexp_replace(text, '\\n', ' ', 'g'), ' '), lambda x:
  CASE WHEN length(x) % 4 = 3 THEN '' ELSE 'http://s.org/' || lower(substr(x, 1, 2)) END) AS l FROM conversations),
d AS (SELECT conv_id, turn, l, list_filter(l, lambda x: x <> '') AS f FROM w),
k AS (SELECT conv_id, turn, list_filter(f, lambda x, i: list_position(f, x) = i) AS urls FROM d)
SELECT conv_id, turn, array_to_string(list_transform(urls, lambda u: u || '|' || CASE WHEN length(u) % 2 = 0 THEN 'T' ELSE u END), chr(10)) AS sources FROM k""",
)
def q_sources_dedupe(spark, sf):
    def chunk(word):
        uri = F.when(F.char_length(word) % 4 == 3, F.lit("")).otherwise(
            F.concat(F.lit("http://s.org/"), F.lower(F.substring(word, 1, 2)))
        )
        return F.struct(uri.alias("uri"), F.when(F.char_length(uri) % 2 == 0, F.lit("T")).alias("title"))

    chunks = F.transform(F.split(F.regexp_replace("text", "\n", " "), " "), chunk)
    rows = table(spark, sf, "conversations", "conv_id", "turn", "text").select("conv_id", "turn", chunks.alias("chunks"))
    sources = synth.dedupe_sources(F.col("chunks"))
    line = F.transform("sources", lambda s: F.concat(s["url"], F.lit("|"), s["title"]))
    return rows.select("conv_id", "turn", sources.alias("sources")).select(
        "conv_id", "turn", F.array_join(line, "\n").alias("sources")
    )


# --- validation -------------------------------------------------------------

_PROGRAMS = ["Montessori", "Play-based", "Unknown kind", None, "Academic"]
_AVAILABLE = ["Waitlist", "Call to Confirm", "Full"]
_TIERS = ["Top Rated", "Verified", "Standard", "Needs Review", "Best"]


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents as replies: their length gives the scores."""
    rows = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "n_chars", "text"), "doc_id")
    part = lambda n: F.struct(F.expr(f"CAST(n_chars % {n} AS INT)").alias("score"), F.lit("tip").alias("improvement_tip"))
    reply = F.struct(
        F.struct(F.lit("h").alias("headline"), F.lit("s").alias("sub_headline"), F.col("text").alias("description")).alias("marketing_content"),
        F.struct(pick("doc_id", *_PROGRAMS).alias("program_type"), pick("doc_id", *_AVAILABLE).alias("availability_status")).alias("structured_data"),
        F.expr("slice(array('a','b','c','d','e','f','g'), 1, CAST(doc_id % 8 AS INT))").alias("search_tags"),
        F.struct(F.expr("concat('img', doc_id % 4)").alias("best_thumbnail_path")).alias("media_selection"),
        F.struct(
            F.expr("CAST(n_chars % 97 AS INT)").alias("trust_score"), pick("n_chars div 7", *_TIERS).alias("ranking_tier"),
            F.struct(*[part(n).alias(p) for n, p in zip((26, 27, 28, 30), fixed.SCORE_PARTS)]).alias("score_breakdown"),
        ).alias("ranking"),
    )
    return rows.select("doc_id", "quality", "toxic", "n_chars", reply.alias("reply"))


_SQL_SCORED = f"""s AS (SELECT l.doc_id, quality, toxic, n_chars, text, {sql_pick("l.doc_id", *_PROGRAMS)} AS program_type, {sql_pick("l.doc_id", *_AVAILABLE)} AS availability,
  {sql_pick("n_chars // 7", *_TIERS)} AS tier, CAST(n_chars % 97 AS INTEGER) AS trust_score, n_chars % 26 AS p0, n_chars % 27 AS p1, n_chars % 28 AS p2, n_chars % 30 AS p3,
  least(l.doc_id % 8, 7) AS tags, 'img' || (l.doc_id % 4) AS thumb FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""
_SQL_TIER = "CASE WHEN trust_score >= 85 THEN 'Top Rated' WHEN trust_score >= 70 THEN 'Verified' WHEN trust_score >= 50 THEN 'Standard' WHEN trust_score >= 0 THEN 'Needs Review' END"


@query(
    "q_validate_reply",
    f"""WITH {_SQL_SCORED} SELECT doc_id, concat_ws(',',
  CASE WHEN NOT COALESCE(program_type IN ({', '.join(map(b.sql_text, fixed.PROGRAM_TYPES))}), false) THEN 'program_type' END,
  CASE WHEN NOT COALESCE(availability IN ({', '.join(map(b.sql_text, fixed.AVAILABILITY_STATUSES))}), false) THEN 'availability_status' END,
  CASE WHEN tier NOT IN ({', '.join(map(b.sql_text, fixed.RANKING_TIERS))}) THEN 'ranking_tier' END,
  CASE WHEN trust_score > 90 THEN 'trust_score' END, CASE WHEN p0 > 25 THEN 'safety_and_transparency' END, CASE WHEN p1 > 25 THEN 'facility_environment' END,
  CASE WHEN p2 > 25 THEN 'teacher_quality' END, CASE WHEN p3 > 25 THEN 'parent_reputation' END, CASE WHEN length(text) > 1000 THEN 'description' END,
  CASE WHEN tags > 5 THEN 'search_tags' END, CASE WHEN thumb NOT IN ('img0', 'img2') THEN 'thumbnail' END,
  CASE WHEN {_SQL_TIER} <> tier THEN 'tier_band' END) AS violations FROM s""",
)
def q_validate_reply(spark, sf):
    candidates = F.array(F.lit("img0"), F.lit("img2"))
    return scored(spark, sf).select(
        "doc_id", F.array_join(synth.violations(F.col("reply"), candidates), ",").alias("violations")
    )


@query("q_score_tier", f"WITH {_SQL_SCORED} SELECT doc_id, {_SQL_TIER} AS tier, COALESCE({_SQL_TIER} = tier, false) AS agrees FROM s")
def q_score_tier(spark, sf):
    ranking = F.col("reply")["ranking"]
    tier = synth.tier_of(ranking["trust_score"])
    return scored(spark, sf).select(
        "doc_id", tier.alias("tier"), F.coalesce(tier == ranking["ranking_tier"], F.lit(False)).alias("agrees")
    )


@query(
    "q_score_caps",
    f"""WITH {_SQL_SCORED} SELECT doc_id, concat_ws(',', CASE WHEN quality = 0 AND p0 > 10 THEN 'safety_and_transparency' END,
  CASE WHEN n_chars % 3 = 0 AND p3 > 5 THEN 'parent_reputation' END) AS over FROM s""",
)
def q_score_caps(spark, sf):
    parts = F.col("reply")["ranking"]["score_breakdown"]
    over = synth.score_caps(
        parts["safety_and_transparency"]["score"], parts["parent_reputation"]["score"], F.col("quality") == 1, F.col("n_chars") % 3
    )
    return scored(spark, sf).select("doc_id", F.array_join(over, ",").alias("over"))


# --- final record -----------------------------------------------------------

def final_records(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with places, sites and replies that leave holes."""
    rows = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    rows = rows.join(suppliers, F.expr("c_custkey % 150 = s_suppkey"), "left")
    website = pick("c_custkey", "=concat('http://p', s_suppkey)", "", None)
    own = pick("c_custkey div 3", "=concat('http://r', c_custkey)", "", None)
    place = F.when(
        F.col("s_suppkey").isNotNull(),
        F.struct(
            F.expr("concat('pl', s_suppkey)").alias("place_id"),
            F.expr("concat('http://maps/', s_suppkey)").alias("google_maps_url"),
            pick("c_custkey div 2", "=concat(s_suppkey, ' Place Rd')", "", None).alias("address"),
            F.struct(pick("c_custkey", "", "=concat('55', s_suppkey)").alias("phone"), website.alias("website")).alias("contact"),
            F.struct(F.expr("CAST(s_suppkey % 50 AS DOUBLE) / 10").alias("stars"), F.expr("CAST(s_suppkey AS INT)").alias("count")).alias("rating"),
            pick("c_custkey", "{\"open\":1}", None).alias("operating_hours"),
            F.struct(
                F.expr("CASE WHEN c_custkey % 5 = 0 THEN 0.0D ELSE s_suppkey / 4 END").alias("lat"),
                F.expr("CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE -s_suppkey / 8 END").alias("lng"),
            ).alias("street_view_metadata"),
        ),
    )
    reply = F.from_json(
        F.expr(
            """concat('{"marketing_content":{"headline":"H', c_custkey, '","sub_headline":"S","description":"', repeat('Good words here. ', CAST(c_custkey % 90 AS INT)),
            '"},"structured_data":{"program_type":"', c_mktsegment, '","min_age_months":', c_custkey % 30, ',"meals_provided":', CASE WHEN c_custkey % 3 = 0 THEN 'null' WHEN c_custkey % 3 = 1 THEN 'true' ELSE 'false' END,
            CASE WHEN c_custkey % 2 = 0 THEN ',"certifications":["NAEYC","X"]' ELSE '' END, '},"search_tags":["t1","t2"],"media_selection":{"best_thumbnail_path":"',
            CASE WHEN c_custkey % 2 = 0 THEN 'http://t/' ELSE 'local/' END, c_custkey, '.png"},"ranking":{"trust_score":', c_custkey % 91,
            ',"trust_score_explanation":"e","score_breakdown":{"teacher_quality":{"score":', c_custkey % 26, ',"improvement_tip":"t"}},"ranking_tier":"Standard"}}')"""
        ),
        schemas.SYNTHESIS_REPLY,
    )
    joined = rows.select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"),
        F.struct(F.lit("f").alias("full"), F.expr("concat(c_custkey, ' Main St')").alias("street"), F.col("n_name").alias("city"),
                 F.lit("TX").alias("state"), F.lit("787").alias("zip")).alias("address"),
        F.struct(F.expr("concat('512', c_custkey)").alias("phone"), F.lit("a@b.c").alias("email"), own.alias("website"), F.lit("Ann").alias("director_name")).alias("contact"),
        F.expr("CAST(c_custkey % 200 AS INT)").alias("capacity"),
        place.alias("place"),
        F.when(F.expr("c_custkey % 4 < 2"), F.struct(F.expr("c_custkey % 4 = 0").alias("website_active"))).alias("site"),
        reply.alias("reply"),
        F.coalesce(tx.blank_to_null(website), tx.blank_to_null(own)).alias("target_url"),
        F.expr("transform(sequence(0, CAST(c_custkey % 3 AS INT)), i -> concat('ph/', c_custkey, '_', i, '.jpg'))").alias("image_candidates"),
    )
    return synth.final_record(joined)


_WEB = sql_pick("c_custkey", "='http://p' || s_suppkey", "", None)
_OWN = sql_pick("c_custkey // 3", "='http://r' || c_custkey", "", None)
_TEXT = "repeat('Good words here. ', CAST(c_custkey % 90 AS BIGINT))"
SQL_FINAL = f"""f AS (SELECT *, c_custkey % 91 AS trust_score, {_WEB} AS place_web, {_OWN} AS own_web, {_TEXT} AS description_text,
  {sql_pick("c_custkey", "", "='55' || s_suppkey")} AS place_phone, {sql_pick("c_custkey // 2", "=s_suppkey || ' Place Rd'", "", None)} AS place_address,
  CASE WHEN s_suppkey IS NULL THEN NULL WHEN c_custkey % 5 = 0 THEN 0.0 ELSE s_suppkey / 4 END AS latitude,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE -s_suppkey / 8 END AS longitude
  FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN supplier ON c_custkey % 150 = s_suppkey)"""


@query(
    "q_finalize_flatten",
    f"""WITH {SQL_FINAL} SELECT CAST(c_custkey AS VARCHAR) AS daycare_id, c_name AS name, CAST(trust_score AS VARCHAR) AS trust_score, 'e' AS trust_score_explanation, 'Standard' AS ranking_tier,
  CAST(c_custkey % 26 AS VARCHAR) AS teacher_score, s_suppkey % 50 / 10 AS review_score, CAST(s_suppkey AS VARCHAR) AS review_count, CAST(c_custkey % 30 AS VARCHAR) AS min_age_months,
  c_mktsegment AS program_type, CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'true' ELSE 'false' END AS meals_provided,
  CASE WHEN c_custkey % 2 = 0 THEN 'NAEYC,X' ELSE '' END AS certifications, CAST(c_custkey % 200 AS VARCHAR) AS capacity,
  CASE WHEN s_suppkey IS NOT NULL THEN {sql_pick("c_custkey", '{"open":1}', None)} END AS operating_hours, 'false' AS is_internal,
  CASE WHEN c_custkey % 2 = 0 THEN 'http://t/' ELSE 'local/' END || c_custkey || '.png' AS thumbnail_url, 'H' || c_custkey AS headline,
  {sql_truncate("description_text")} AS description, 't1,t2' AS search_tags, 'http://maps/' || s_suppkey AS google_maps_url, 'pl' || s_suppkey AS google_place_id,
  COALESCE(NULLIF(CASE WHEN s_suppkey IS NOT NULL THEN place_web END, ''), own_web) AS website_url,
  CASE WHEN COALESCE(NULLIF(place_web, ''), NULLIF(own_web, '')) IS NULL THEN 'false' WHEN c_custkey % 4 = 1 THEN 'false' ELSE 'true' END AS website_active,
  COALESCE(NULLIF(CASE WHEN s_suppkey IS NOT NULL THEN place_phone END, ''), '512' || c_custkey) AS phone,
  COALESCE(NULLIF(CASE WHEN s_suppkey IS NOT NULL THEN place_address END, ''), c_custkey || ' Main St') AS address, n_name AS city, 'US' AS country,
  CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
  array_to_string(list_transform(range(0, c_custkey % 3 + 1), lambda i: 'ph/' || c_custkey || '_' || i || '.jpg'), ',') AS photos FROM f""",
)
def q_finalize_flatten(spark, sf):
    text = lambda c: F.col(c).cast("string").alias(c)
    joined = lambda c: F.array_join(c, ",").alias(c)
    return final_records(spark, sf).select(
        "daycare_id", "name", text("trust_score"), "trust_score_explanation", "ranking_tier",
        F.col("score_breakdown.teacher_quality.score").cast("string").alias("teacher_score"),
        "review_score", text("review_count"), text("min_age_months"), "program_type", text("meals_provided"), joined("certifications"),
        text("capacity"), "operating_hours", text("is_internal"), "thumbnail_url", "headline", "description", joined("search_tags"),
        "google_maps_url", "google_place_id", "website_url", text("website_active"), "phone", "address", "city", "country", "latitude",
        "longitude", joined("photos"),
    )


@query("q_apply_model")
def q_apply_model(spark, sf):
    """Rows-only: a stand-in function that fails on some prompts."""

    def make():
        def call(prompt: str):
            if len(prompt) % 17 == 0:
                raise ValueError("refused")
            return prompt[::-1], len(prompt), len(prompt) // 2

        return call

    prompts = table(spark, sf, "documents", "doc_id", "text").select(F.col("doc_id").cast("string").alias("daycare_id"), F.col("text").alias("prompt"))
    return model_calls.apply_model(prompts, make, fixed.RESEARCH_STEP, first_wait=0.0)


@query(
    "q_run_model",
    """SELECT CAST(c_custkey AS VARCHAR) AS daycare_id, upper(c_name) AS reply, CAST(length(c_name) AS BIGINT) AS input_tokens,
  CAST(CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 1 END AS BIGINT) AS stored FROM customer""",
)
def q_run_model(spark, sf):
    """Two runs over one reply store: the first fails on every third record, the second asks for those alone."""

    def stand_in(broken: bool):
        def make():
            def call(prompt: str):
                if broken and int(prompt.rsplit("#", 1)[1]) % 3 == 0:
                    raise ValueError("no reply")
                return prompt.upper(), len(prompt), 1

            return call

        return make

    store = durable_path(spark, "replies")
    prompts = table(spark, sf, "customer", "c_custkey", "c_name").select(F.col("c_custkey").cast("string").alias("daycare_id"), F.col("c_name").alias("prompt"))
    model_calls.run_model(prompts, stand_in(True), fixed.RESEARCH_STEP, store, tries=1, in_flight=4)
    replies = model_calls.run_model(prompts, stand_in(False), fixed.RESEARCH_STEP, store, tries=1, in_flight=4)
    stored = model_calls.stored_replies(spark, store, fixed.RESEARCH_STEP).groupBy("daycare_id").agg(F.count("*").alias("stored"))
    return replies.where(F.col("error").isNull()).join(stored, "daycare_id").select("daycare_id", "reply", "input_tokens", "stored")
