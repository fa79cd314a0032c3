"""Publishing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rosterforge.catalog import base as b
from rosterforge.catalog.base import pick, query, sql_pick, table
from rosterforge.catalog.synth import SQL_FINAL, final_records
from rosterforge.functions.replies import epoch_to_iso
from rosterforge.operators import publish as p
from rosterforge.session import durable_path
from rosterforge.sinks import buckets

BASE = "https://files.org/"


@query(
    "q_location_wkt",
    f"""WITH {SQL_FINAL} SELECT CAST(c_custkey AS VARCHAR) AS daycare_id, 'ACTIVE' AS status,
  CASE WHEN c_custkey % 2 = 0 THEN 'http://t/' || c_custkey || '.png' ELSE '{BASE}' || c_custkey || '/' || c_custkey || '.png' END AS thumbnail_url,
  'e' AS explanation, 'Standard' AS tier, CASE WHEN latitude <> 0 AND longitude <> 0 THEN 'SRID=4326;POINT(' || CAST(longitude AS DOUBLE) || ' ' || CAST(latitude AS DOUBLE) || ')' END AS location
FROM f""",
)
def q_location_wkt(spark, sf):
    return p.listing_rows(final_records(spark, sf), BASE).select(
        "daycare_id", "status", "thumbnail_url", "score_breakdown.explanation", "score_breakdown.tier", "location"
    )


_PATHS = ["=concat('a/b/', doc_id, '.png')", "=concat('http://x/', doc_id, '.jpg')", None, "", "=concat('c', doc_id, '.JPEG')"]
_SQL_PATHS = ["='a/b/' || doc_id || '.png'", "='http://x/' || doc_id || '.jpg'", None, "", "='c' || doc_id || '.JPEG'"]
_EXT = ["webp", "pdf", "bin", "jpg"]


def with_paths(spark, sf):
    return table(spark, sf, "documents").select(
        F.concat(F.lit("d"), "doc_id").alias("daycare_id"), pick("doc_id", *_PATHS).alias("thumbnail_url"),
        F.expr(f"transform(sequence(0, CAST(doc_id % 3 AS INT)), i -> concat('ph/', doc_id, '_', i, '.', {_pick_ext('doc_id + i')}))").alias("photos"),
        F.expr("CASE WHEN doc_id % 4 = 0 THEN concat('sv/', doc_id, '/x.jpg') END").alias("street_view_path"),
    )


def _pick_ext(key: str) -> str:
    return f"element_at(array({', '.join(repr(e) for e in _EXT)}), CAST(({key}) % {len(_EXT)} + 1 AS INT))"


_SQL_UPLOADS = f"""d AS (SELECT doc_id, 'd' || doc_id AS id, {sql_pick("doc_id", *_SQL_PATHS)} AS thumb FROM documents),
ph AS (SELECT doc_id, id, unnest(range(0, doc_id % 3 + 1)) AS i FROM d),
up AS (SELECT id AS daycare_id, 'thumbnail' AS kind, thumb AS local_path, id || '/' || split_part(thumb, '/', -1) AS target FROM d WHERE thumb <> '' AND NOT starts_with(thumb, 'http')
  UNION ALL SELECT id, 'google_street_view', 'sv/' || doc_id || '/x.jpg', id || '/street_view.jpg' FROM d WHERE doc_id % 4 = 0
  UNION ALL SELECT id, 'google_photo', 'ph/' || doc_id || '_' || i || '.' || e, id || '/google_photos/' || doc_id || '_' || i || '.' || e
    FROM (SELECT *, list_extract([{', '.join(repr(e) for e in _EXT)}], CAST((doc_id + i) % {len(_EXT)} + 1 AS INTEGER)) AS e FROM ph))"""


@query(
    "q_upload_plan",
    f"""WITH {_SQL_UPLOADS} SELECT *, CASE lower(split_part(local_path, '.', -1)) WHEN 'png' THEN 'image/png' WHEN 'jpg' THEN 'image/jpeg' WHEN 'jpeg' THEN 'image/jpeg'
  WHEN 'webp' THEN 'image/webp' WHEN 'pdf' THEN 'application/pdf' ELSE 'application/octet-stream' END AS content_type FROM up""",
)
def q_upload_plan(spark, sf):
    return p.upload_plan(with_paths(spark, sf))


@query(
    "q_asset_rows",
    f"""WITH {_SQL_UPLOADS} SELECT daycare_id, '{BASE}' || target AS url, 'image' AS type, kind AS source FROM up WHERE kind <> 'thumbnail'""",
)
def q_asset_rows(spark, sf):
    return p.asset_rows(p.upload_plan(with_paths(spark, sf)), BASE)


@query(
    "q_replace_slice",
    """WITH new AS (SELECT user_id, event_type, event_id FROM events WHERE value >= 40 AND user_id % 3 = 0),
old AS (SELECT user_id, event_type, event_id FROM events WHERE NOT (value >= 40 AND user_id % 3 = 0))
SELECT * FROM old WHERE NOT (event_type IN ('click', 'view') AND user_id IN (SELECT user_id FROM new)) UNION ALL SELECT * FROM new""",
)
def q_replace_slice(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    is_new = "value >= 40 AND user_id % 3 = 0"
    old, new = events.where(f"NOT ({is_new})").drop("value"), events.where(is_new).drop("value")
    return p.replace_slice(old, new, "user_id", "event_type", ["click", "view"])


_TIMES = ["=CAST(timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) AS STRING)", "0", "", None, "x", "=concat(' ', CAST(timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) AS STRING), ' ')"]
_SQL_TIMES = ["=CAST(floor(epoch(ts)) AS BIGINT)", "0", "", None, "x", "=' ' || CAST(floor(epoch(ts)) AS BIGINT) || ' '"]


@query(
    "q_epoch_ts",
    f"""WITH r AS (SELECT event_id, TRY_CAST(trim({sql_pick("event_id", *_SQL_TIMES)}) AS BIGINT) AS s FROM events)
SELECT event_id, CASE WHEN s <> 0 THEN strftime(make_timestamp(s * 1000000), '%Y-%m-%dT%H:%M:%S') END AS at FROM r""",
)
def q_epoch_ts(spark, sf):
    return table(spark, sf, "events").select("event_id", epoch_to_iso(pick("event_id", *_TIMES)).alias("at"))


@query(
    "q_reviews_explode",
    """WITH l AS (SELECT conv_id, turn, role, string_split(text, chr(10)) AS l FROM conversations),
r AS (SELECT 'c' || conv_id AS daycare_id, turn, role, unnest(l) AS text, generate_subscripts(l, 1) - 1 AS ord, len(l) AS n FROM l),
s AS (SELECT daycare_id, 'google' AS source, CASE WHEN length(text) % 5 = 0 THEN NULL ELSE role || length(text) % 3 END AS author_name, length(text) % 7 AS rating, text,
  CASE WHEN length(text) % 2 = 0 THEN NULL ELSE strftime(make_timestamp(CAST(1700000000 + length(text) % 4 AS BIGINT) * 1000000), '%Y-%m-%dT%H:%M:%S') END AS published_time, turn * 100000 + ord AS ord FROM r),
k AS (SELECT *, row_number() OVER (PARTITION BY daycare_id, source, author_name, published_time ORDER BY ord DESC) AS nth FROM s WHERE rating BETWEEN 1 AND 5)
SELECT daycare_id, source, author_name, CAST(rating AS INTEGER) AS rating, text, published_time FROM k WHERE nth = 1""",
)
def q_reviews_explode(spark, sf):
    review = lambda t: F.struct(
        F.when(F.char_length(t) % 5 != 0, F.concat(F.col("role"), F.char_length(t) % 3)).alias("author_name"),
        (F.char_length(t) % 7).alias("rating"),
        t.alias("text"),
        F.when(F.char_length(t) % 2 != 0, F.char_length(t) % 4 + 1700000000).cast("long").alias("time"),
    )
    records = table(spark, sf, "conversations").select(
        F.concat(F.lit("c"), "conv_id").alias("daycare_id"), "turn", F.transform(F.split("text", "\n"), review).alias("reviews")
    )
    # rows of one listing come from several turns: their order goes on
    rows = p.review_rows(records.select("daycare_id", "reviews", "turn"), "turn")
    unique = p.latest(rows, p.REVIEW_KEY, [F.col("turn").desc(), F.col("ord").desc()])
    return unique.select(
        "daycare_id", "source", "author_name", "rating", "text",
        epoch_to_iso(F.unix_seconds("published_time")).alias("published_time"),
    )


@query(
    "q_upsert_latest",
    """WITH old AS (SELECT * FROM (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS nth FROM events WHERE NOT (event_id % 2 = 0 AND user_id % 4 <> 0)) WHERE nth = 1),
new AS (SELECT * FROM (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS nth FROM events WHERE event_id % 2 = 0 AND user_id % 4 <> 0) WHERE nth = 1)
SELECT user_id, event_id, event_type FROM old WHERE user_id NOT IN (SELECT user_id FROM new) UNION ALL SELECT user_id, event_id, event_type FROM new""",
)
def q_upsert_latest(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type")
    newest = [F.col("event_id").desc()]
    is_new = "event_id % 2 = 0 AND user_id % 4 <> 0"
    existing = p.latest(events.where(f"NOT ({is_new})"), ["user_id"], newest)
    return p.upsert(existing, events.where(is_new), ["user_id"], newest)


@query(
    "q_upsert_plan",
    """SELECT user_id, event_id, event_type FROM (
  SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id % 3 DESC, event_id DESC) AS nth
  FROM events) WHERE nth = 1""",
)
def q_upsert_plan(spark, sf):
    """Three runs in a row, of rows that the first, second and third part of the events bring."""
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type")
    root = durable_path(spark, "upsert-plan")
    for run in range(3):
        buckets.upsert(events.where(F.col("event_id") % 3 == run), root, ["user_id"], [F.col("event_id").desc()], n_buckets=64)
    return buckets.current(spark, root, events.schema)


@query(
    "q_enrichment_gate",
    f"""WITH r AS (SELECT d.doc_id, CASE quality WHEN 1 THEN lang WHEN 0 THEN '' END AS s, CASE toxic WHEN 1 THEN source END AS t, {sql_pick("d.doc_id", "", None, "staff")} AS u,
  (d.doc_id % 5) = 0 AS linked FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT CAST(doc_id AS VARCHAR) AS daycare_id, s AS safety_summary, t AS reputation_summary, u AS staff_summary, CASE WHEN linked THEN 'u' || doc_id ELSE '' END AS sources
FROM r WHERE s <> '' OR t <> '' OR u <> '' OR linked""",
)
def q_enrichment_gate(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "lang", "source").join(table(spark, sf, "labels"), "doc_id", "left")
    url = F.expr("concat('u', doc_id)")
    research = rows.select(
        F.col("doc_id").cast("string").alias("daycare_id"),
        F.expr("CASE quality WHEN 1 THEN lang WHEN 0 THEN '' END").alias("safety_summary"),
        F.expr("CASE toxic WHEN 1 THEN source END").alias("reputation_summary"),
        pick("doc_id", "", None, "staff").alias("staff_summary"),
        F.lit(None).cast("string").alias("operational_info"),
        F.when(F.col("doc_id") % 5 == 0, F.array(F.struct(url.alias("url"), url.alias("title"), url.alias("source_name"))))
        .otherwise(F.array().cast("array<struct<url:string,title:string,source_name:string>>")).alias("verified_sources"),
    )
    kept = p.enrichment_rows(research, F.lit("2024-01-01"))
    return kept.select(
        "daycare_id", "safety_summary", "reputation_summary", "staff_summary",
        F.array_join(F.transform("verified_sources", lambda s: s["url"]), ",").alias("sources"),
    )


_IDS = ["=CAST(doc_id AS STRING)", "=CAST(doc_id AS STRING)", "", None]
_SQL_IDS = ["=d.doc_id", "=d.doc_id", "", None]


@query(
    "q_publish_outcome",
    f"""WITH r AS (SELECT d.doc_id, quality IS NULL AS none, CASE WHEN toxic = 1 THEN 'boom' ELSE '' END AS crash, {sql_pick("d.doc_id", *_SQL_IDS)} AS id, CASE WHEN d.doc_id % 6 = 1 THEN '' ELSE lang END AS name
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
j AS (SELECT CASE WHEN none THEN 'missing_final' WHEN crash <> '' THEN 'error_crash' WHEN {b.sql_blank("id")} THEN 'missing_id' WHEN name = '' THEN 'invalid_name' END AS reason FROM r)
SELECT CAST(count(*) AS BIGINT) AS fetched, CAST(count(*) FILTER (WHERE reason IS NULL) AS BIGINT) AS published, CAST(count(reason) AS BIGINT) AS failed FROM j""",
)
def q_publish_outcome(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id", "left")
    final = F.when(
        F.col("quality").isNotNull(),
        F.struct(pick("doc_id", *_IDS).alias("daycare_id"), F.expr("CASE WHEN doc_id % 6 = 1 THEN '' ELSE lang END").alias("name")),
    )
    crash = F.when(F.col("toxic") == 1, "boom").otherwise("")
    return p.publish_counts(rows.select(final.alias("final"), crash.alias("crash")).select(
        p.publish_reason(F.col("final"), F.col("crash")).alias("reason")
    ))
