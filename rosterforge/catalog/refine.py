"""Refinement queries: documents as text files, their source as site."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterforge import fixed
from rosterforge.catalog import base as b
from rosterforge.catalog.base import pick, query, sql_pick, table
from rosterforge.operators import images, refine, selection
from rosterforge.operators.ordering import first_n_per

# lines put in front of every file
EXTRA = [
    "URL: http://x.org/a\n\n", "Copyright 2024 by us all here\nAbout our school program today\n", "View our MENU today please\n",
    "Our Team\nHours:\n", "ABOUT US\nABOUT\n", "Cart (3)\n  Sign in to your parent account  \n", "URL: http://x.org/b\nOpen from seven to six daily\n",
    "Open from seven to six daily\n", " Contact the front desk any time \n",
]


def files(spark: SparkSession, sf: str) -> DataFrame:
    # escapes of the extra lines are read by the SQL parser
    extra = [e.replace("\n", "\\n") for e in EXTRA]
    options = ", ".join("'" + e + "'" for e in extra)
    front = F.expr(f"element_at(array({options}), CAST(doc_id % {len(EXTRA)} + 1 AS INT))")
    return table(spark, sf, "documents", "source", "doc_id", "text").select(
        F.col("source").alias("domain"), F.concat(F.lit("doc_"), "doc_id", F.lit(".txt")).alias("file"),
        F.col("doc_id").alias("ord"), F.concat(front, F.col("text")).alias("text"),
    )


_SQL_EXTRA = "list_extract([" + ", ".join("'" + e.replace("\n", "' || chr(10) || '") + "'" for e in EXTRA) + f"], CAST(doc_id % {len(EXTRA)} + 1 AS INTEGER))"
_LINE = b.sql_strip("raw")
SQL_LINES = f"""files AS (SELECT source AS domain, 'doc_' || doc_id || '.txt' AS file, doc_id AS ord, {_SQL_EXTRA} || text AS text FROM documents),
split AS (SELECT domain, file, ord, string_split(text, chr(10)) AS l FROM files),
raws AS (SELECT domain, file, ord, unnest(l) AS raw, generate_subscripts(l, 1) AS n FROM split),
lines AS (SELECT domain, file, ord, n, {_LINE} AS line FROM raws WHERE NOT starts_with(raw, 'URL:') AND {_LINE} <> ''),
sizes AS (SELECT domain, count(*) AS n_files FROM files GROUP BY domain),
counted AS (SELECT domain, line, count(*) AS occurrences FROM lines GROUP BY domain, line),
common AS (SELECT domain, line, occurrences, n_files FROM counted JOIN sizes USING (domain) WHERE occurrences > greatest(2.0, n_files * 0.5))"""


def sql_noise(x: str) -> str:
    return f"regexp_matches({x}, '(?i){'|'.join(fixed.NOISE_PATTERNS)}')"


def sql_short(x: str) -> str:
    words = f"len(regexp_split_to_array({x}, '{b.SQL_SPACE}+'))"
    return f"({words} < 4 AND NOT ({x} LIKE '%:' OR (upper({x}) = {x} AND lower({x}) <> {x} AND length({x}) > 5)))"


SQL_KEPT = f"""{SQL_LINES}, kept AS (SELECT l.* FROM lines l LEFT JOIN common c ON l.domain = c.domain AND l.line = c.line
  WHERE c.line IS NULL AND NOT {sql_noise("l.line")} AND NOT {sql_short("l.line")})"""


@query("q_boilerplate", f"WITH {SQL_LINES} SELECT domain, line, CAST(occurrences AS BIGINT) AS occurrences, CAST(n_files AS BIGINT) AS n_files FROM common")
def q_boilerplate(spark, sf):
    return refine.boilerplate_lines(files(spark, sf)).select("domain", "line", "occurrences", "n_files")


@query(
    "q_refine_lines",
    f"""WITH {SQL_KEPT} SELECT f.domain, f.file, CAST(count(k.line) AS BIGINT) AS n_lines, md5(COALESCE(string_agg(k.line, chr(10) ORDER BY k.n), '')) AS lines_md5
FROM files f LEFT JOIN kept k ON f.domain = k.domain AND f.file = k.file GROUP BY f.domain, f.file""",
)
def q_refine_lines(spark, sf):
    return refine.refined_lines(files(spark, sf)).select(
        "domain", "file", F.size("lines").cast("long").alias("n_lines"), F.md5(F.array_join("lines", "\n")).alias("lines_md5")
    )


def site_documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "benchmark").select(
        F.concat(F.lit("src"), F.col("item_id") % 22).alias("domain"), F.concat(F.lit("d"), "item_id", F.lit(".pdf")).alias("file"),
        F.col("item_id").alias("ord"), F.array(F.concat("text", F.lit("\n\n\n")), F.lit(""), F.col("text")).alias("pages"),
    )


@query(
    "q_refine_body",
    f"""WITH {SQL_KEPT},
blocks AS (SELECT domain, 0 AS part, ord, '--- Source: ' || file || ' ---' || chr(10) || string_agg(line, chr(10) ORDER BY n) || chr(10) || chr(10) AS block
  FROM kept GROUP BY domain, file, ord UNION ALL
  SELECT 'src' || (item_id % 22), 1, item_id, chr(10) || '--- Source: d' || item_id || '.pdf (PDF) ---' || chr(10) || chr(10) ||
    regexp_replace(text || repeat(chr(10), 4) || text, '\\n{{3,}}', chr(10) || chr(10), 'g') || chr(10) || chr(10) FROM benchmark WHERE 'src' || (item_id % 22) IN (SELECT domain FROM files)),
bodies AS (SELECT domain, string_agg(block, chr(10) ORDER BY part, ord) AS body FROM blocks GROUP BY domain)
SELECT domain, md5(CASE WHEN length(body) > 100000 THEN substr(body, 1, 100000) || chr(10) || '...[Truncated]...' ELSE body END) AS body_md5,
  CAST(length(body) AS BIGINT) AS full_chars FROM bodies""",
)
def q_refine_body(spark, sf):
    bodies = refine.site_bodies(files(spark, sf), site_documents(spark, sf))
    return bodies.select("domain", F.md5("body").alias("body_md5"), "full_chars")


PDF_NAMES = [
    "http://x.org/Parent-Handbook.pdf", "http://x.org/lunch-menu.pdf", "http://x.org/calendar-update.pdf", "", None,
    "http://x.org/Tuition-Rates-Enroll.pdf", "http://x.org/a.pdf",
]


@query(
    "q_pdf_rank",
    f"""WITH d AS (SELECT source, doc_id, {sql_pick("doc_id", *PDF_NAMES)} AS original_url,
  'assets/' || {sql_pick("doc_id // 2", "policy", "flyer", "x")} || doc_id || '.pdf' AS local_path FROM documents),
t AS (SELECT *, lower(COALESCE(NULLIF(original_url, ''), split_part(local_path, '/', -1))) AS t FROM d),
s AS (SELECT source, doc_id, local_path, {" + ".join(f"CASE WHEN contains(t, '{w}') THEN 2 ELSE 0 END" for w in fixed.PDF_PRIORITY_WORDS)}
  - {" - ".join(f"CASE WHEN contains(t, '{w}') THEN 1 ELSE 0 END" for w in fixed.PDF_LOW_WORDS)} AS score FROM t)
SELECT source, doc_id, local_path, CAST(score AS INTEGER) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, doc_id) AS nth FROM s) WHERE nth <= 5""",
)
def q_pdf_rank(spark, sf):
    documents = table(spark, sf, "documents").select(
        "source", "doc_id", F.col("doc_id").alias("ord"), pick("doc_id", *PDF_NAMES).alias("original_url"),
        F.concat(F.lit("assets/"), pick("doc_id div 2", "policy", "flyer", "x"), "doc_id", F.lit(".pdf")).alias("local_path"),
    )
    return refine.rank_documents(documents, "source").select("source", "doc_id", "local_path", "score")


def image_files(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        "label", "vec_id", F.expr("concat('img_', vec_id, '.jpg')").alias("path"), F.col("embedding").alias("vector"),
        F.expr("element_at(array(20000, 5001, 5000, 800), CAST(vec_id % 4 + 1 AS INT))").alias("size_bytes"),
    )


@query(
    "q_image_rank",
    """WITH p AS (SELECT vec_id AS ord, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id < 24),
i AS (SELECT label, vec_id, 'img_' || vec_id || '.jpg' AS path, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE list_extract([20000, 5001, 5000, 800], CAST(vec_id % 4 + 1 AS INTEGER)) > 5000),
l AS (SELECT label, path, ord, 100 * list_cosine_similarity(i.v, p.v) AS logit FROM i, p),
m AS (SELECT *, exp(logit - max(logit) OVER (PARTITION BY path)) AS w FROM l),
s AS (SELECT label, path, (sum(w) FILTER (WHERE ord < 12) - sum(w) FILTER (WHERE ord >= 12)) / sum(w) AS score FROM m GROUP BY label, path)
SELECT label, path, round(score, 4) AS score FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, path) AS nth FROM s) WHERE nth <= 10""",
)
def q_image_rank(spark, sf):
    prompts = table(spark, sf, "embeddings").where("vec_id < 24").select(F.col("vec_id").alias("ord"), F.col("embedding").alias("vector"))
    ranked = images.rank_images(image_files(spark, sf), prompts, "label")
    return ranked.select("label", "path", F.round("score", 4).alias("score"))


@query(
    "q_image_candidates",
    """WITH a AS (SELECT o_orderkey, list_concat(
    list_transform(range(0, o_orderkey % 9), lambda i: 'site/' || ((o_orderkey + i * i) % 7) || '.jpg'),
    list_transform(range(0, o_custkey % 8), lambda i: CASE WHEN i % 2 = 0 THEN 'site/' || ((o_custkey + i) % 7) || '.jpg' ELSE 'photo_' || i || '.jpg' END)) AS l FROM orders)
SELECT o_orderkey, array_to_string(list_slice(list_filter(l, lambda x, i: list_position(l, x) = i), 1, 10), ',') AS candidates FROM a""",
)
def q_image_candidates(spark, sf):
    site_images = F.expr("transform(slice(sequence(0, 9), 1, CAST(o_orderkey % 9 AS INT)), i -> concat('site/', (o_orderkey + i * i) % 7, '.jpg'))")
    photos = F.expr(
        """transform(slice(sequence(0, 9), 1, CAST(o_custkey % 8 AS INT)),
        i -> CASE WHEN i % 2 = 0 THEN concat('site/', (o_custkey + i) % 7, '.jpg') ELSE concat('photo_', i, '.jpg') END)"""
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", F.array_join(images.image_candidates(site_images, photos), ",").alias("candidates")
    )


# --- limits -----------------------------------------------------------------

@query(
    "q_limit_per_source",
    "SELECT source, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS nth FROM documents) WHERE nth <= 20",
)
def q_limit_per_source(spark, sf):
    documents = table(spark, sf, "documents").select("source", "doc_id")
    return selection.first_per_source(documents, 20, "source", "doc_id")


@query("q_sample")
def q_sample(spark, sf):
    """Rows-only: a sample; its size and repeatability are tested."""
    documents = table(spark, sf, "documents").select("source", "doc_id")
    return selection.sample_per_source(documents, 20, 7, "source", "doc_id")


@query(
    "q_limit_after_filter",
    """SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) ORDER BY doc_id LIMIT 100""",
)
def q_limit_after_filter(spark, sf):
    good = table(spark, sf, "labels").where("quality = 1")
    documents = table(spark, sf, "documents").select("doc_id", "source")
    return selection.first_rows(selection.only_ids(documents, good, "doc_id"), 100, "doc_id")


@query(
    "q_limit_before_gate",
    """SELECT doc_id, source FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 100) WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)""",
)
def q_limit_before_gate(spark, sf):
    good = table(spark, sf, "labels").where("quality = 1")
    documents = table(spark, sf, "documents").select("doc_id", "source")
    return selection.only_ids(selection.first_rows(documents, 100, "doc_id"), good, "doc_id")


@query(
    "q_limit_many_per_group",
    """SELECT l_returnflag, l_orderkey, l_linenumber FROM (
  SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey DESC, l_linenumber) AS nth FROM lineitem) WHERE nth <= 5000""",
)
def q_limit_many_per_group(spark, sf):
    """More rows a group than Spark's own group limit takes."""
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber")
    return first_n_per(lines, "l_returnflag", [F.col("l_orderkey").desc(), F.col("l_linenumber")], 5000)


@query(
    "q_limit_many",
    """WITH p AS (SELECT concat(o_orderpriority, '/', o_orderkey) AS place, o_orderkey, o_custkey FROM orders)
SELECT * FROM p ORDER BY place LIMIT 5000""",
)
def q_limit_many(spark, sf):
    """The first rows by a text column."""
    orders = table(spark, sf, "orders")
    place = F.concat_ws("/", "o_orderpriority", F.col("o_orderkey").cast("string"))
    return selection.first_rows(orders.select(place.alias("place"), "o_orderkey", "o_custkey"), 5000, "place")
