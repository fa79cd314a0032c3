"""Site queries over stored pages, and a walk over links between customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterforge import fixed
from rosterforge.catalog import base as b
from rosterforge.catalog.base import pick, query, sql_pick, table
from rosterforge.functions import images as im
from rosterforge.functions import urls as u
from rosterforge.functions.text import SPACES
from rosterforge.operators import site
from rosterforge.operators.frontier import crawl
from rosterforge.session import durable

SUFFIXES = ["", ".pdf", ".JPG", ".png", ".webp", ".jpeg", ".pdf?x=1", ".html", ".webp#a"]
URL = f"(url || {sql_pick('page_id', *SUFFIXES)})"


def urls(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", F.concat("url", pick("page_id", *SUFFIXES)).alias("url"))


@query("q_clean_url", rf"SELECT page_id, regexp_replace({URL}, '^([^?#]*)\?[^#]*', '\1') AS clean FROM pages")
def q_clean_url(spark, sf):
    return urls(spark, sf).select("page_id", u.clean_url(F.col("url")).alias("clean"))


_DOMAIN_FORMS = ["=url", "=concat('https://www.', substring_index(url, '://', -1))", "=concat('HTTPS://User@Www.', page_id, '.org:8080/x')", "no url"]
_SQL_DOMAIN_FORMS = ["=url", "='https://www.' || split_part(url, '://', 2)", "='HTTPS://User@Www.' || page_id || '.org:8080/x'", "no url"]


@query("q_domain", f"SELECT page_id, {b.sql_domain(sql_pick('page_id', *_SQL_DOMAIN_FORMS))} AS domain FROM pages")
def q_domain(spark, sf):
    return table(spark, sf, "pages").select("page_id", u.site_domain(pick("page_id", *_DOMAIN_FORMS)).alias("domain"))


@query(
    "q_asset_name",
    f"""SELECT page_id, 'content_' || md5({URL}) || '.txt' AS text_name, 'doc_' || md5({URL}) || '.pdf' AS pdf_name,
  'img_' || md5({URL}) || CASE WHEN {URL} LIKE '%.png' THEN '.png' WHEN {URL} LIKE '%.webp' THEN '.webp' ELSE '.jpg' END AS image_name
FROM pages""",
)
def q_asset_name(spark, sf):
    url = F.col("url")
    return urls(spark, sf).select(
        "page_id", u.text_asset_name(url).alias("text_name"), u.pdf_asset_name(url).alias("pdf_name"),
        u.image_asset_name(url).alias("image_name"),
    )


@query(
    "q_asset_classify",
    f"""SELECT page_id, CASE WHEN lower({URL}) LIKE '%.pdf' THEN 'pdf' WHEN regexp_matches(lower({URL}), '\\.(jpg|jpeg|png|webp)$')
  THEN 'image' END AS kind FROM pages""",
)
def q_asset_classify(spark, sf):
    return urls(spark, sf).select("page_id", u.asset_kind(F.col("url")).alias("kind"))


# --- pages ------------------------------------------------------------------

def _q(pattern: str) -> str:
    return pattern.replace("'", "''")


# The SQL reads a page as pieces between "<": a tag, then ">" and text.  It holds for the given pages: no ">" inside
# quotes, comments without tags, double-quoted links, and the references that they use.
_SQL_REFERENCES = [
    ("&copy;", "\u00a9"), ("&middot;", "\u00b7"), ("&quot;", '"'), ("&#8217;", "\u2019"), ("&#x27;", "'"),
    ("&iacute;", "\u00ed"), ("&Eacute;", "\u00c9"), ("&amp;", "&"),
]


def sql_decode(x: str) -> str:
    for reference, character in _SQL_REFERENCES:
        x = f"replace({x}, '{_q(reference)}', '{_q(character)}')"
    return x


def sql_pieces(html: str) -> str:
    """`shown(page_id, url, i, tag, piece, txt)`: the pieces outside of hidden elements."""
    return f"""cut AS (SELECT page_id, url, string_split({html}, '<') AS pieces FROM pages),
piece AS (SELECT page_id, url, unnest(range(1, len(pieces) + 1)) AS i, unnest(pieces) AS piece FROM cut),
tagged AS (SELECT *, CASE WHEN i = 1 THEN '' ELSE lower(split_part(split_part(translate(piece, chr(10) || chr(9), '  '), '>', 1), ' ', 1)) END AS tag,
  CASE WHEN i = 1 THEN piece ELSE substr(piece, strpos(piece, '>') + 1) END AS txt FROM piece),
covered AS (SELECT *, sum(CASE WHEN tag IN ('script', 'style', 'noscript', 'template', 'head') THEN 1
  WHEN tag IN ('/script', '/style', '/noscript', '/template', '/head') THEN -1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY i) AS covers FROM tagged),
shown AS (SELECT page_id, url, i, tag, piece, txt FROM covered WHERE covers = 0)"""


SQL_LINKS = f"""{sql_pieces("html")},
hrefs AS (SELECT page_id, url, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS ord,
  {sql_decode(b.sql_strip("split_part(split_part(piece, 'href=' || chr(34), 2), chr(34), 1)"))} AS href
  FROM shown WHERE tag = 'a' AND contains(piece, ' href=' || chr(34))),
links AS (SELECT page_id, url, ord, href, CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href
  WHEN href LIKE '/%' THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || href
  ELSE regexp_extract(split_part(split_part(url, '#', 1), '?', 1), '^(.*/)', 1) || href END AS link FROM hrefs)"""


@query("q_link_extract", f"WITH {SQL_LINKS} SELECT url, ord, href, link FROM links")
def q_link_extract(spark, sf):
    return site.extract_links(table(spark, sf, "pages", "url", "html"))


_NORMAL = "regexp_replace(split_part(link, '#', 1), '/+$', '')"


@query(
    "q_link_filter",
    f"""WITH {SQL_LINKS}, n AS (SELECT url, ord, {_NORMAL} AS dst FROM links)
SELECT {b.sql_domain("url")} AS domain, url AS src, dst, ord, {b.sql_any("lower(dst)", fixed.PRIORITY_LINK_WORDS)} AS priority
FROM n WHERE dst LIKE 'http%' AND {b.sql_domain("url")} = {b.sql_domain("dst")} AND NOT {b.sql_any("lower(dst)", fixed.BLOCKED_LINK_WORDS)}""",
)
def q_link_filter(spark, sf):
    return site.follow_links(site.extract_links(table(spark, sf, "pages", "url", "html")))


_BLOCKS = (
    "br p div li ul ol h1 h2 h3 h4 h5 h6 tr table section article main header footer nav aside form blockquote pre "
    "dl dt dd figure figcaption address hr"
)


def _sql_page_text(html: str = "html") -> str:
    """Nesting by running counts: an element ends where its name's depth falls below that of its start tag."""
    blocks = ", ".join(f"'{t}', '/{t}'" for t in _BLOCKS.split() if t != "br")
    words = lambda a: rf"""' ' || split_part(split_part(piece, ' {a}=' || chr(34), 2), chr(34), 1) || ' '"""
    return f"""WITH {sql_pieces(html)},
depths AS (SELECT *, ltrim(tag, '/') AS name, sum(CASE WHEN tag LIKE '/%' THEN -1 ELSE 1 END) OVER (PARTITION BY page_id, ltrim(tag, '/') ORDER BY i) AS depth FROM shown),
ranked AS (SELECT *, unnest([CASE WHEN tag = 'main' THEN 1 END, CASE WHEN tag = 'article' THEN 2 END,
  CASE WHEN contains({words("id")}, ' content ') THEN 3 END, CASE WHEN contains({words("class")}, ' content ') THEN 4 END,
  CASE WHEN contains({words("id")}, ' main ') THEN 5 END, CASE WHEN contains({words("class")}, ' main ') THEN 6 END]) AS rank FROM depths),
starts AS (SELECT page_id, rank, min(i) AS i0, arg_min(name, i) AS name, arg_min(depth, i) AS depth FROM ranked WHERE rank IS NOT NULL GROUP BY ALL),
ends AS (SELECT s.page_id, s.rank, any_value(s.i0) AS i0, min(d.i) AS i1 FROM starts s LEFT JOIN depths d
  ON d.page_id = s.page_id AND d.name = s.name AND d.i > s.i0 AND d.depth < s.depth GROUP BY s.page_id, s.rank
  UNION ALL SELECT DISTINCT page_id, 7, 0, NULL FROM shown),
texts AS (SELECT s.page_id, url, rank, string_agg(CASE WHEN tag IN ('br', {blocks}) AND i > i0 THEN chr(10) ELSE '' END
  || translate(txt, '{SPACES}', repeat(' ', {len(SPACES)})), '' ORDER BY i) AS raw
  FROM shown s JOIN ends e ON s.page_id = e.page_id AND i >= i0 AND (i1 IS NULL OR i < i1) GROUP BY s.page_id, url, rank),
clean AS (SELECT page_id, url, rank, trim(regexp_replace({sql_decode("regexp_replace(raw, '  +', ' ', 'g')")}, ' *\n[ \n]*', chr(10), 'g'), ' ' || chr(10)) AS text FROM texts),
c AS (SELECT url, arg_min(text, rank) AS text FROM clean WHERE length(text) > 200 OR rank = 7 GROUP BY page_id, url)
SELECT url, text, 'content_' || md5(url) || '.txt' AS file FROM c WHERE length(text) > 100"""


@query("q_page_text", _sql_page_text())
def q_page_text(spark, sf):
    return site.page_texts(table(spark, sf, "pages", "url", "html"))


# the pages again with their article as a nested element of another name, id or class, and as a main in a main
_NESTS = [
    ('<div class="wide content"><div>Isn&#8217;t it &#x27;Mar&iacute;a&#x27; &Eacute;?</div>', "</div><div>aside</div>"),
    ('<section id="main"><section>one</section>', "</section><section>two</section>"),
    ("<main>a<main>b</main> <b>c</b> <i>d</i>", "</main>e"),
    ('<p id="content">short</p><span class="main">', "</span>behind"),
]


def _nested(replace_in: str, key: str) -> str:
    """The same expression in both engines."""
    opens = " ".join(f"WHEN {key} % 4 = {i} THEN '{a}'" for i, (a, _) in enumerate(_NESTS))
    closes = " ".join(f"WHEN {key} % 4 = {i} THEN '{z}'" for i, (_, z) in enumerate(_NESTS))
    return f"replace(replace({replace_in}, '<article>', CASE {opens} END), '</article>', CASE {closes} END)"


@query("q_page_text_nested", _sql_page_text(_nested("html", "page_id")))
def q_page_text_nested(spark, sf):
    pages = table(spark, sf, "pages", "page_id", "url", "html")
    return site.page_texts(pages.withColumn("html", F.expr(_nested("html", "page_id"))))


def pages_with_media(spark: SparkSession, sf: str) -> DataFrame:
    """Stored pages with image and document references put in front."""
    media = F.expr(
        """concat('<IMG alt="a" src="/img/', page_id, '.png">', '<img data-src="http://cdn.org/', page_id % 9, '.webp">',
        '<img srcset="http://cdn.org/s', page_id, '.jpg 2x, b.jpg 3x">', '<img alt="none">', '<a href="/doc/', page_id % 5, '.pdf">d</a>')"""
    )
    return table(spark, sf, "pages").select("page_id", "url", F.concat(media, F.col("html")).alias("html"))


_ROOT = "regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)"


@query(
    "q_page_assets",
    f"""WITH a AS (
  SELECT url, 0 AS ord, 'image' AS type, {_ROOT} || '/img/' || page_id || '.png' AS original_url, '.png' AS ext FROM pages
  UNION ALL SELECT url, 1, 'image', 'http://cdn.org/' || (page_id % 9) || '.webp', '.webp' FROM pages
  UNION ALL SELECT url, 2, 'image', 'http://cdn.org/s' || page_id || '.jpg', '.jpg' FROM pages
  UNION ALL SELECT url, 0, 'pdf', {_ROOT} || '/doc/' || (page_id % 5) || '.pdf', '.pdf' FROM pages)
SELECT url, ord, type, original_url, CASE type WHEN 'pdf' THEN 'doc_' ELSE 'img_' END || md5(original_url) || ext AS asset_name FROM a""",
)
def q_page_assets(spark, sf):
    """The pages hold no media of their own, so only the added ones show."""
    return site.page_assets(pages_with_media(spark, sf))


@query(
    "q_asset_dedupe",
    f"""WITH {SQL_LINKS} SELECT domain, original_url, url, ord FROM (
  SELECT *, row_number() OVER (PARTITION BY domain, original_url ORDER BY url, ord, page_id) AS nth FROM (
    SELECT {b.sql_domain("url")} AS domain, link AS original_url, url, ord, page_id FROM links)) WHERE nth = 1""",
)
def q_asset_dedupe(spark, sf):
    links = site.extract_links(table(spark, sf, "pages", "url", "html")).select(
        u.site_domain(F.col("url")).alias("domain"), F.col("link").alias("original_url"), "url", "ord"
    )
    return site.dedupe_assets(links, [F.col("url"), F.col("ord")])


# --- walk -------------------------------------------------------------------
# 40 customers make a site; page i links to 2i+1, 2i+2, (i+7) % 40 and back.

WORDS = ["about", "x", "staff", "blog", "tuition", "y", "team"]


def _page_url(i: str) -> str:
    return f"=concat('http://site', c_custkey div 40, '.org/', element_at(array({', '.join(repr(w) for w in WORDS)}), CAST(({i}) % 7 + 1 AS INT)), {i})"


def _sql_page_url(i: str) -> str:
    return f"'http://site' || (c_custkey // 40) || '.org/' || list_extract([{', '.join(repr(w) for w in WORDS)}], CAST(({i}) % 7 + 1 AS INTEGER)) || ({i})"


def walk_input(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    i = "(c_custkey % 40)"
    customers = table(spark, sf, "customer").select("c_custkey")
    pages = customers.select("c_custkey", F.expr(_page_url(i)[1:]).alias("url"))
    starts = pages.where("c_custkey % 40 = 0").select(u.site_domain(F.col("url")).alias("domain"), F.col("url").alias("start_url"))
    forms = [f"2 * {i} + 1", f"2 * {i} + 2", f"({i} + 7) % 40", f"{i} div 2"]
    targets = [f"concat({_page_url(forms[0])[1:]}, '/')", _page_url(forms[1])[1:], f"concat({_page_url(forms[2])[1:]}, '/#t')", _page_url(forms[3])[1:]]
    links = pages.select(
        "url", F.posexplode(F.array(*[F.expr(t) for t in targets])).alias("ord", "link")
    )
    loaded = pages.where("c_custkey % 40 % 11 <> 5").select("url")
    return starts, site.follow_links(links), loaded


def _sql_walk() -> str:
    i = "(c_custkey % 40)"
    blocked = b.sql_any("lower(dst)", fixed.BLOCKED_LINK_WORDS)
    parts = [
        f"pages0 AS (SELECT 'site' || (c_custkey // 40) || '.org' AS domain, {i} AS i, {_sql_page_url(i)} AS url, c_custkey FROM customer)",
        f"""edges AS (SELECT domain, url AS src, {_sql_page_url(f"2 * {i} + 1")} AS dst, 0 AS ord FROM pages0
  UNION ALL SELECT domain, url, {_sql_page_url(f"2 * {i} + 2")}, 1 FROM pages0
  UNION ALL SELECT domain, url, {_sql_page_url(f"({i} + 7) % 40")}, 2 FROM pages0
  UNION ALL SELECT domain, url, {_sql_page_url(f"{i} // 2")}, 3 FROM pages0)""",
        f"links AS (SELECT *, {b.sql_any('lower(dst)', fixed.PRIORITY_LINK_WORDS)} AS priority FROM edges WHERE NOT {blocked})",
        "loaded AS (SELECT url FROM pages0 WHERE i % 11 <> 5)",
        "v0 AS (SELECT domain, url, 0 AS depth, 1 AS pos, url IN (SELECT url FROM loaded) AS loaded FROM pages0 WHERE i = 0)",
    ]
    for d in (1, 2, 3):
        only = "" if d == 1 else " AND k.priority"
        parts.append(
            f"""s{d} AS (SELECT p.domain, k.dst AS url, min(p.pos * 1000 + k.ord) AS at FROM v{d - 1} p
  JOIN links k ON k.domain = p.domain AND k.src = p.url WHERE p.depth = {d - 1} AND p.loaded{only}
  AND NOT EXISTS (SELECT 1 FROM v{d - 1} v WHERE v.domain = p.domain AND v.url = k.dst) GROUP BY 1, 2),
r{d} AS (SELECT s.domain, s.url, (SELECT max(pos) FROM v{d - 1} v WHERE v.domain = s.domain)
  + row_number() OVER (PARTITION BY s.domain ORDER BY s.at) AS pos FROM s{d} s),
v{d} AS (SELECT * FROM v{d - 1} UNION ALL SELECT domain, url, {d}, CAST(pos AS INTEGER), url IN (SELECT url FROM loaded) FROM r{d} WHERE pos <= 15)"""
        )
    return "WITH " + ",\n".join(parts) + " SELECT domain, url, depth, pos, loaded FROM v3"


@query("q_crawl_frontier", _sql_walk())
def q_crawl_frontier(spark, sf):
    starts, links, loaded = walk_input(spark, sf)
    # every layer joins the links
    return crawl(starts, durable(links, "links"), loaded)


# --- reuse and manifests ----------------------------------------------------

_PLACE_SITE = ["=url", "", None, "=url"]
_REGISTER_SITE = ["http://www.other.org/a", "=url", None, "", "https://blog.stars.org"]


@query(
    "q_domain_reuse",
    f"""WITH r AS (SELECT page_id, COALESCE(NULLIF({sql_pick("page_id", *_PLACE_SITE)}, ''), NULLIF({sql_pick("page_id", *_REGISTER_SITE)}, '')) AS target_url FROM pages),
d AS (SELECT *, COALESCE({b.sql_domain("target_url")}, NULL) AS domain FROM r),
s AS (SELECT domain, arg_min(target_url, page_id) AS start_url FROM d WHERE target_url IS NOT NULL GROUP BY domain),
m AS (SELECT DISTINCT {b.sql_domain("url")} AS domain FROM pages WHERE length(url) % 3 = 0)
SELECT page_id, target_url, start_url, CASE WHEN d.target_url IS NULL THEN 'none' WHEN m.domain IS NULL THEN 'visit' ELSE 'reuse' END AS plan
FROM d LEFT JOIN s ON d.domain = s.domain LEFT JOIN m ON d.domain = m.domain""",
)
def q_domain_reuse(spark, sf):
    target = site.target_url(pick("page_id", *_PLACE_SITE), pick("page_id", *_REGISTER_SITE))
    records = table(spark, sf, "pages").select("page_id", target.alias("target_url"), F.col("page_id").alias("_ord"))
    manifest = (
        table(spark, sf, "pages").where(F.char_length("url") % 3 == 0)
        .select(u.site_domain(F.col("url")).alias("domain")).distinct()
    )
    starts = site.start_urls(records)
    fresh = site.sites_to_visit(starts, manifest).select("domain", "start_url", F.lit("visit").alias("plan"))
    known = starts.join(manifest, "domain", "left_semi").select("domain", "start_url", F.lit("reuse").alias("plan"))
    attached = site.attach_sites(records, fresh.unionByName(known))
    return attached.select(
        "page_id", "target_url", "site.start_url", F.coalesce("site.plan", F.lit("none")).alias("plan")
    )


@query(
    "q_site_manifest",
    f"""WITH {SQL_LINKS}, v AS (SELECT {b.sql_domain("url")} AS domain, arg_min(url, page_id) AS root_url, CAST(count(*) AS INTEGER) AS pages_crawled,
  CAST(count(*) FILTER (WHERE length(html) % 5 < 3) AS INTEGER) AS pages_successful FROM pages GROUP BY 1),
a AS (SELECT {b.sql_domain("url")} AS domain, CAST(count(DISTINCT link) AS INTEGER) AS assets_found FROM links GROUP BY 1)
SELECT v.domain, root_url, 1700000000.0::DOUBLE AS timestamp, pages_crawled, pages_successful, COALESCE(assets_found, 0) AS assets_found,
  pages_successful > 0 AS website_active FROM v LEFT JOIN a ON v.domain = a.domain""",
)
def q_site_manifest(spark, sf):
    pages = table(spark, sf, "pages")
    visits = pages.select(
        u.site_domain(F.col("url")).alias("domain"), "url", F.col("page_id").alias("pos"), (F.char_length("html") % 5 < 3).alias("loaded")
    )
    links = site.extract_links(pages).select(u.site_domain(F.col("url")).alias("domain"), F.col("link").alias("original_url"), "url", "ord")
    assets = site.dedupe_assets(links, [F.col("url"), F.col("ord")])
    return site.site_manifest(visits, assets, F.lit(1700000000.0))


# --- metadata rules ---------------------------------------------------------

_W, _H, _S = "(p_partkey * 37 % 1500)", "(p_partkey * 53 % 900 + 100)", "(p_size * 500)"


@query(
    "q_asset_screen",
    f"""WITH m AS (SELECT p_partkey, {sql_pick("p_partkey", "image", "image", "pdf")} AS type, CASE WHEN p_partkey % 17 = 3 THEN NULL ELSE {_S} END AS size_bytes,
  CASE WHEN p_partkey % 19 = 4 THEN NULL ELSE {_W} END AS width, {_H} AS height FROM part)
SELECT p_partkey, CASE WHEN type = 'pdf' THEN CASE WHEN size_bytes IS NULL THEN 'unreadable' WHEN size_bytes < 5120 THEN 'small_pdf' END
  WHEN size_bytes < 10240 THEN 'small_image' WHEN size_bytes IS NULL OR width IS NULL THEN 'unreadable'
  WHEN width < 200 OR height < 200 THEN 'small_sides'
  WHEN CAST(width AS DOUBLE) / height > 3.0 OR CAST(width AS DOUBLE) / height < 0.33 THEN 'extreme_ratio' END AS reason FROM m""",
)
def q_asset_screen(spark, sf):
    assets = table(spark, sf, "part").select(
        "p_partkey", pick("p_partkey", "image", "image", "pdf").alias("type"),
        F.expr(f"CASE WHEN p_partkey % 17 = 3 THEN NULL ELSE {_S} END").alias("size_bytes"),
        F.expr(f"CASE WHEN p_partkey % 19 = 4 THEN NULL ELSE {_W} END").alias("width"), F.expr(_H).alias("height"),
    )
    return site.screen_assets(assets).select("p_partkey", "reason")


@query(
    "q_resize_dims",
    f"""WITH m AS (SELECT p_partkey, CAST({_W} * 2 + 1 AS INTEGER) AS w, CAST({_H} AS INTEGER) AS h FROM part)
SELECT p_partkey, CASE WHEN w > 1000 THEN 1000 ELSE w END AS stored_width, CASE WHEN w > 1000 THEN CAST(floor(h * (1000.0::DOUBLE / w)) AS INTEGER) ELSE h END AS stored_height,
  CASE WHEN w > 500 OR h > 500 THEN CAST(floor(w * least(500.0::DOUBLE / w, 500.0::DOUBLE / h)) AS INTEGER) ELSE w END AS model_width,
  CASE WHEN w > 500 OR h > 500 THEN CAST(floor(h * least(500.0::DOUBLE / w, 500.0::DOUBLE / h)) AS INTEGER) ELSE h END AS model_height FROM m""",
)
def q_resize_dims(spark, sf):
    sizes = table(spark, sf, "part").select(
        "p_partkey", F.expr(f"CAST({_W} * 2 + 1 AS INT)").alias("w"), F.expr(f"CAST({_H} AS INT)").alias("h")
    )
    stored, model = im.stored_size(F.col("w"), F.col("h")), im.model_size(F.col("w"), F.col("h"))
    return sizes.select(
        "p_partkey", stored["width"].alias("stored_width"), stored["height"].alias("stored_height"),
        model["width"].alias("model_width"), model["height"].alias("model_height"),
    )
