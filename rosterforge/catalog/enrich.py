"""Place queries: customers look up suppliers as places."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterforge import fixed
from rosterforge.catalog import base as b
from rosterforge.catalog.base import pick, query, sql_pick, table
from rosterforge.functions import matching as match
from rosterforge.operators import places, selection
from rosterforge.sources.ids import ids_of

PLACE_STATUS = ["OPERATIONAL", "CLOSED_TEMPORARILY", None, "CLOSED_PERMANENTLY", "OPERATIONAL", ""]
LOOKUP_STATUS = ["OK", "OK", "OK", "NOT_FOUND"]
CITY = "customer JOIN nation ON c_nationkey = n_nationkey"


def records(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as unified records; a third share one query text."""
    rows = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.lit("TX").alias("source_state"),
        pick("c_custkey", "=concat('Little Stars ', n_nationkey)", "=concat('Supplier ', c_custkey % 100)", "Kids Town").alias("name"),
        F.struct(
            pick("c_custkey", "=concat(n_nationkey, ' Main St')", "=concat(c_custkey % 100, ' Main St')", "7 Oak Rd").alias("street"),
            pick("c_custkey", "=n_name", "=n_name", "NATION_1").alias("city"),
            pick("c_custkey", "TX", "", "TX").alias("state"),
            pick("c_custkey", "", None, "78701").alias("zip"),
        ).alias("address"),
        F.col("c_custkey").alias("_ord"),
    )


SQL_RECORDS = f"""records AS (SELECT CAST(c_custkey AS VARCHAR) AS id,
  {sql_pick("c_custkey", "='Little Stars ' || n_nationkey", "='Supplier ' || (c_custkey % 100)", "Kids Town")} AS name,
  {sql_pick("c_custkey", "=n_nationkey || ' Main St'", "=(c_custkey % 100) || ' Main St'", "7 Oak Rd")} AS street,
  {sql_pick("c_custkey", "=n_name", "=n_name", "NATION_1")} AS city,
  {sql_pick("c_custkey", "TX", "", "TX")} AS state, {sql_pick("c_custkey", "", None, "78701")} AS zip, c_custkey AS ord FROM {CITY}),
queried AS (SELECT *, concat_ws(', ', NULLIF(street, ''), NULLIF(city, ''), NULLIF(state, ''), NULLIF(zip, '')) AS street_address,
  trim(name || ' ' || concat_ws(', ', NULLIF(street, ''), NULLIF(city, ''), NULLIF(state, ''), NULLIF(zip, ''))) AS place_query FROM records),
keyed AS (SELECT *, md5(place_query) AS query_md5 FROM queried)"""


def lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as stored replies, keyed by the query that found them."""
    rows = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    text = pick(
        "s_suppkey", "=concat('Little Stars ', n_nationkey, ' ', n_nationkey, ' Main St, ', n_name, ', TX')",
        "=concat('Supplier ', s_suppkey, ' ', s_suppkey, ' Main St, ', n_name)", "=concat('Kids Town 7 Oak Rd, NATION_1, TX, 78701', repeat(' ', s_suppkey div 3))",
    )
    found = rows.select(
        F.md5(text).alias("query_md5"),
        pick("s_suppkey div 3", *LOOKUP_STATUS).alias("status"),
        pick("s_suppkey", "=concat('the LITTLE stars ', n_nationkey, ' school')", "=s_name", "Kids Town Academy").alias("name"),
        pick("s_suppkey div 2", *PLACE_STATUS).alias("business_status"),
        pick("s_suppkey", "=concat(n_nationkey, ' Main Street')", "=concat(s_suppkey % 40, ' Main')", "Oak Road").alias("address"),
        "s_suppkey",
    )
    # one reply per query: the lowest supplier
    firsts = found.groupBy("query_md5").agg(F.min("s_suppkey").alias("s_suppkey"))
    return found.join(firsts, ["query_md5", "s_suppkey"], "left_semi").drop("s_suppkey")


SQL_LOOKUP = f"""found AS (SELECT md5({sql_pick(
    "s_suppkey", "='Little Stars ' || n_nationkey || ' ' || n_nationkey || ' Main St, ' || n_name || ', TX'",
    "='Supplier ' || s_suppkey || ' ' || s_suppkey || ' Main St, ' || n_name", "='Kids Town 7 Oak Rd, NATION_1, TX, 78701' || repeat(' ', s_suppkey // 3)")}) AS query_md5,
  {sql_pick("s_suppkey // 3", *LOOKUP_STATUS)} AS status,
  {sql_pick("s_suppkey", "='the LITTLE stars ' || n_nationkey || ' school'", "=s_name", "Kids Town Academy")} AS place_name,
  {sql_pick("s_suppkey // 2", *PLACE_STATUS)} AS business_status,
  {sql_pick("s_suppkey", "=n_nationkey || ' Main Street'", "=(s_suppkey % 40) || ' Main'", "Oak Road")} AS place_address, s_suppkey
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
lookup AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_md5 ORDER BY s_suppkey) AS nth FROM found) WHERE nth = 1)"""


def sql_contain(a: str, c: str) -> str:
    return f"COALESCE({a} <> '' AND {c} <> '' AND (contains(lower({a}), lower({c})) OR contains(lower({c}), lower({a}))), false)"


def sql_streets(a: str, c: str) -> str:
    one, two = (rf"regexp_extract({b.sql_strip(x)}, '^(\p{{Nd}}+)', 1)" for x in (a, c))
    return (
        f"CASE WHEN {b.sql_blank(a)} OR {b.sql_blank(c)} THEN false"
        f" WHEN {one} <> '' AND {two} <> '' THEN {one} = {two} ELSE true END"
    )


@query(
    "q_place_lookup_join",
    f"""WITH {SQL_RECORDS}, {SQL_LOOKUP} SELECT id, place_query, k.query_md5, status, place_name, business_status
FROM keyed k LEFT JOIN lookup l ON k.query_md5 = l.query_md5""",
)
def q_place_lookup_join(spark, sf):
    return places.join_places(records(spark, sf), lookup(spark, sf)).select(
        "id", "place_query", "query_md5", "place.status", F.col("place.name").alias("place_name"), "place.business_status"
    )


def sql_ratios(pairs: str) -> str:
    """`blocks(a, b, matched)` of the distinct pairs of a relation, both already lower-cased.

    Equal characters on one diagonal form runs; every open interval takes the
    longest run clipped to it and leaves the parts before and behind it.
    """
    return f"""pair AS (SELECT *, row_number() OVER () AS pid FROM (SELECT DISTINCT a, b FROM {pairs} WHERE a <> '' AND b <> '')),
rights AS (SELECT pid, a, b, unnest(range(1, length(b) + 1)) AS j FROM pair),
lefts AS (SELECT *, unnest(range(1, length(a) + 1)) AS i FROM rights),
cells AS (SELECT pid, i, i - j AS d FROM lefts WHERE substr(a, i, 1) = substr(b, j, 1)),
runs AS (SELECT pid, d, min(i) AS i, count(*) AS n FROM (
  SELECT *, i - row_number() OVER (PARTITION BY pid, d ORDER BY i) AS run FROM cells) GROUP BY pid, d, run),
opened AS (SELECT pid, CAST(1 AS BIGINT) AS a0, CAST(length(a) + 1 AS BIGINT) AS a1, CAST(1 AS BIGINT) AS b0,
    CAST(length(b) + 1 AS BIGINT) AS b1, CAST(0 AS BIGINT) AS size FROM pair
  UNION ALL
  SELECT pid, p.a0, p.a1, p.b0, p.b1, p.size FROM (
    SELECT pid, unnest([{{'a0': a0, 'a1': -best.i, 'b0': b0, 'b1': -best.j, 'size': 0}},
      {{'a0': best.n - best.i, 'a1': a1, 'b0': best.n - best.j, 'b1': b1, 'size': 0}},
      {{'a0': 0, 'a1': 0, 'b0': 0, 'b1': 0, 'size': best.n}}]) AS p
    FROM (SELECT pid, a0, a1, b0, b1, max({{'n': least(i + n, a1, b1 + d) - greatest(i, a0, b0 + d),
        'i': -greatest(i, a0, b0 + d), 'j': d - greatest(i, a0, b0 + d)}}) AS best
      FROM opened JOIN runs USING (pid) WHERE least(i + n, a1, b1 + d) > greatest(i, a0, b0 + d)
      GROUP BY pid, a0, a1, b0, b1))),
blocks AS (SELECT a, b, CAST(sum(size) AS BIGINT) AS matched FROM opened JOIN pair USING (pid) GROUP BY a, b)"""


@query(
    "q_place_gate",
    f"""WITH RECURSIVE {SQL_RECORDS}, {SQL_LOOKUP},
hit AS (SELECT id, k.name, place_name, street_address, place_address, status, business_status, l.query_md5 IS NOT NULL AS placed
  FROM keyed k LEFT JOIN lookup l ON k.query_md5 = l.query_md5),
named AS (SELECT lower(name) AS a, lower(place_name) AS b FROM hit), {sql_ratios("named")}
SELECT id, CASE WHEN NOT placed THEN 'place_missing' WHEN status = 'NOT_FOUND' THEN 'place_not_found'
  WHEN NOT ({sql_contain("name", "place_name")} OR COALESCE(2.0 * matched / (length(a) + length(b)), 0) >= {fixed.NAME_RATIO_THRESHOLD})
    OR NOT {sql_streets("street_address", "place_address")} THEN 'place_mismatch'
  WHEN {b.sql_blank("business_status")} OR business_status = 'CLOSED_PERMANENTLY' THEN 'place_status' END AS reason
FROM hit LEFT JOIN blocks ON lower(name) = a AND lower(place_name) = b""",
)
def q_place_gate(spark, sf):
    judged = places.judge_places(records(spark, sf), lookup(spark, sf))
    return judged.select("id", F.col("drop_reason").alias("reason"))


@query(
    "q_place_gate_reason",
    f"""WITH {SQL_RECORDS}, {SQL_LOOKUP} SELECT id, CASE WHEN l.query_md5 IS NULL THEN 'place_missing'
  WHEN status = 'NOT_FOUND' THEN 'place_not_found' WHEN NOT {sql_streets("street_address", "place_address")} THEN 'place_mismatch'
  WHEN {b.sql_blank("business_status")} OR business_status = 'CLOSED_PERMANENTLY' THEN 'place_status' END AS drop_reason
FROM keyed k LEFT JOIN lookup l ON k.query_md5 = l.query_md5""",
)
def q_place_gate_reason(spark, sf):
    """Gate order with the street test alone, which SQL can say too."""
    joined = places.join_places(records(spark, sf), lookup(spark, sf))
    streets = match.street_numbers_agree(places.street_address(F.col("address")), F.col("place.address"))
    return joined.withColumn("place_match", streets).select("id", places.gate_reason().alias("drop_reason"))


@query(
    "q_lookup_refresh",
    f"""WITH {SQL_RECORDS}, {SQL_LOOKUP},
asked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_md5 ORDER BY ord) AS nth FROM keyed) WHERE nth = 1),
judged AS (SELECT a.query_md5, a.name, a.place_query, l.query_md5 IS NOT NULL AS hit, status, place_name,
  {sql_streets("street_address", "place_address")} AS fits FROM asked a LEFT JOIN lookup l ON a.query_md5 = l.query_md5),
stale AS (SELECT query_md5, 'NOT_FOUND' AS status, 'mismatch_cached' AS reason, NULL AS searched_query, name AS query_name,
  place_name AS found_name FROM judged WHERE hit AND COALESCE(status, '') <> 'NOT_FOUND' AND NOT fits),
missed AS (SELECT query_md5, 'NOT_FOUND', NULL, place_query, NULL, NULL FROM judged WHERE NOT hit)
SELECT * FROM stale UNION ALL SELECT * FROM missed UNION ALL
SELECT query_md5, status, NULL, NULL, NULL, NULL FROM lookup l WHERE l.query_md5 NOT IN (SELECT query_md5 FROM stale)""",
)
def q_lookup_refresh(spark, sf):
    """Upkeep where the service found nothing new; the street test decides."""
    stored = lookup(spark, sf).select(
        "query_md5", "status", F.lit(None).cast("string").alias("reason"), F.lit(None).cast("string").alias("searched_query"),
        F.lit(None).cast("struct<query_name:string,found_name:string>").alias("metadata"), "name", "address",
    )
    keyed = places.with_query(records(spark, sf))
    firsts = keyed.groupBy("query_md5").agg(F.min("_ord").alias("_ord"))
    asked = keyed.join(firsts, ["query_md5", "_ord"], "left_semi")
    hits = stored.select("query_md5", "status", F.col("name").alias("place_name"), F.col("address").alias("place_address"), F.lit(True).alias("hit"))
    streets = match.street_numbers_agree(places.street_address(F.col("address")), F.col("place_address"))
    judged = asked.join(hits, "query_md5", "left").select(
        "query_md5", "name", "place_query", F.coalesce("hit", F.lit(False)).alias("hit"), "status", "place_name", streets.alias("place_match")
    )
    fetched = judged.where(~F.col("hit")).select(
        "query_md5", "name", "place_query", "place_name", F.lit(False).alias("found"), F.lit(False).alias("place_match")
    )
    return places.refreshed_lookup(judged, stored, fetched).select(
        "query_md5", "status", "reason", "searched_query", "metadata.query_name", "metadata.found_name"
    )


@query(
    "q_already_enriched",
    f"""WITH {SQL_RECORDS} SELECT id, ord IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AS enriched FROM records""",
)
def q_already_enriched(spark, sf):
    done = table(spark, sf, "orders").where(F.col("o_orderstatus") == "F").select(F.col("o_custkey").cast("string").alias("id"))
    todo, ready = places.split_enriched(records(spark, sf), done)
    return todo.select("id", F.lit(False).alias("enriched")).unionByName(ready.select("id", F.lit(True).alias("enriched")))


@query(
    "q_place_shape",
    r"""WITH lines AS (SELECT conv_id, turn, role, string_split(text, chr(10)) AS l FROM conversations)
SELECT conv_id, turn, 'p' || conv_id AS place_id, 'http://x.org/' || conv_id || CASE WHEN turn % 2 = 0 THEN '' ELSE '#top' END AS website,
  'http://maps/' || conv_id AS google_maps_url, CAST(len(l) AS BIGINT) AS review_count,
  array_to_string(list_transform(l, lambda t: role || ':' || t), chr(10)) AS reviews,
  array_to_string(list_slice(list_transform(l, lambda t: md5(t)), 1, 5), ',') AS photos, 30.5 + turn AS lat, -97.5 AS lng
FROM lines""",
)
def q_place_shape(spark, sf):
    reply = F.struct(
        F.concat(F.lit("p"), "conv_id").alias("place_id"),
        F.lit("x").alias("name"), F.lit("OPERATIONAL").alias("business_status"),
        F.concat(F.lit("http://maps/"), "conv_id").alias("url"), F.lit("1 A").alias("formatted_address"),
        F.lit("5").alias("formatted_phone_number"),
        F.concat(F.lit("http://x.org/"), "conv_id", F.when(F.col("turn") % 2 == 0, "?a=1").otherwise("?a=/#top")).alias("website"),
        F.lit(4.5).alias("rating"), F.size(F.split("text", "\n")).alias("user_ratings_total"),
        F.struct(F.struct((F.lit(30.5) + F.col("turn")).alias("lat"), F.lit(-97.5).alias("lng")).alias("location")).alias("geometry"),
        F.transform(F.split("text", "\n"), F.md5).alias("photos"),
        F.transform(
            F.split("text", "\n"),
            lambda t: F.struct(
                F.col("role").alias("author_name"), F.lit(5).alias("rating"), t.alias("text"),
                F.lit(1).cast("long").alias("time"), F.lit("a week ago").alias("relative_time_description"),
            ),
        ).alias("reviews"),
        F.lit("{}").alias("opening_hours"),
    )
    shaped = table(spark, sf, "conversations").select("conv_id", "turn", places.shape_place(reply).alias("p"))
    return shaped.select(
        "conv_id", "turn", "p.place_id", "p.contact.website", "p.google_maps_url",
        F.size("p.reviews").cast("long").alias("review_count"),
        F.array_join(F.transform("p.reviews", lambda r: F.concat(r["author_name"], F.lit(":"), r["text"])), "\n").alias("reviews"),
        F.array_join("p.photos", ",").alias("photos"), "p.street_view_metadata.lat", "p.street_view_metadata.lng",
    )


_NAMES = ["=p_name", "=upper(p_name)", "=concat('the ', p_name, ' school')", "", None, "=p_type"]
_SQL_NAMES = ["=p_name", "=upper(p_name)", "='the ' || p_name || ' school'", "", None, "=p_type"]


@query(
    "q_name_containment",
    f"""SELECT p_partkey, {sql_contain("p_name", sql_pick("p_partkey", *_SQL_NAMES))} AS contained FROM part""",
)
def q_name_containment(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", match.names_contain(F.col("p_name"), pick("p_partkey", *_NAMES)).alias("contained")
    )


@query(
    "q_name_similarity",
    f"""WITH RECURSIVE named AS (SELECT p_partkey, p_name, p_type || ' ' || p_brand AS other, lower(p_name) AS a,
  lower(p_type || ' ' || p_brand) AS b FROM part), {sql_ratios("named")}
SELECT p_partkey, round(CAST(2.0 * COALESCE(matched, 0) AS DOUBLE) / (length(n.a) + length(n.b)), 6) AS ratio,
  {sql_contain("p_name", "other")} OR CAST(2.0 * COALESCE(matched, 0) AS DOUBLE) / (length(n.a) + length(n.b)) >= {fixed.NAME_RATIO_THRESHOLD} AS agree
FROM named n LEFT JOIN blocks k ON n.a = k.a AND n.b = k.b""",
)
def q_name_similarity(spark, sf):
    pairs = table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("a"), F.concat("p_type", F.lit(" "), "p_brand").alias("b"))
    judged = places.with_names_agree(pairs, F.col("a"), F.col("b"), "agree")
    return judged.select(
        "p_partkey", F.round(match.sequence_ratio(F.lower("a"), F.lower("b")), 6).alias("ratio"), "agree"
    )


@query(
    "q_street_number",
    f"""SELECT c_custkey, {sql_streets("((c_custkey % 50) || ' Main St')", sql_pick("c_custkey", "=(c_custkey % 50) || ' Main'", "=(c_custkey % 7) || 'B Main'", "Main", "", None))} AS agree FROM customer""",
)
def q_street_number(spark, sf):
    other = pick("c_custkey", "=concat(c_custkey % 50, ' Main')", "=concat(c_custkey % 7, 'B Main')", "Main", "", None)
    return table(spark, sf, "customer").select(
        "c_custkey", match.street_numbers_agree(F.expr("concat(c_custkey % 50, ' Main St')"), other).alias("agree")
    )


@query(
    "q_id_semi_join",
    f"""WITH ids AS (SELECT DISTINCT {b.sql_strip("i")} AS id FROM (
  SELECT unnest(string_split(replace(c_custkey || ', ' || (c_custkey * 2) || chr(10) || ' , ' || (c_custkey * 3), chr(10), ','), ',')) AS i FROM customer)
  WHERE {b.sql_strip("i")} <> '')
SELECT o_orderkey, o_custkey FROM orders WHERE CAST(o_orderkey AS VARCHAR) IN (SELECT id FROM ids)""",
)
def q_id_semi_join(spark, sf):
    texts = table(spark, sf, "customer").select(
        F.expr("concat(c_custkey, ', ', c_custkey * 2, '\\n', ' , ', c_custkey * 3)").alias("value")
    )
    orders = table(spark, sf, "orders").withColumn("id", F.col("o_orderkey").cast("string"))
    return selection.only_ids(orders, ids_of(texts, "value")).select("o_orderkey", "o_custkey")


@query("q_resume_anti", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def q_resume_anti(spark, sf):
    done = table(spark, sf, "orders").where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("l_orderkey"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return selection.not_done(lines, done, "l_orderkey")
