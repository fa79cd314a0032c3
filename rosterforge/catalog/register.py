"""Register queries: the customer table as one register, supplier as the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterforge import fixed, schemas
from rosterforge.catalog import base as b
from rosterforge.catalog.base import pick, query, sql_pick, table
from rosterforge.functions import register as reg
from rosterforge.functions import text as tx
from rosterforge.operators import unify
from rosterforge.operators.ordering import mark_first
from rosterforge.operators.unify import LocationFilter
from rosterforge.plans.starter import first_by_id
from rosterforge.session import durable, durable_path
from rosterforge.sources.registers import scan_register

TYPES = [
    "Licensed Center", "Child Placing Agency", "Family Home", "Residential Treatment",
    "School-Age Program", "Learning Center", "Listed Family Home", "Other",
]
FLAGS = ["Y", "Y", "y", "Y", "N", "Y", "", None, "Yes", "Y"]
PHONES = ["(512) 555-0100", "1-512-555-0199", "555-0100", None, "512.555.0142", "25125550100"]
EMAILS = [" Office@Kids.com ", "info@stars", None, "a@b.org", ""]
SITES = ["https://www.kids.com/a?x=1", None, "", "http://stars.org"]
CAPACITIES = ["12", "0", "12.0", "-5", None, "144", "30"]
WORDS = ["Active", "Not Active", "Inactive", "Closed", None, "ACTIVE - probation", "Active"]


def raw_tx(spark: SparkSession, sf: str) -> DataFrame:
    k = "c_custkey"
    rows = table(spark, sf, "customer", "c_custkey", "c_name", "c_nationkey").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.select(
        F.expr(f"CAST({k} AS STRING)").alias("operation_id"),
        pick(
            k, "=lower(c_name)", f"=concat('  o\\'brien   kid-care ', {k} % 40)", None, f"=concat('twin stars ', {k} % 90)",
            "hope foster care", f"=concat('sun ', lower(n_name), ' ', {k})", "", f"=concat('moon adoption ', {k})",
            f"=concat('élan n°', {k} % 25)",
        ).alias("operation_name"),
        pick(f"{k} div 3", *TYPES).alias("operation_type"),
        pick(f"{k} div 2", *FLAGS).alias("operation_status"),
        pick(f"{k} div 5", "NO", "NO", "YES", None, "no").alias("temporarily_closed"),
        pick(k, "2020-01-31T00:00:00.000", "1/2/2020", "2020-01-02", "junk", "", None, "12/31/2019").alias("issuance_date"),
        F.expr(f"CASE WHEN {k} % 13 = 5 THEN '' ELSE concat({k} % 30, ' Main St, ', n_name) END").alias("location_address"),
        F.expr(f"concat({k} % 30, ' Main St')").alias("address_line"),
        F.col("n_name").alias("city"),
        pick(k, "TX", "tx ", "OK").alias("state"),
        pick(f"{k} div 4", f"=concat('787', lpad(CAST({k} % 100 AS STRING), 2, '0'))", "78750-1234", None, "").alias("zipcode"),
        F.struct(
            pick(k, "30.25", "", None, "31.5").alias("latitude"), pick(k, "-97.75", "0", None, "-98.5").alias("longitude")
        ).alias("location_address_geo"),
        pick(k, *PHONES).alias("phone_number"),
        pick(f"{k} div 2", *EMAILS).alias("email_address"),
        pick(f"{k} div 3", *SITES).alias("website_address"),
        pick(k, "Ann Lee", None, " ").alias("administrator_director_name"),
        pick(f"{k} div 2", *CAPACITIES).alias("total_capacity"),
        pick(k, "Infant, Toddler", None).alias("licensed_to_serve_ages"),
        pick(k, "07:00 - 18:00", None).alias("hours_of_operation"),
        pick(k, "Mon - Fri", "").alias("days_of_operation"),
        F.col(k).alias("_ord"),
    )
    return rows.withColumn("_raw", F.to_json(F.struct(*[c for c in rows.columns if c != "_ord"])))


def raw_wa(spark: SparkSession, sf: str) -> DataFrame:
    k = "s_suppkey"
    rows = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    rows = rows.select(
        F.expr(f"CAST({k} AS STRING)").alias("wacompassid"),
        pick(k, "=lower(s_name)", "", None, f"=concat('twin stars ', {k} % 9)").alias("doingbusinessas"),
        pick(k, "unused", f"=concat('provider ', {k} % 6)", None, "unused").alias("providername"),
        pick(k, *TYPES).alias("facilitytypegeneric"),
        pick(k, *WORDS).alias("latestoperatingstatus"),
        pick(k, "1/2/2020", "10/12/2021", None).alias("initiallicensedate"),
        pick(k, f"=concat({k} % 12, ' Pine Ave')", None).alias("physicalstreetaddress"),
        F.col("n_name").alias("physicalcity"),
        pick(k, "WA", None, "wa").alias("physicalstate"),
        pick(k, "98101", "98101-0042", None).alias("physicalzip"),
        pick(k, "47.5", None).alias("physciallatitude"),
        pick(k, "-122.25", None).alias("physicallongitude"),
        pick(k, *PHONES).alias("primarycontactphonenumber"),
        pick(k, *EMAILS).alias("primarycontactemail"),
        pick(k, "Bo Ray", None).alias("primarycontactpersonname"),
        pick(k, *CAPACITIES).alias("licensecapacity"),
        pick(k, "0", "", None, "2").alias("startingage"),
        pick(k, "5", "", None, None).alias("endingage"),
        F.col(k).alias("_ord"),
    )
    return rows.withColumn("_raw", F.to_json(F.struct(*[c for c in rows.columns if c != "_ord"])))


def unified(spark: SparkSession, sf: str) -> DataFrame:
    return unify.union_registers({"TX": raw_tx(spark, sf), "WA": raw_wa(spark, sf)})


def reasoned(spark: SparkSession, sf: str, where: LocationFilter | None = None, raw_text: bool = False) -> DataFrame:
    """As the job does it: standardised once, then read by both branches."""
    rows = unified(spark, sf)
    rows = rows if raw_text else rows.drop("original_record")
    return unify.with_drop_reason(durable(rows, "standardised"), where)


def _sql_raw() -> str:
    k = "c_custkey"
    s = "s_suppkey"
    return f"""
raw_tx AS (
  SELECT CAST({k} AS VARCHAR) AS operation_id,
    {sql_pick(k, "=lower(c_name)", f"='  o''brien   kid-care ' || ({k} % 40)", None, f"='twin stars ' || ({k} % 90)",
              "hope foster care", f"='sun ' || lower(n_name) || ' ' || {k}", "", f"='moon adoption ' || {k}",
              f"='élan n°' || ({k} % 25)")} AS operation_name,
    {sql_pick(f"{k} // 3", *TYPES)} AS operation_type,
    {sql_pick(f"{k} // 2", *FLAGS)} AS operation_status,
    {sql_pick(f"{k} // 5", "NO", "NO", "YES", None, "no")} AS temporarily_closed,
    {sql_pick(k, "2020-01-31T00:00:00.000", "1/2/2020", "2020-01-02", "junk", "", None, "12/31/2019")} AS issuance_date,
    CASE WHEN {k} % 13 = 5 THEN '' ELSE ({k} % 30) || ' Main St, ' || n_name END AS location_address,
    ({k} % 30) || ' Main St' AS address_line, n_name AS city,
    {sql_pick(k, "TX", "tx ", "OK")} AS state,
    {sql_pick(f"{k} // 4", f"='787' || lpad(CAST({k} % 100 AS VARCHAR), 2, '0')", "78750-1234", None, "")} AS zipcode,
    {sql_pick(k, "30.25", "", None, "31.5")} AS latitude, {sql_pick(k, "-97.75", "0", None, "-98.5")} AS longitude,
    {sql_pick(k, *PHONES)} AS phone_number, {sql_pick(f"{k} // 2", *EMAILS)} AS email_address,
    {sql_pick(f"{k} // 3", *SITES)} AS website_address,
    {sql_pick(k, "Ann Lee", None, " ")} AS administrator_director_name,
    {sql_pick(f"{k} // 2", *CAPACITIES)} AS total_capacity,
    {sql_pick(k, "Infant, Toddler", None)} AS licensed_to_serve_ages,
    {sql_pick(k, "07:00 - 18:00", None)} AS hours_of_operation,
    {sql_pick(k, "Mon - Fri", "")} AS days_of_operation, {k} AS ord
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
raw_wa AS (
  SELECT CAST({s} AS VARCHAR) AS wacompassid,
    {sql_pick(s, "=lower(s_name)", "", None, f"='twin stars ' || ({s} % 9)")} AS doingbusinessas,
    {sql_pick(s, "unused", f"='provider ' || ({s} % 6)", None, "unused")} AS providername,
    {sql_pick(s, *TYPES)} AS facilitytypegeneric, {sql_pick(s, *WORDS)} AS latestoperatingstatus,
    {sql_pick(s, "1/2/2020", "10/12/2021", None)} AS initiallicensedate,
    {sql_pick(s, f"=({s} % 12) || ' Pine Ave'", None)} AS physicalstreetaddress, n_name AS physicalcity,
    {sql_pick(s, "WA", None, "wa")} AS physicalstate, {sql_pick(s, "98101", "98101-0042", None)} AS physicalzip,
    {sql_pick(s, "47.5", None)} AS physciallatitude, {sql_pick(s, "-122.25", None)} AS physicallongitude,
    {sql_pick(s, *PHONES)} AS primarycontactphonenumber, {sql_pick(s, *EMAILS)} AS primarycontactemail,
    {sql_pick(s, "Bo Ray", None)} AS primarycontactpersonname, {sql_pick(s, *CAPACITIES)} AS licensecapacity,
    {sql_pick(s, "0", "", None, "2")} AS startingage, {sql_pick(s, "5", "", None, None)} AS endingage, {s} AS ord
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""


def _sql_record(*columns: str, nested: str = "") -> str:
    """`key: value` lines of the filled columns."""
    lines = []
    for c in columns:
        if c == "@geo":
            lines.append(nested)
        else:
            lines.append(f"CASE WHEN {b.sql_strip(c)} <> '' THEN '{c}: ' || {b.sql_strip(c)} END")
    return f"concat_ws(chr(10), {', '.join(lines)})"


_GEO = (
    "'location_address_geo: {' || concat_ws(',', '\"latitude\":\"' || latitude || '\"',"
    " '\"longitude\":\"' || longitude || '\"') || '}'"
)
_TX_RECORD = _sql_record(
    "operation_id", "operation_name", "operation_type", "operation_status", "temporarily_closed", "issuance_date",
    "location_address", "address_line", "city", "state", "zipcode", "@geo", "phone_number", "email_address",
    "website_address", "administrator_director_name", "total_capacity", "licensed_to_serve_ages",
    "hours_of_operation", "days_of_operation", nested=_GEO,
)
_WA_RECORD = _sql_record(
    "wacompassid", "doingbusinessas", "providername", "facilitytypegeneric", "latestoperatingstatus",
    "initiallicensedate", "physicalstreetaddress", "physicalcity", "physicalstate", "physicalzip",
    "physciallatitude", "physicallongitude", "primarycontactphonenumber", "primarycontactemail",
    "primarycontactpersonname", "licensecapacity", "startingage", "endingage",
)


def sql_unified() -> str:
    """CTEs up to `unified`, one flat row per register row."""
    full = (
        "COALESCE(physicalstreetaddress, '') || ', ' || COALESCE(physicalcity, '') || ', ' ||"
        " COALESCE(physicalstate, '') || ' ' || COALESCE(physicalzip, '')"
    )
    ages = "COALESCE(startingage, '') <> '' OR COALESCE(endingage, '') <> ''"
    return f"""WITH {_sql_raw()},
unified AS (
  SELECT 'TX-' || operation_id AS id, 'TX' AS source_state, {_TX_RECORD} AS original_record,
    {b.sql_name("operation_name")} AS name, {b.sql_type("operation_type")} AS type,
    CASE WHEN temporarily_closed = 'YES' THEN 'Temporarily Closed' ELSE {b.sql_status_flag("operation_status")} END AS status,
    {b.sql_date("issuance_date")} AS license_date,
    COALESCE(location_address, '') AS full_address, COALESCE(address_line, '') AS street, COALESCE(city, '') AS city,
    COALESCE(state, '') AS state, COALESCE(zipcode, '') AS zip,
    COALESCE(TRY_CAST(latitude AS DOUBLE), 0) AS latitude, COALESCE(TRY_CAST(longitude AS DOUBLE), 0) AS longitude,
    {b.sql_phone("phone_number")} AS phone, {b.sql_email("email_address")} AS email, website_address AS website,
    administrator_director_name AS director_name, {b.sql_capacity("total_capacity")} AS capacity,
    licensed_to_serve_ages AS ages_served, hours_of_operation AS hours, days_of_operation AS days, 0 AS src, ord
  FROM raw_tx
  UNION ALL
  SELECT 'WA-' || wacompassid, 'WA', {_WA_RECORD},
    {b.sql_name(b.sql_or("doingbusinessas", "providername"))}, {b.sql_type("facilitytypegeneric")},
    {b.sql_status_words("latestoperatingstatus")}, {b.sql_date("initiallicensedate")},
    {full}, COALESCE(physicalstreetaddress, ''), COALESCE(physicalcity, ''), COALESCE(physicalstate, ''),
    COALESCE(physicalzip, ''),
    COALESCE(TRY_CAST(physciallatitude AS DOUBLE), 0), COALESCE(TRY_CAST(physicallongitude AS DOUBLE), 0),
    {b.sql_phone("primarycontactphonenumber")}, {b.sql_email("primarycontactemail")}, NULL,
    primarycontactpersonname, {b.sql_capacity("licensecapacity")},
    CASE WHEN {ages} THEN COALESCE(startingage, '') || ' - ' || COALESCE(endingage, '') END, NULL, NULL, 1, ord
  FROM raw_wa)"""


def sql_reasoned(location: str = "", rows: str = "unified") -> str:
    """CTEs up to `reasoned`: every unified row with `drop_reason`."""
    words = b.sql_any("lower(name)", fixed.EXCLUDED_NAME_WORDS)
    return sql_unified() + f""",
ruled AS (
  SELECT *, CASE WHEN type IN ('Agency', 'Residential') THEN 'filtered_type'
    WHEN {words} THEN 'filtered_keyword' WHEN capacity = 0 THEN 'filtered_capacity'
    WHEN {b.sql_blank("phone")} AND {b.sql_blank("email")} AND {b.sql_blank("website")} THEN 'filtered_contact'
    WHEN name = 'Unknown' OR name = '' THEN 'missing_name' WHEN full_address = '' THEN 'missing_address'
    {location} WHEN status <> 'Active' THEN 'inactive' END AS rule FROM {rows}),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY rule IS NULL, name, full_address ORDER BY src, ord) AS nth FROM ruled),
reasoned AS (
  SELECT *, CASE WHEN rule IS NOT NULL THEN rule WHEN nth > 1 THEN 'duplicate' END AS drop_reason FROM ranked)"""


def flat(rows: DataFrame, *more: str) -> DataFrame:
    return rows.select(
        "id", "source_state", "original_record", "name", "type", "status", "license_date",
        F.col("address.full").alias("full_address"), "address.street", "address.city", "address.state", "address.zip",
        "address.latitude", "address.longitude", "contact.phone", "contact.email", "contact.website",
        "contact.director_name", F.col("capacity").cast("string").alias("capacity"), "ages_served",
        "schedule.hours", "schedule.days", *more,
    )


_FLAT = """id, source_state, original_record, name, type, status, license_date, full_address, street, city, state, zip,
  latitude, longitude, phone, email, website, director_name, CAST(capacity AS VARCHAR) AS capacity, ages_served, hours, days"""


@query("q_union_standardize", sql_unified() + f" SELECT {_FLAT} FROM unified")
def q_union_standardize(spark, sf):
    return flat(unified(spark, sf))


@query("q_drop_reason", sql_reasoned() + " SELECT id, source_state, name, full_address, drop_reason FROM reasoned")
def q_drop_reason(spark, sf):
    return reasoned(spark, sf).select(
        "id", "source_state", "name", F.col("address.full").alias("full_address"), "drop_reason"
    )


# elements of a landed array that are no objects, or none that can be read
_BROKEN = ['5', 'null', '"}],[{ \\" ,"', '[1, {"operation_id": "7"}]', '{"operation_id" "7"}', '{"operation_id": "7",}']
_NOTE = ',"note":"a \\"}], [{ \\\\"}'


def land_arrays(rows: DataFrame, path: str, element: str, position: str, rows_per_file: int = 20_000) -> None:
    """Writes ``element`` as files of one JSON array each, in order of ``position``, a whole number."""
    of_file = Window.partitionBy("file").orderBy(position)
    numbered = rows.select(
        F.lpad(F.expr(f"CAST({position} div {rows_per_file} AS STRING)"), 12, "0").alias("file"), position, element
    )
    edges = numbered.select(
        "file",
        F.concat(
            F.when(F.lag(F.lit(1)).over(of_file).isNull(), F.lit("[")).otherwise(F.lit("")),
            F.col(element),
            F.when(F.lead(F.lit(1)).over(of_file).isNull(), F.lit("]")).otherwise(F.lit(",")),
        ).alias("value"),
    )
    edges.write.partitionBy("file").text(path)


@query(
    "q_register_scan",
    sql_reasoned(rows="(SELECT * FROM unified WHERE src = 0 AND ord % 11 NOT IN (3, 8)) landed")
    + """ SELECT id, name, full_address, drop_reason FROM reasoned
UNION ALL SELECT NULL, NULL, NULL, 'processing_error' FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_custkey % 11 IN (3, 8)""",
)
def q_register_scan(spark, sf):
    broken = F.element_at(F.array(*map(F.lit, _BROKEN)), F.expr(f"CAST(_ord div 11 % {len(_BROKEN)} AS INT)") + 1)
    noted = F.concat(F.expr("substring(_raw, 1, length(_raw) - 1)"), F.lit(_NOTE))
    landed = raw_tx(spark, sf).select("_ord", F.when((F.col("_ord") % 11).isin(3, 8), broken).otherwise(noted).alias("element"))
    path = durable_path(spark, "landed-arrays")
    land_arrays(landed, path, "element", "_ord")
    scanned = scan_register(spark, path, schemas.RAW_TX, json_lines=False)
    rows = durable(unify.union_registers({"TX": scanned}).drop("original_record"), "standardised")
    read = F.col("drop_reason").isNull() | (F.col("drop_reason") != "processing_error")
    return unify.with_drop_reason(rows).select(
        F.when(read, F.col("id")).alias("id"), F.when(read, F.col("name")).alias("name"),
        F.when(read, F.col("address.full")).alias("full_address"), "drop_reason",
    )


_REASON_VALUES = ", ".join(f"('{r}')" for r in fixed.DROP_REASONS)


@query(
    "q_drop_counts",
    sql_reasoned() + f""" SELECT known.reason, CAST(count(r.id) AS BIGINT) AS rows
FROM (VALUES {_REASON_VALUES}) known(reason) LEFT JOIN reasoned r ON r.drop_reason = known.reason GROUP BY known.reason""",
)
def q_drop_counts(spark, sf):
    _, drops = unify.split_drops(reasoned(spark, sf))
    return unify.drop_counts(drops)


_WHERE = """WHEN lower(trim(city)) <> 'nation_7' THEN 'filtered_city'
    WHEN upper(trim(state)) <> 'TX' THEN 'filtered_state'
    WHEN zip = '' OR NOT starts_with(zip, '787') THEN 'filtered_zip'"""


@query("q_location_filter", sql_reasoned(_WHERE) + " SELECT id, source_state, city, state, zip, drop_reason FROM reasoned")
def q_location_filter(spark, sf):
    where = LocationFilter(city=" Nation_7", state="tx", zip="787 ")
    return reasoned(spark, sf, where).select(
        "id", "source_state", "address.city", "address.state", "address.zip", "drop_reason"
    )


@query(
    "q_ingest_row",
    sql_reasoned() + """ SELECT id AS daycare_id, source_state, original_record, name, type, status, license_date,
  '{"full":' || to_json(full_address) || ',"street":' || to_json(street) || ',"city":' || to_json(city) || ',"state":' ||
  to_json(state) || ',"zip":' || to_json(zip) || ',"latitude":' || CAST(latitude AS VARCHAR) || ',"longitude":' ||
  CAST(longitude AS VARCHAR) || '}' AS address,
  '{"phone":' || COALESCE(to_json(phone), 'null') || ',"email":' || COALESCE(to_json(email), 'null') || ',"website":' ||
  COALESCE(to_json(website), 'null') || ',"director_name":' || COALESCE(to_json(director_name), 'null') || '}' AS contact,
  CAST(capacity AS VARCHAR) AS capacity, ages_served,
  '{"hours":' || COALESCE(to_json(hours), 'null') || ',"days":' || COALESCE(to_json(days), 'null') || '}' AS schedule,
  'batch-1' AS ingestion_batch_id, '2024-01-01T00:00:00+00:00' AS api_fetch_timestamp
FROM reasoned WHERE drop_reason IS NULL""",
)
def q_ingest_row(spark, sf):
    kept, _ = unify.split_drops(reasoned(spark, sf, raw_text=True))
    rows = unify.ingestion_rows(kept, "batch-1", "2024-01-01T00:00:00+00:00")
    return rows.withColumn("capacity", F.col("capacity").cast("string"))


@query(
    "q_kv_text",
    f"""WITH {_sql_raw()} SELECT 'TX-' || operation_id AS id, {_TX_RECORD} AS record FROM raw_tx
UNION ALL SELECT 'WA-' || wacompassid, {_WA_RECORD} FROM raw_wa""",
)
def q_kv_text(spark, sf):
    texas = raw_tx(spark, sf).select(F.concat(F.lit("TX-"), "operation_id").alias("id"), "_raw")
    washington = raw_wa(spark, sf).select(F.concat(F.lit("WA-"), "wacompassid").alias("id"), "_raw")
    return texas.unionByName(washington).select("id", tx.key_value_text(F.col("_raw")).alias("record"))


@query(
    "q_normalize_name",
    f"""SELECT 'p' || p_partkey AS key, {b.sql_name("p_name")} AS name FROM part
UNION ALL SELECT 'd' || doc_id, {b.sql_name("text")} FROM documents""",
)
def q_normalize_name(spark, sf):
    parts = table(spark, sf, "part").select(F.concat(F.lit("p"), "p_partkey").alias("key"), F.col("p_name").alias("raw"))
    texts = table(spark, sf, "documents", "doc_id", "text").select(F.concat(F.lit("d"), "doc_id").alias("key"), F.col("text").alias("raw"))
    return parts.unionByName(texts).select("key", tx.normalize_name(F.col("raw")).alias("name"))


@query(
    "q_normalize_status",
    f"""SELECT o_orderkey, {b.sql_status_flag(sql_pick("o_orderkey", *FLAGS))} AS flag_status,
  {b.sql_status_words(sql_pick("o_orderkey", *WORDS, "=o_orderpriority"))} AS word_status FROM orders""",
)
def q_normalize_status(spark, sf):
    k = "o_orderkey"
    return table(spark, sf, "orders").select(
        "o_orderkey",
        reg.status_from_flag(pick(k, *FLAGS)).alias("flag_status"),
        reg.status_from_words(pick(k, *WORDS, "=o_orderpriority")).alias("word_status"),
    )


@query(
    "q_normalize_type",
    f"""SELECT o_orderkey, {b.sql_type(sql_pick("o_orderkey", *TYPES, "Emergency SHELTER", "Placement", "X", None, ""))} AS type
FROM orders""",
)
def q_normalize_type(spark, sf):
    raw = pick("o_orderkey", *TYPES, "Emergency SHELTER", "Placement", "X", None, "")
    return table(spark, sf, "orders").select("o_orderkey", reg.normalize_type(raw).alias("type"))


@query(
    "q_normalize_date",
    f"""WITH r AS (SELECT o_orderkey, {sql_pick(
        "o_orderkey", "=strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000')",
        "=month(o_orderdate) || '/' || day(o_orderdate) || '/' || year(o_orderdate)",
        "=strftime(o_orderdate, '%Y-%m-%d')", "", None, "1/2020")} AS raw FROM orders)
SELECT o_orderkey, {b.sql_date("raw")} AS license_date FROM r""",
)
def q_normalize_date(spark, sf):
    raw = pick(
        "o_orderkey",
        "=date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss.000\")",
        "=concat(month(o_orderdate), '/', day(o_orderdate), '/', year(o_orderdate))",
        "=date_format(o_orderdate, 'yyyy-MM-dd')", "", None, "1/2020",
    )
    return table(spark, sf, "orders").select("o_orderkey", reg.normalize_date(raw).alias("license_date"))


@query(
    "q_normalize_phone",
    f"""WITH c AS (SELECT doc_id, unnest(regexp_extract_all(text, '[+(]?[0-9][0-9() .-]{{5,}}[0-9]')) AS raw FROM documents)
SELECT 'd' || doc_id AS key, raw, {b.sql_phone("raw")} AS phone FROM c
UNION ALL SELECT 'o' || o_orderkey, {sql_pick("o_orderkey", *PHONES)},
  {b.sql_phone(sql_pick("o_orderkey", *PHONES))} FROM orders""",
)
def q_normalize_phone(spark, sf):
    found = table(spark, sf, "documents", "doc_id", "text").select(
        F.concat(F.lit("d"), "doc_id").alias("key"),
        F.explode(F.regexp_extract_all("text", F.lit("([+(]?[0-9][0-9() .-]{5,}[0-9])"), F.lit(1))).alias("raw"),
    )
    made = table(spark, sf, "orders").select(
        F.concat(F.lit("o"), "o_orderkey").alias("key"), pick("o_orderkey", *PHONES).alias("raw")
    )
    return found.unionByName(made).withColumn("phone", reg.normalize_phone(F.col("raw")))


@query(
    "q_normalize_email",
    f"""WITH c AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^ \\n]*@[^ \\n]*')) AS raw FROM documents)
SELECT 'd' || doc_id AS key, raw, {b.sql_email("raw")} AS email FROM c
UNION ALL SELECT 'o' || o_orderkey, {sql_pick("o_orderkey", *EMAILS)},
  {b.sql_email(sql_pick("o_orderkey", *EMAILS))} FROM orders""",
)
def q_normalize_email(spark, sf):
    found = table(spark, sf, "documents", "doc_id", "text").select(
        F.concat(F.lit("d"), "doc_id").alias("key"),
        F.explode(F.regexp_extract_all("text", F.lit("([^ \n]*@[^ \n]*)"), F.lit(1))).alias("raw"),
    )
    made = table(spark, sf, "orders").select(
        F.concat(F.lit("o"), "o_orderkey").alias("key"), pick("o_orderkey", *EMAILS).alias("raw")
    )
    return found.unionByName(made).withColumn("email", reg.normalize_email(F.col("raw")))


@query(
    "q_parse_capacity",
    f"""WITH r AS (SELECT p_partkey, {sql_pick("p_partkey", *CAPACITIES, "=CAST(p_size AS VARCHAR)", "=CAST(p_retailprice AS VARCHAR)", "99999999999")} AS raw
FROM part) SELECT p_partkey, CAST({b.sql_capacity("raw")} AS VARCHAR) AS capacity FROM r""",
)
def q_parse_capacity(spark, sf):
    raw = pick(
        "p_partkey", *CAPACITIES, "=CAST(p_size AS STRING)", "=CAST(p_retailprice AS STRING)", "99999999999"
    )
    return table(spark, sf, "part").select("p_partkey", reg.parse_capacity(raw).cast("string").alias("capacity"))


@query(
    "q_dedup_fingerprint",
    """SELECT doc_id, row_number() OVER (PARTITION BY lang, text ORDER BY doc_id) = 1 AS is_first FROM documents""",
)
def q_dedup_fingerprint(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "lang", "text")
    marked = mark_first(documents, [F.col("lang"), F.col("text")], "doc_id", ["doc_id"], "is_first")
    return marked.select("doc_id", "is_first")


@query(
    "q_keep_first_by_id",
    """SELECT user_id, event_id, event_type, '2024-01-01T00:00:00' AS processed_at FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS nth FROM events) WHERE nth = 1""",
)
def q_keep_first_by_id(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type")
    return first_by_id(events, F.lit("2024-01-01T00:00:00"), "user_id", "event_id")
