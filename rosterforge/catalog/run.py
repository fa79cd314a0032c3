"""Run-keeping queries: slices, bad lines, costs, retries, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from rosterforge import fixed
from rosterforge.catalog.base import pick, query, sql_pick, table
from rosterforge.operators import ledger, run_input
from rosterforge.schemas import S, struct
from rosterforge.session import durable, durable_path
from rosterforge.sources.jsonl import split_lines
from rosterforge.sources.registers import landed_slice
from rosterforge.streaming import incremental


@query("q_page_slice", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 500 OFFSET 1000")
def q_page_slice(spark, sf):
    return landed_slice(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 1000, 500)


_LINES = ["=props", "=props", "=substr(props, 1, 5)", "", "=concat(' ', props)", "[1]", "  ", "=concat(props, ',0] junk')", "=concat(props, ',0],[')"]


@query(
    "q_bad_json_rows",
    f"""WITH r AS (SELECT event_id, {sql_pick("event_id", "=props", "=props", "=substr(props, 1, 5)", "", "=' ' || props", "[1]", "  ", "=props || ',0] junk'", "=props || ',0],['")} AS line FROM events)
SELECT event_id, CASE WHEN json_valid(line) AND starts_with(trim(line), '{{') THEN json_extract_string(line, '$.k') END AS k,
  CASE WHEN NOT (json_valid(line) AND starts_with(trim(line), '{{')) THEN 'bad_json' END AS reason FROM r WHERE trim(line) <> ''""",
)
def q_bad_json_rows(spark, sf):
    lines = table(spark, sf, "events").select("event_id", pick("event_id", *_LINES).alias("line"))
    good, bad = split_lines(lines, "k int")
    return good.select("event_id", F.col("k").cast("string").alias("k"), F.lit(None).cast("string").alias("reason")).unionByName(
        bad.select("event_id", F.lit(None).cast("string").alias("k"), "reason")
    )


def usage(spark, sf):
    step = pick("event_id", "=event_type", fixed.RESEARCH_STEP, fixed.SYNTHESIS_STEP)
    return table(spark, sf, "events").select(
        step.alias("step"), F.expr("CAST(value * 100 AS BIGINT)").alias("input_tokens"), F.expr("CAST(value * 10 AS BIGINT)").alias("output_tokens")
    )


_SQL_USAGE = f"""u AS (SELECT {sql_pick("event_id", "=event_type", fixed.RESEARCH_STEP, fixed.SYNTHESIS_STEP)} AS step,
  CAST(trunc(value * 100) AS BIGINT) AS i, CAST(trunc(value * 10) AS BIGINT) AS o FROM events)"""


@query(
    "q_token_cost",
    f"""WITH {_SQL_USAGE}, s AS (SELECT step, sum(i) AS i, sum(o) AS o, CASE WHEN step IN ('{fixed.RESEARCH_STEP}', '{fixed.SYNTHESIS_STEP}') THEN sum(i) / 1e6 * 0.5 + sum(o) / 1e6 * 3.0 END AS cost FROM u GROUP BY step)
SELECT step, CAST(i AS BIGINT) AS input_tokens, CAST(o AS BIGINT) AS output_tokens, round(cost, 6) AS cost FROM s
UNION ALL SELECT NULL, CAST(sum(i) AS BIGINT), CAST(sum(o) AS BIGINT), round(sum(cost), 6) FROM s""",
)
def q_token_cost(spark, sf):
    return ledger.token_costs(usage(spark, sf)).withColumn("cost", F.round("cost", 6))


@query(
    "q_run_summary",
    f"""WITH {_SQL_USAGE}, t AS (SELECT count(*) AS total FROM orders), d AS (SELECT count(*) AS done, floor(epoch(max(ts))) - floor(epoch(min(ts))) AS seconds FROM events WHERE event_type <> 'error'),
k AS (SELECT sum(i) AS i, sum(o) AS o FROM u)
SELECT CAST(total AS BIGINT) AS total, CAST(done AS BIGINT) AS done, CAST(total - done AS BIGINT) AS remaining, round(done * 100.0::DOUBLE / total, 6) AS percent,
  round(done / seconds, 6) AS rows_per_second, round((total - done) / (done / seconds), 3) AS seconds_left, round(i / 1e6 * 0.5 + o / 1e6 * 3.0, 6) AS cost FROM t, d, k""",
)
def q_run_summary(spark, sf):
    done = table(spark, sf, "events").where("event_type <> 'error'").select(F.col("ts").alias("finished_at"))
    summary = ledger.run_summary(table(spark, sf, "orders").select("o_orderkey"), done, usage(spark, sf))
    return summary.select(
        "total", "done", "remaining", F.round("percent", 6).alias("percent"), F.round("rows_per_second", 6).alias("rows_per_second"),
        F.round("seconds_left", 3).alias("seconds_left"), F.round("cost", 6).alias("cost"),
    )


_SQL_OUTCOMES = """o AS (SELECT event_id, user_id, CASE WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'view' THEN 'FAILED_PARSE' END AS rs,
  CASE WHEN event_id % 3 = 0 THEN 'm' || event_id END AS re, CASE WHEN event_id % 5 = 0 THEN 'bad reply' WHEN event_id % 5 = 1 THEN '' END AS se FROM events),
l AS (SELECT event_id, user_id, 'gemini_search' AS failed_step, COALESCE(re, 'Unknown error') AS error FROM o WHERE rs = 'ERROR'
  UNION ALL SELECT event_id, user_id, 'gemini_finalizer', se FROM o WHERE se <> '')"""


def outcomes(spark, sf):
    return table(spark, sf, "events").select(
        F.struct(F.col("user_id").alias("id"), "event_id").alias("original_record"), "event_id",
        F.expr("CASE WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'view' THEN 'FAILED_PARSE' END").alias("research_status"),
        F.expr("CASE WHEN event_id % 3 = 0 THEN concat('m', event_id) END").alias("research_error"),
        F.expr("CASE WHEN event_id % 5 = 0 THEN 'bad reply' WHEN event_id % 5 = 1 THEN '' END").alias("synthesis_error"),
    )


@query(
    "q_retry_ledger",
    f"WITH {_SQL_OUTCOMES} SELECT event_id, user_id, failed_step, error, '2024-01-01T00:00:00' AS timestamp FROM l",
)
def q_retry_ledger(spark, sf):
    rows = ledger.retry_rows(outcomes(spark, sf), F.lit("2024-01-01T00:00:00"))
    return rows.select("original_record.event_id", F.col("original_record.id").alias("user_id"), "failed_step", "error", "timestamp")


@query(
    "q_finished_rows",
    f"WITH {_SQL_OUTCOMES} SELECT event_id FROM o WHERE COALESCE(se, '') = ''",
)
def q_finished_rows(spark, sf):
    return ledger.finished_rows(outcomes(spark, sf)).select("event_id")


@query(
    "q_retry_feed",
    f"""WITH {_SQL_OUTCOMES} SELECT user_id AS id, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS nth FROM (SELECT DISTINCT user_id, event_id FROM l)) WHERE nth = 1""",
)
def q_retry_feed(spark, sf):
    rows = ledger.retry_rows(outcomes(spark, sf), F.col("original_record.event_id"))
    return ledger.retry_feed(rows)


_START, _LIMIT = 100, 2500
_RECORD = """concat('{"id": "', user_id, '", "type": "', event_type, '"}')"""
_SQL_RECORD = _RECORD.replace("concat(", "").removesuffix(")").replace(", user_id,", " || user_id ||").replace(", event_type,", " || event_type ||")


@query(
    "q_run_totals",
    f"""WITH r AS (SELECT event_id AS pos, user_id, event_type AS type, {sql_pick("event_id", f"={_SQL_RECORD}", f"={_SQL_RECORD}", f"={_SQL_RECORD} || ',0] junk'", "  ", f"={_SQL_RECORD}")} AS line FROM events),
j AS (SELECT *, CASE WHEN pos < {_START} THEN 'earlier' WHEN trim(line) = '' THEN 'blank' WHEN NOT json_valid(line) THEN 'bad_json'
  WHEN user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') THEN 'kept' ELSE 'skipped' END AS outcome FROM r),
n AS (SELECT *, CASE WHEN outcome = 'kept' THEN row_number() OVER (PARTITION BY outcome ORDER BY pos) END AS nth FROM j),
e AS (SELECT COALESCE(max(pos) FILTER (nth = {_LIMIT}), (SELECT max(pos) FROM r)) AS last FROM n),
o AS (SELECT pos, type, CASE WHEN outcome <> 'earlier' AND pos > last THEN 'later' ELSE outcome END AS outcome FROM n, e)
SELECT count(*) AS lines, {", ".join(f"count(*) FILTER (outcome = '{o}') AS {o}" for o in ("earlier", "blank", "bad_json", "skipped", "kept", "later"))},
  count(*) FILTER (outcome = 'kept' AND type <> 'click') AS written,
  count(*) FILTER (outcome = 'kept' AND type = 'click') + count(*) FILTER (outcome = 'kept' AND type = 'error') AS failed FROM o""",
)
def q_run_totals(spark, sf):
    """One run over lines: resumed behind the first hundred, limited, with an id filter; a failed research is written and retried."""
    line = pick("event_id", f"={_RECORD}", f"={_RECORD}", f"=concat({_RECORD}, ',0] junk')", "  ", f"={_RECORD}")
    lines = table(spark, sf, "events").select(F.col("event_id").alias("_ord"), line.alias("line"))
    ids = table(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("id"))
    found = run_input.read(lines, struct(id=S, type=S), ids, _START, _LIMIT)
    record = F.struct("id", "type")
    outcomes = durable(
        found.records.select(
            record.alias("original_record"), record.alias("final"),
            F.when(F.col("type") == "error", "ERROR").alias("research_status"), F.lit(None).cast("string").alias("research_error"),
            F.when(F.col("type") == "click", "no reply").alias("synthesis_error"),
        ),
        "outcomes",
    )
    written = run_input.write(outcomes, durable_path(spark, "finished"), durable_path(spark, "retries"), F.lit("2024-01-01T00:00:00"))
    return run_input.totals(spark, found.counts, written)


@query("q_stream_incremental", "SELECT event_id, user_id, event_type FROM events WHERE event_type <> 'error'")
def q_stream_incremental(spark, sf):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    stream = incremental.landed_stream(spark, f"{sf}/events*.parquet", schema, "parquet", 1)
    output, checkpoint = durable_path(spark, "stream-out"), durable_path(spark, "stream-state")
    job = lambda rows: rows.where("event_type <> 'error'").select("event_id", "user_id", "event_type")
    incremental.run_available(stream, job, output, checkpoint)
    return spark.read.schema("event_id long, user_id long, event_type string").parquet(output)


@query(
    "q_stream_first_wins",
    "SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY user_id, event_type",
)
def q_stream_first_wins(spark, sf):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    stream = incremental.landed_stream(spark, f"{sf}/events*.parquet", schema, "parquet", 1).select("user_id", "event_type", "event_id")
    root, checkpoint = durable_path(spark, "first-wins"), durable_path(spark, "stream-state")
    incremental.run_first_wins(stream, root, checkpoint, ["user_id", "event_type"], ["event_id"])
    return incremental.first_wins_table(spark, root, stream.schema).drop("batch")
