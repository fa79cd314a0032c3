"""The lines of one run: where it resumes, what its limit takes, and how many lines went where."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterforge.functions.replies import is_json_object
from rosterforge.functions.text import strip
from rosterforge.operators import ledger
from rosterforge.operators.ordering import nth
from rosterforge.session import durable_path
from rosterforge.sinks.files import write_jsonl

# what becomes of a line
KEPT, SKIPPED, BAD, BLANK, EARLIER, LATER = "kept", "skipped", "bad_json", "blank", "earlier", "later"
OUTCOMES = (KEPT, SKIPPED, BAD, BLANK, EARLIER, LATER)


@dataclass(frozen=True)
class RunInput:
    """``records`` has the parsed columns and `_ord`, ``bad`` has `_ord, line`; ``counts`` is lines by outcome."""

    records: DataFrame
    bad: DataFrame
    counts: dict[str, int]


def _judged(lines: DataFrame, schema: T.StructType, ids: DataFrame | None, start: int, key: str) -> DataFrame:
    """`_ord, line, _record, _outcome`; a record without an id has the empty one."""
    text = F.col("line")
    rows = lines.select("_ord", text).select(
        "_ord",
        "line",
        F.when(F.col("_ord") < start, EARLIER)
        .when(F.coalesce(strip(text), F.lit("")) == "", BLANK)
        .when(~is_json_object(text), BAD)
        .alias("_outcome"),
    )
    rows = rows.withColumn("_record", F.when(F.col("_outcome").isNull(), F.from_json("line", schema)))
    if ids is None:
        return rows.withColumn("_outcome", F.coalesce("_outcome", F.lit(KEPT)))
    wanted = ids.select(F.col(key).cast("string").alias("_id")).distinct().withColumn("_wanted", F.lit(True))
    # a left join by a unique key keeps every line, and a common id is split like any skewed key
    rows = rows.withColumn("_id", F.when(F.col("_outcome").isNull(), F.coalesce(F.col(f"_record.{key}").cast("string"), F.lit(""))))
    kind = F.coalesce("_outcome", F.when(F.col("_wanted"), KEPT).otherwise(SKIPPED))
    return rows.join(wanted, "_id", "left").withColumn("_outcome", kind).drop("_id", "_wanted")


def read(
    lines: DataFrame,
    schema: T.StructType,
    ids: DataFrame | None = None,
    start: int = 0,
    limit: int | None = None,
    key: str = "id",
) -> RunInput:
    """Records of a run from text lines (`_ord, line`) in the order of `_ord`.

    Lines before ``start`` are left out.  Blank lines, lines that are no JSON
    object and records whose id is not among ``ids`` are passed over; the first
    ``limit`` of the rest are taken (0 or None: all), and reading stops behind
    the last of them: later lines count as `later`, whatever they hold.

    The lines are judged and written in one pass, which counts them on its way;
    a limit reads the positions of the copy again, nothing else.
    """
    spark = lines.sparkSession
    path = durable_path(spark, "run-input")
    seen = Observation("run-input")
    judged = _judged(lines, schema, ids, start, key)
    # counted in the stage that writes, where every row is written once, however often a lost task runs again
    tallies = [F.count_if(F.col("_outcome") == o).alias(o) for o in OUTCOMES]
    judged.observe(seen, *tallies).write.partitionBy("_outcome").parquet(path)
    counts = {o: int(seen.get[o]) for o in OUTCOMES}
    rows = spark.read.schema(T.StructType([*judged.schema.fields])).parquet(path)
    if limit and counts[KEPT] >= limit:
        last = nth(rows.where(F.col("_outcome") == KEPT), "_ord", limit)[0]
        inside = F.col("_outcome").isin(EARLIER) | (F.col("_ord") <= last)
        found = {r["_outcome"]: r["n"] for r in rows.where(inside).groupBy("_outcome").agg(F.count("*").alias("n")).collect()}
        total = sum(counts.values())
        counts = {o: int(found.get(o, 0)) for o in OUTCOMES}
        counts[LATER] = total - sum(counts.values())
        rows = rows.where(inside)
    return RunInput(
        rows.where(F.col("_outcome") == KEPT).select("_ord", "_record.*"),
        rows.where(F.col("_outcome") == BAD).select("_ord", "line"),
        counts,
    )


def write(outcomes: DataFrame, output: str, retries: str, run_time, final: str = "final") -> dict[str, int]:
    """Writes finished records and the retry ledger as JSON Lines; rows of each, counted as they are written.

    ``outcomes`` as in `ledger.retry_rows`, with the finished record in the
    struct ``final``; it is read twice, so it should be a written table.
    """
    done, failed = Observation("finished"), Observation("retries")
    counted = F.count(F.lit(1)).alias("n")
    finished = ledger.finished_rows(outcomes).select(f"{final}.*")
    write_jsonl(finished.observe(done, counted), output)
    write_jsonl(ledger.retry_rows(outcomes, run_time).observe(failed, counted), retries)
    return {"written": int(done.get["n"]), "failed": int(failed.get["n"])}


def totals(spark: SparkSession, read_counts: dict[str, int], written: dict[str, int]) -> DataFrame:
    """One row: `lines, earlier, blank, bad_json, skipped, kept, later, written, failed`."""
    row = {"lines": sum(read_counts.values()), **read_counts, **written}
    names = ["lines", EARLIER, BLANK, BAD, SKIPPED, KEPT, LATER, "written", "failed"]
    return spark.createDataFrame([tuple(row[n] for n in names)], ", ".join(f"{n} long" for n in names))
