"""Registers to unified records, drops, counts and ingestion rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterforge import schemas
from rosterforge.operators import selection, unify
from rosterforge.operators.publish import latest, upsert
from rosterforge.operators.unify import LocationFilter
from rosterforge.session import durable
from rosterforge.sinks import versions
from rosterforge.sources.registers import scan_registers

REGISTER_SCHEMAS = {"TX": schemas.RAW_TX, "WA": schemas.RAW_WA}


@dataclass(frozen=True)
class UnifyResult:
    kept: DataFrame
    drops: DataFrame
    counts: DataFrame
    missing: list[str]


def unify_registers(
    registers: dict[str, DataFrame],
    where: LocationFilter = LocationFilter(),
    limit: int | None = None,
    sample: bool = False,
    seed: int = 0,
) -> DataFrame:
    """Unified rows with `drop_reason`, from scanned registers.

    A state filter leaves whole registers unread.  ``limit`` takes the first
    (or a sample of) rows per register before any filter.
    """
    wanted = {code: raw for code, raw in registers.items() if where.wants(code)}
    rows = unify.union_registers(wanted or registers)
    if not wanted:
        rows = rows.where(F.lit(False))
    if limit is not None and sample:
        rows = selection.sample_per_source(rows, limit, seed)
    else:
        rows = selection.first_per_source(rows, limit)
    # finding duplicates reads the rows twice: raw JSON is parsed and
    # standardised once, the second reader needs three columns of the copy
    return unify.with_drop_reason(durable(rows, "standardised"), where)


def run(
    spark: SparkSession,
    paths: dict[str, str],
    where: LocationFilter = LocationFilter(),
    limit: int | None = None,
    sample: bool = False,
    seed: int = 0,
    json_lines: bool = True,
) -> UnifyResult:
    """Scan, standardise, filter, dedupe; nothing is written but one durable copy."""
    wanted = {c: (p, REGISTER_SCHEMAS[c]) for c, p in paths.items() if where.wants(c)}
    found, missing = scan_registers(spark, wanted, json_lines)
    if not found:
        raise ValueError(f"no register found: {missing}")
    # kept, drops and counts all read the same written rows
    reasoned = durable(unify_registers(found, where, limit, sample, seed), "unify")
    kept, drops = unify.split_drops(reasoned)
    return UnifyResult(kept.drop("_source"), drops, unify.drop_counts(drops), missing)


def ingest(spark: SparkSession, kept: DataFrame, root: str, batch_id: str, fetched_at: str, dry_run: bool = False) -> DataFrame:
    """Upserts kept rows into the ingestion table, of one id the last; a dry run only returns it."""
    last = latest(kept, ["id"], [F.col("_ord").desc()]) if "_ord" in kept.columns else kept
    fresh = unify.ingestion_rows(last, batch_id, fetched_at)
    table = versions.current(spark, root, fresh.schema)
    result = upsert(table, fresh, ["daycare_id"], [F.col("original_record").desc()])
    if dry_run:
        return result
    return spark.read.schema(fresh.schema).parquet(versions.publish(result, root))
