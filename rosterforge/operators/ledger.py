"""Outcomes, retries, token costs and run summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterforge import fixed
from rosterforge.functions.text import is_blank
from rosterforge.operators.ordering import keep_first


def retry_rows(outcomes: DataFrame, run_time: Column) -> DataFrame:
    """Retry ledger: `original_record, failed_step, error, timestamp`.

    ``outcomes``: `original_record, research_status, research_error,
    synthesis_error`.  A failed research is retried though its record goes on;
    a record that fails both steps gives two rows.
    """
    failures = F.array_compact(
        F.array(
            F.when(
                F.col("research_status") == "ERROR",
                F.struct(
                    F.lit(fixed.RESEARCH_STEP).alias("failed_step"),
                    F.coalesce("research_error", F.lit("Unknown error")).alias("error"),
                ),
            ),
            F.when(
                ~is_blank(F.col("synthesis_error")),
                F.struct(
                    F.lit(fixed.SYNTHESIS_STEP).alias("failed_step"), F.col("synthesis_error").alias("error")
                ),
            ),
        )
    )
    return outcomes.select("original_record", F.explode(failures).alias("f")).select(
        "original_record", "f.failed_step", "f.error", run_time.alias("timestamp")
    )


def finished_rows(outcomes: DataFrame) -> DataFrame:
    """Records that reach the output: everything but a failed synthesis."""
    return outcomes.where(is_blank(F.col("synthesis_error")))


def retry_feed(ledger: DataFrame) -> DataFrame:
    """Original records to run again, the latest failure of each id."""
    flat = ledger.select("original_record.*", "timestamp", "failed_step")
    return keep_first(flat, "id", [F.col("timestamp").desc(), F.col("failed_step")]).drop(
        "timestamp", "failed_step"
    )


def token_costs(usage: DataFrame, prices: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Tokens and cost per step and in total (`step` null).

    Steps without a price are listed without a cost.
    """
    prices = prices or fixed.TOKEN_PRICES
    per_token = F.create_map(
        *[
            part
            for step, (paid_in, paid_out) in prices.items()
            for part in (F.lit(step), F.struct(F.lit(paid_in).alias("i"), F.lit(paid_out).alias("o")))
        ]
    )
    price = F.try_element_at(per_token, F.col("step"))
    millions = lambda c: F.col(c) / F.lit(1_000_000.0)
    steps = (
        usage.groupBy("step")
        .agg(F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"))
        .withColumn("cost", millions("input_tokens") * price["i"] + millions("output_tokens") * price["o"])
    )
    return steps.rollup("step").agg(
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
        F.sum("cost").alias("cost"),
    )


def run_summary(total: DataFrame, done: DataFrame, usage: DataFrame, price: tuple[float, float] = (0.50, 3.00)) -> DataFrame:
    """Progress of a run in one row; every step is priced alike."""
    # one bag of light rows and one aggregate, instead of joining three totals
    none = F.lit(None).cast("timestamp")
    zero = F.lit(0).cast("long")
    bag = (
        total.select(F.lit("all").alias("kind"), none.alias("at"), zero.alias("used"), zero.alias("made"))
        .unionByName(
            done.select(
                F.lit("done").alias("kind"), F.col("finished_at").cast("timestamp").alias("at"),
                zero.alias("used"), zero.alias("made"),
            )
        )
        .unionByName(
            usage.select(
                F.lit("tokens").alias("kind"), none.alias("at"),
                F.col("input_tokens").cast("long").alias("used"),
                F.col("output_tokens").cast("long").alias("made"),
            )
        )
    )
    counted = bag.agg(
        F.count_if(F.col("kind") == "all").alias("total"),
        F.count_if(F.col("kind") == "done").alias("done"),
        (F.unix_seconds(F.max("at")) - F.unix_seconds(F.min("at"))).alias("seconds"),
        F.coalesce(F.sum("used"), F.lit(0)).alias("input_tokens"),
        F.coalesce(F.sum("made"), F.lit(0)).alias("output_tokens"),
    )
    rate = F.col("done") / F.when(F.col("seconds") > 0, F.col("seconds"))
    remaining = F.col("total") - F.col("done")
    return counted.select(
        "total", "done",
        remaining.alias("remaining"),
        F.when(F.col("total") > 0, F.col("done") * 100.0 / F.col("total")).otherwise(0.0).alias("percent"),
        rate.alias("rows_per_second"),
        (remaining / F.when(rate > 0, rate)).alias("seconds_left"),
        (
            F.col("input_tokens") / 1_000_000.0 * price[0] + F.col("output_tokens") / 1_000_000.0 * price[1]
        ).alias("cost"),
    )
