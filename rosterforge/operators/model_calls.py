"""Per-row calls of a function the caller brings, with retries."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterforge import fixed, schemas
from rosterforge.operators.ordering import keep_first
from rosterforge.session import durable
from rosterforge.sources.registers import path_exists

REPLY_BUCKETS = 64
_KEYS = ["daycare_id", "input_md5"]

# prompt -> (reply text, input tokens, output tokens) or the same and the reply's sources, (uri, title) each
ModelFunction = Callable[[str], tuple]


def call_with_retry(fn: ModelFunction, prompt: str, tries: int, first_wait: float) -> tuple:
    """Reply, tokens and the last error; a failing row never fails the job."""
    error = None
    for attempt in range(tries):
        try:
            reply, used, made, *sources = fn(prompt)
            chunks = [{"uri": uri, "title": title} for uri, title in (sources[0] or [])] if sources else []
            return reply, int(used or 0), int(made or 0), None, chunks
        except Exception as failure:  # noqa: BLE001 - whatever the caller's function raises
            error = str(failure) or type(failure).__name__
            if attempt + 1 < tries:
                time.sleep(first_wait * 2**attempt)
    return None, 0, 0, error, []


def apply_model(
    prompts: DataFrame,
    make_function: Callable[[], ModelFunction],
    step: str,
    tries: int = fixed.MODEL_TRIES,
    first_wait: float = fixed.MODEL_FIRST_WAIT,
    in_flight: int = 1,
) -> DataFrame:
    """One stored-reply row per row of ``prompts`` (`daycare_id, prompt`).

    ``make_function`` runs once per task, so a client is built where it is
    used.  A task has at most ``in_flight`` calls open at a time (more than one
    asks for a function that threads can share); replies keep the order of
    their prompts.  Run this after every gate: filters do not move through it.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = make_function()
        with ThreadPoolExecutor(max(in_flight, 1)) as pool:
            for batch in batches:
                yield answered(batch, list(pool.map(lambda p: call_with_retry(fn, p, tries, first_wait), batch["prompt"])))

    def answered(batch: pd.DataFrame, answers: list[tuple]) -> pd.DataFrame:
        reply, used, made, error, chunks = zip(*answers) if answers else ((),) * 5
        return pd.DataFrame(
            {
                "daycare_id": batch["daycare_id"],
                "step": step,
                "input_md5": batch["input_md5"],
                "reply": list(reply),
                "input_tokens": list(used),
                "output_tokens": list(made),
                "error": list(error),
                "chunks": list(chunks),
                "called_at": pd.Timestamp.now(tz="UTC"),
            }
        )

    keyed = prompts.select("daycare_id", F.md5("prompt").alias("input_md5"), "prompt")
    return keyed.mapInPandas(run, schemas.MODEL_REPLY)


def reply_bucket(n_buckets: int = REPLY_BUCKETS) -> Column:
    """Bucket of a stored reply, by record and prompt."""
    return F.pmod(F.xxhash64(*_KEYS), F.lit(n_buckets)).cast("int")


def stored_replies(spark: SparkSession, store: str, step: str | None = None, buckets: list[int] | None = None) -> DataFrame:
    """Replies of a store (`step=.../bucket=...`); of one step and of some buckets only these folders are read."""
    schema = T.StructType([*schemas.MODEL_REPLY.fields, T.StructField("bucket", T.IntegerType())])
    if not path_exists(spark, store):
        return spark.createDataFrame([], schemas.MODEL_REPLY)
    rows = spark.read.schema(schema).parquet(store)
    if step is not None:
        rows = rows.where(F.col("step") == step)
    if buckets is not None:
        rows = rows.where(F.col("bucket").isin(sorted(buckets)))
    return rows.select(*schemas.MODEL_REPLY.names)


def missing_replies(prompts: DataFrame, stored: DataFrame, step: str) -> DataFrame:
    """Prompts without a stored good reply to the same text in the same step."""
    done = stored.where((F.col("step") == step) & F.col("error").isNull()).select(*_KEYS)
    keyed = prompts.withColumn("input_md5", F.md5("prompt"))
    return keyed.join(done, _KEYS, "left_anti").drop("input_md5")


def run_model(
    prompts: DataFrame, make_function: Callable[[], ModelFunction], step: str, store: str,
    n_buckets: int = REPLY_BUCKETS, **settings,
) -> DataFrame:
    """Calls only what is missing, appends the replies to ``store``, returns one row per record and prompt.

    Of several stored replies to one prompt a good one counts before a failed
    one, then the newest.  Replies are written before anything reads them, so
    neither a later failure nor a second reader pays twice; rows that repeat a
    record and its prompt are one call.

    The store has a folder per step and bucket, and only those that the prompts
    fall in are read: a retry of a few records leaves the rest closed.  A store
    keeps the ``n_buckets`` that it was made with.
    """
    spark = prompts.sparkSession
    # prompts are long texts with a costly lineage; they are asked for three times
    asked = durable(prompts.select("daycare_id", "prompt").withColumn("input_md5", F.md5("prompt")), "prompts")
    keys = asked.select(*_KEYS)
    buckets = [r[0] for r in keys.select(reply_bucket(n_buckets)).distinct().collect()]
    before = stored_replies(spark, store, step, buckets)
    todo = missing_replies(asked.dropDuplicates(_KEYS), before, step)
    fresh = apply_model(todo, make_function, step, **settings).withColumn("bucket", reply_bucket(n_buckets))
    # written by the tasks that call: with a shuffle between, a lost executor would cost its calls again
    fresh.write.mode("append").partitionBy("step", "bucket").parquet(store)
    wanted = stored_replies(spark, store, step, buckets).join(keys, _KEYS, "left_semi")
    order = [F.col("error").isNotNull(), F.col("called_at").desc(), F.col("reply"), F.col("error")]
    return keep_first(wanted, ["daycare_id", "step", "input_md5"], order)
