"""New landed rows only, with a durable cursor, in the same semantics as batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterforge.operators.ordering import digest, keep_first
from rosterforge.sinks import versions
from rosterforge.streaming import held


def landed_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json", files_per_batch: int | None = None
) -> DataFrame:
    """Stream over a landing folder (or glob); new files are new rows."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def run_available(
    stream: DataFrame, job: Callable[[DataFrame], DataFrame], output: str, checkpoint: str
) -> None:
    """Runs ``job`` over everything new, appends its rows, keeps the cursor.

    The file sink records each batch once, so a batch that is run again after
    a failure adds nothing twice.
    """
    query = (
        job(stream)
        .writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def first_wins_batch(
    batch: DataFrame, table: DataFrame, keys: list[str], order: list[Column]
) -> DataFrame:
    """Rows of a batch that claim a key no earlier row holds; reads the keys of the whole table."""
    fresh = _first_by_digest(batch, keys, order)
    return fresh.join(table.select(_digest(keys).alias(_KEY)), _KEY, "left_anti").drop(_KEY)


_KEY = "_key"


def _digest(keys: list[str]) -> Column:
    return digest(*[F.col(k) for k in keys])


def _first_by_digest(batch: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return keep_first(batch.withColumn(_KEY, _digest(keys)), _KEY, order)


def run_first_wins(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    keys: list[str],
    order: list[str],
    n_buckets: int = held.BUCKETS,
    fold: int = held.FOLD,
) -> None:
    """Streaming dedupe: the first row of every key stays, across all batches.

    Each batch adds its new rows to `root/batch=<id>` and their digests to the
    index in `root/_held`; a rerun of the same batch replaces both.  Held keys
    are looked up only in the buckets that the batch touches: the rows kept
    before are not read.  Null key parts are equal; an empty batch adds nothing.
    ``n_buckets`` counts when the index is made, and should be large against
    the keys of a usual batch for a batch to read a part of it.
    """
    spark = stream.sparkSession
    schema = stream.schema
    index, staged = f"{root}/_held", f"{root}/_staged"

    def merge(batch: DataFrame, epoch: int) -> None:
        held.forget(spark, index, epoch)
        _complete_index(spark, root, schema, keys, index, epoch, n_buckets)
        held.fold(spark, index, epoch, fold)
        size = held.buckets(spark, index, n_buckets)
        # read three times: for its buckets, against the index, and for its rows
        _first_by_digest(batch, keys, [F.col(c) for c in order]).write.mode("overwrite").parquet(staged)
        first = spark.read.schema(T.StructType([*schema.fields, T.StructField(_KEY, T.BinaryType())])).parquet(staged)
        touched = [r[0] for r in first.select(held.bucket_of(F.col(_KEY), size)).distinct().collect()]
        known = held.digests(spark, index, touched, epoch).withColumnRenamed("key", _KEY)
        fresh = first.join(known, _KEY, "left_anti").select(*[f"`{c}`" for c in schema.names])
        fresh.write.mode("overwrite").parquet(f"{root}/batch={epoch}")
        rows = spark.read.schema(schema).parquet(f"{root}/batch={epoch}")
        held.add(rows.select(_digest(keys).alias("key")), index, epoch, epoch, size)

    query = (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    fs, path = versions._folder(spark, staged)
    fs.delete(path, True)


def _complete_index(
    spark: SparkSession, root: str, schema: T.StructType, keys: list[str], index: str, epoch: int, n_buckets: int
) -> None:
    """Digests of all kept rows below ``epoch`` where the index does not reach them, as for a table made without one."""
    fs, path = versions._folder(spark, root)
    known = held.segments(spark, index, epoch)
    listed = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, "batch=*/_SUCCESS")) or []
    batches = sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in listed)
    missing = [b for b in batches if b < epoch and not any(first <= b <= last for first, last in known)]
    if missing:
        size = held.buckets(spark, index, n_buckets)
        # one segment from the first to the last of them; batches between that were indexed come in again, which is no harm
        rows = first_wins_table(spark, root, schema).where(F.col("batch").between(missing[0], missing[-1]))
        held.add(rows.select(_digest(keys).alias("key")), index, missing[0], missing[-1], size)


def first_wins_table(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """All rows kept so far, with the `batch` that brought them."""
    whole = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    fs, path = versions._folder(spark, root)
    if not fs.exists(path):
        return spark.range(0).selectExpr(
            *[f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in whole]
        )
    return spark.read.schema(whole).parquet(root)
