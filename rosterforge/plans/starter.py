"""Smallest flow: rows, first per id, processing time, JSON Lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterforge import schemas
from rosterforge.operators.ordering import keep_first
from rosterforge.sinks.files import write_jsonl


def starter_rows(spark: SparkSession, rows: list[tuple]) -> tuple[DataFrame, Observation]:
    """In-memory rows in their order, and an observation of their count."""
    placed = [(*row, i) for i, row in enumerate(rows)]
    schema = T.StructType([*schemas.STARTER.fields, T.StructField("_ord", T.LongType())])
    seen = Observation("starter")
    return spark.createDataFrame(placed, schema).observe(seen, F.count("*").alias("count")), seen


def first_by_id(rows: DataFrame, run_time: Column, key: str = "id", order: str = "_ord") -> DataFrame:
    return keep_first(rows, key, [F.col(order)]).withColumn("processed_at", run_time)


def run(rows: DataFrame, run_time: Column, path: str) -> None:
    write_jsonl(first_by_id(rows, run_time).drop("_ord"), path)
