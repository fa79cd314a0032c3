"""Id lists given as text or as files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterforge.functions.text import strip


def explode_ids(text: Column) -> Column:
    """One id per comma or line."""
    return F.explode(F.split(text, "[,\n]"))


def ids_of(df: DataFrame, text: str, name: str = "id") -> DataFrame:
    """Distinct, trimmed, filled ids of a text column."""
    return (
        df.select(explode_ids(F.col(text)).alias(name))
        .select(strip(F.col(name)).alias(name))
        .where(F.col(name) != "")
        .distinct()
    )


def ids_from_file(spark: SparkSession, path: str) -> DataFrame:
    return ids_of(spark.read.text(path), "value")


def ids_from_text(spark: SparkSession, text: str) -> DataFrame:
    return ids_of(spark.range(1).select(F.lit(text).alias("value")), "value")
