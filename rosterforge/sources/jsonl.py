"""JSON Lines records, with bad lines kept apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterforge.functions.replies import is_json_object
from rosterforge.functions.text import strip
from rosterforge.sources.registers import scan_order


def split_lines(lines: DataFrame, schema: T.StructType | str, line: str = "line") -> tuple[DataFrame, DataFrame]:
    """Parsed records and bad rows of a table of text lines.

    Blank lines are neither.  Other columns of ``lines`` pass through.
    """
    kept = lines.where(strip(F.col(line)) != "")
    good = is_json_object(F.col(line))
    rest = [c for c in lines.columns if c != line]
    records = (
        kept.where(good)
        .select(*rest, F.from_json(F.col(line), schema).alias("_r"))
        .select(*rest, "_r.*")
    )
    bad = kept.where(~good).select(*rest, line, F.lit("bad_json").alias("reason"))
    return records, bad


def scan_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    lines = spark.read.text(path).select(F.col("value").alias("line"), scan_order().alias("_ord"))
    return split_lines(lines, schema)
