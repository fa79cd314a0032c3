"""Landed licence registers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterforge.functions.replies import is_json_object
from rosterforge.operators.ordering import page_slice
from rosterforge.sources.arrays import scan_array


def scan_order() -> Column:
    """Position of a row in its source: file, block within the file, row.

    Sorts as the rows stand in the files, whatever task read them.  Only good
    straight after a scan.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(hadoop_path)
    return found is not None and len(found) > 0


def scan_register(
    spark: SparkSession, path: str, schema: T.StructType, json_lines: bool = True
) -> DataFrame:
    """Register dump with its raw row (`_raw`) and position (`_ord`).

    Both JSON Lines and, with ``json_lines=False``, files of one JSON array
    each are split over tasks.
    """
    if json_lines:
        text = spark.read.text(path).select(
            F.col("value").alias("_raw"), scan_order().alias("_ord")
        )
        return (
            text.where(F.trim("_raw") != "")
            .select(*_parsed(schema))
            .select("r.*", "_raw", "_ord", "_broken")
        )
    elements = scan_array(spark, path)
    return elements.select(*_parsed(schema, F.col("_whole"))).select("r.*", "_raw", "_ord", "_broken")


def _parsed(schema: T.StructType, whole: Column | None = None) -> list[Column]:
    """Fields of a raw line, and whether it is broken: no JSON object, or only a part of one."""
    good = is_json_object(F.col("_raw"))
    good = good if whole is None else good & whole
    return [
        F.from_json("_raw", schema).alias("r"), F.col("_raw"), F.col("_ord"), (~good).alias("_broken"),
    ]


def scan_registers(
    spark: SparkSession, paths: dict[str, tuple[str, T.StructType]], json_lines: bool = True
) -> tuple[dict[str, DataFrame], list[str]]:
    """Scan every register that is there; name those that are missing."""
    found: dict[str, DataFrame] = {}
    missing: list[str] = []
    for code, (path, schema) in paths.items():
        if path_exists(spark, path):
            found[code] = scan_register(spark, path, schema, json_lines)
        else:
            missing.append(code)
    return found, missing


def landed_slice(df: DataFrame, order: str, offset: int = 0, limit: int | None = None) -> DataFrame:
    """Rows of a landed batch by position in id order, from ``offset`` on."""
    return page_slice(df, order, offset, limit)
