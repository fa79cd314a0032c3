"""Tables as numbered versions: a new one is written whole, then read.

Plain Parquet cannot merge, and a path must not be overwritten while it is
read.  A version counts only once its job has committed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _folder(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def versions(spark: SparkSession, root: str) -> list[int]:
    """Committed versions under ``root``, oldest first."""
    fs, path = _folder(spark, root)
    done = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, "v=*/_SUCCESS")) or []
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in done)


def current(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Newest version, or an empty table."""
    found = versions(spark, root)
    if not found:
        return spark.range(0).selectExpr(*[f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema])
    return spark.read.schema(schema).parquet(f"{root}/v={found[-1]:08d}")


def publish(df: DataFrame, root: str) -> str:
    """Writes ``df`` as the next version and returns its path."""
    spark = df.sparkSession
    found = versions(spark, root)
    path = f"{root}/v={(found[-1] + 1 if found else 1):08d}"
    # an unfinished attempt of the same number is replaced
    df.write.mode("overwrite").parquet(path)
    return path
