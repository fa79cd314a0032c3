"""Small inputs over all cores."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores where the scan alone cannot fill them.

    A Parquet file of one row group is one task, which leaves text work of
    hours to one core.  Inputs that give every core a full split, as large
    ones do, stay as they are: nothing is shuffled then.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = df._jdf.sparkSession().sessionState().conf().filesMaxPartitionBytes()
    size = str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if cores > 1 and int(size) < cores * split:
        return df.repartition(cores)
    return df
