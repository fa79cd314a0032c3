"""Session settings and durable intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job is written for; all are public Spark settings.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # splits a hot key of a join even where that costs one more shuffle later
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = 8, memory: str = "12g", app: str = "rosterforge") -> SparkSession:
    """Session for tests and the bench on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        # call sites of column expressions cost several round trips each
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def durable_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    own = tempfile.mkdtemp(prefix="rosterforge-")
    spark.sparkContext.setCheckpointDir(own)
    return durable_dir(spark)


def durable_path(spark: SparkSession, label: str) -> str:
    return f"{durable_dir(spark)}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several branches need a costly result: the copy survives the
    loss of executors, keeps column pruning and pushdown for its readers, and
    gives the optimiser true sizes.
    """
    spark = df.sparkSession
    path = durable_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the workers this package, whatever folder the driver started in.

    Python functions that a job sends by reference are then found on every
    executor, and what they keep between tasks (loaded models) stays loaded.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="rosterforge-package-"), "rosterforge_package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as made:
        for folder, _, names in sorted(os.walk(package)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    made.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
