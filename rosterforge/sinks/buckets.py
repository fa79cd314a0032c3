"""Keyed tables in buckets: a change rewrites only the buckets that it touches.

`data/<run>/table_bucket=<n>/` holds rows and is never changed.  `manifest/m=<n>/`
lists one folder per filled bucket and is the table's version: it counts only
once its job has committed, so a run that dies leaves the table as it was.
One writer at a time; readers may go on with the manifest that they read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterforge.operators import publish as p
from rosterforge.session import durable

BUCKETS = 256
KEEP = 3
_PART = "table_bucket"
_MANIFEST = "bucket int, folder string, n_buckets int"
Merge = Callable[[DataFrame, DataFrame], DataFrame]


def _fs(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def manifests(spark: SparkSession, root: str) -> list[int]:
    """Committed versions, oldest first."""
    done = _fs(spark, root).globStatus(_path(spark, f"{root}/manifest/m=*/_SUCCESS")) or []
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in done)


def folders(spark: SparkSession, root: str, version: int | None = None) -> dict[int, str]:
    """Folder of every filled bucket; at most as many rows as the table has buckets."""
    known = manifests(spark, root)
    if not known:
        return {}
    rows = spark.read.schema(_MANIFEST).parquet(f"{root}/manifest/m={known[-1] if version is None else version:08d}")
    return {r["bucket"]: r["folder"] for r in rows.collect()}


def _n_buckets(spark: SparkSession, root: str, wanted: int) -> int:
    """The number that the table was made with, whatever is asked for later."""
    known = manifests(spark, root)
    if not known:
        return wanted
    first = spark.read.schema(_MANIFEST).parquet(f"{root}/manifest/m={known[-1]:08d}").agg(F.max("n_buckets")).first()[0]
    return wanted if first is None else first


def _rows(spark: SparkSession, root: str, names: list[str], schema: T.StructType) -> DataFrame:
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/data/{name}" for name in names])


def current(spark: SparkSession, root: str, schema: T.StructType, version: int | None = None) -> DataFrame:
    """The newest version, or an older one that is still kept; no version: an empty table."""
    return _rows(spark, root, list(folders(spark, root, version).values()), schema)


def bucket_of(keys: list[str], n_buckets: int) -> Column:
    """Bucket of a row by its keys; null parts are like any other value."""
    return F.pmod(F.xxhash64(*keys), F.lit(n_buckets)).cast("int")


def change(
    fresh: DataFrame, root: str, bucket_keys: list[str], merge: Merge, n_buckets: int = BUCKETS, keep: int = KEEP
) -> int | None:
    """Next version: ``merge(old rows, new rows)`` in every bucket that ``fresh`` touches.

    ``merge`` must leave rows in their buckets: those with other keys as they
    are.  Returns the version, or None for an empty ``fresh`` and a table that
    was never written.  Versions beyond the newest ``keep`` are removed, with
    the folders that only they hold.
    """
    spark = fresh.sparkSession
    size = _n_buckets(spark, root, n_buckets)
    known = manifests(spark, root)
    # both the touched buckets and the merge read it
    fresh = durable(fresh, "upsert")
    bucket = bucket_of(bucket_keys, size)
    touched = {r[0] for r in fresh.select(bucket).distinct().collect()}
    if not touched:
        return known[-1] if known else None
    before = folders(spark, root)
    old = _rows(spark, root, [name for b, name in before.items() if b in touched], fresh.schema)
    run = uuid.uuid4().hex
    # rebalancing gives a bucket to one task, or to several if it is large
    merged = merge(old, fresh).select(*fresh.columns, bucket.alias(_PART)).hint("rebalance", _PART)
    merged.write.partitionBy(_PART).parquet(f"{root}/data/{run}")
    written = _fs(spark, root).globStatus(_path(spark, f"{root}/data/{run}/{_PART}=*")) or []
    after = {b: name for b, name in before.items() if b not in touched}
    for status in written:
        name = status.getPath().getName()
        after[int(name.split("=")[1])] = f"{run}/{name}"
    version = known[-1] + 1 if known else 1
    rows = [(b, name, size) for b, name in sorted(after.items())]
    # an unfinished attempt of the same number is replaced
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/m={version:08d}")
    _retire(spark, root, keep)
    return version


def _retire(spark: SparkSession, root: str, keep: int) -> None:
    known = manifests(spark, root)
    kept, gone = known[-max(keep, 1):], known[: -max(keep, 1)]
    if not gone:
        return
    needed = {name for m in kept for name in folders(spark, root, m).values()}
    unused = {name for m in gone for name in folders(spark, root, m).values()} - needed
    fs = _fs(spark, root)
    # a version goes before its rows: none is ever listed without them
    for m in gone:
        fs.delete(_path(spark, f"{root}/manifest/m={m:08d}"), True)
    for name in unused:
        fs.delete(_path(spark, f"{root}/data/{name}"), True)


def upsert(
    fresh: DataFrame, root: str, keys: list[str], order: list[Column], columns: list[str] | None = None,
    n_buckets: int = BUCKETS, keep: int = KEEP,
) -> int | None:
    """New rows win over old ones of equal keys, the first by ``order`` (newest first) among themselves.

    Null key parts are equal.  Only ``columns`` are stored: ``order`` may use
    others, such as the row's position.
    """
    last = p.latest(fresh, keys, order).select(*(columns or fresh.columns))
    return change(last, root, keys, lambda old, new: p.put(old, new, keys), n_buckets, keep)


def replace_slice(fresh: DataFrame, root: str, key: str, n_buckets: int = BUCKETS, keep: int = KEEP) -> int | None:
    """Old rows of replaced sources give way where a key has new rows; other rows stay."""
    return change(fresh, root, [key], lambda old, new: p.replace_slice(old, new, key), n_buckets, keep)
