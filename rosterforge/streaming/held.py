"""Index of the keys that a stream has seen: digests in buckets, one segment a batch.

`of=<n>/first=<a>/last=<b>/bucket=<k>/` holds the digests that the batches a to b
brought.  A batch asks only the buckets that its own keys fall in, so what it
reads follows the batch, not the history.  After `fold` segments the next batch
first writes them as one; a segment counts only once its job has committed, and
a batch that is run again replaces its own segment and sees none but earlier
ones.  The index holds nothing that the kept rows do not say: one that is
missing is built from them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 256
FOLD = 16
_SCHEMA = "key binary, of int, first long, last long, bucket int"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, root: str):
    return _path(spark, root).getFileSystem(spark._jsc.hadoopConfiguration())


def bucket_of(key: Column, n_buckets: int) -> Column:
    """Bucket of a digest."""
    return F.pmod(F.xxhash64(key), F.lit(n_buckets)).cast("int")


def buckets(spark: SparkSession, root: str, wanted: int = BUCKETS) -> int:
    """The number of buckets that the index was made with, whatever is asked for later."""
    made = _fs(spark, root).globStatus(_path(spark, f"{root}/of=*")) or []
    return int(made[0].getPath().getName().split("=")[1]) if made else wanted


def _all_segments(spark: SparkSession, root: str) -> list[tuple[int, int]]:
    """Committed segments as (first, last), sorted."""
    done = _fs(spark, root).globStatus(_path(spark, f"{root}/of=*/first=*/last=*/_SUCCESS")) or []
    spans = []
    for status in done:
        last = status.getPath().getParent()
        spans.append(tuple(int(p.getName().split("=")[1]) for p in (last.getParent(), last)))
    return sorted(spans)


def segments(spark: SparkSession, root: str, before: int) -> list[tuple[int, int]]:
    """Fewest committed segments that hold all batches below ``before``: a folded one hides those in it."""
    spans = [s for s in _all_segments(spark, root) if s[1] < before]
    return [s for s in spans if not any(o != s and o[0] <= s[0] and s[1] <= o[1] for o in spans)]


def _folder(root: str, n_buckets: int, span: tuple[int, int]) -> str:
    return f"{root}/of={n_buckets}/first={span[0]}/last={span[1]}"


def _read(spark: SparkSession, root: str, n_buckets: int, spans: list[tuple[int, int]]) -> DataFrame:
    if not spans:
        return spark.createDataFrame([], _SCHEMA)
    paths = [_folder(root, n_buckets, s) for s in spans]
    return spark.read.schema(_SCHEMA).option("basePath", root).parquet(*paths)


def digests(spark: SparkSession, root: str, touched: list[int], before: int) -> DataFrame:
    """Digests (`key`) in the touched buckets that batches below ``before`` brought."""
    n_buckets = buckets(spark, root)
    found = _read(spark, root, n_buckets, segments(spark, root, before))
    # a partition column: other buckets are not opened
    return found.where(F.col("bucket").isin(sorted(touched))).select("key")


def add(keys: DataFrame, root: str, first: int, last: int, n_buckets: int) -> None:
    """Writes the digests (`key`) of the batches ``first`` to ``last`` as one segment, in place of any earlier try."""
    placed = keys.select("key", bucket_of(F.col("key"), n_buckets).alias("bucket"))
    # a bucket goes to one task, or to several if it is large
    placed.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(
        _folder(root, n_buckets, (first, last))
    )


def forget(spark: SparkSession, root: str, since: int) -> None:
    """Removes segments that reach ``since`` or later: tries of the batch that now runs, or of a stream since started anew."""
    for span in _all_segments(spark, root):
        if span[1] >= since:
            _fs(spark, root).delete(_path(spark, _folder(root, buckets(spark, root), span)), True)


def fold(spark: SparkSession, root: str, before: int, most: int = FOLD) -> bool:
    """Writes all segments below ``before`` as one, if there are more than ``most``; then removes hidden ones.

    To be called when the batches below ``before`` are committed and no other
    run reads the index.
    """
    spans = segments(spark, root, before)
    n_buckets = buckets(spark, root)
    folded = len(spans) > max(most, 1)
    if folded:
        whole = (spans[0][0], max(s[1] for s in spans))
        add(_read(spark, root, n_buckets, spans).select("key"), root, *whole, n_buckets)
    seen = segments(spark, root, before)
    for span in _all_segments(spark, root):
        if span[1] < before and span not in seen:
            _fs(spark, root).delete(_path(spark, _folder(root, n_buckets, span)), True)
    return folded
