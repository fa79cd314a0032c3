"""First-wins, top-n and position rules that survive hot groups.

A group may hold a third of all rows, so none of these gathers a whole group
in one task: winners are found by aggregates that combine on the map side,
limits are applied before the exchange, positions come from bucket counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterforge.session import durable

# Largest n for which Spark limits each group before the exchange
# (spark.sql.optimizer.windowGroupLimitThreshold).
_GROUP_LIMIT = 1000


def _columns(names: list[str] | str) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def first_n_per(df: DataFrame, keys: list[str] | str, order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows of every group in a total order; null keys are a group.

    Up to 1,000 rows Spark itself drops the surplus before the exchange.
    Beyond that rows are dealt by ranges of (keys, order), so that a group of
    any size lies in many tasks; the counts of the ranges say which of them
    are in, out, or hold a group's n-th row, and only those last are numbered.
    """
    keys = _columns(keys)
    if n > _GROUP_LIMIT:
        return _first_n_in_ranges(df, keys, order, n)
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") <= n).drop("_rank")


def _in_ranges(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` written in ranges of ``order``, with the range's number as `_part`."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the number is written down: it must not change when a lost task runs again
    return durable(df.repartitionByRange(tasks, *order).withColumn("_part", F.spark_partition_id()), "ranges")


def _first_n_in_ranges(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    placed = _in_ranges(df, [*[F.col(k) for k in keys], *order])
    # a row per group and range that holds some of it: groups and ranges together, at most
    below = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        placed.groupBy(*keys, "_part")
        .agg(F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(below), F.lit(0)))
        .where(F.col("_before") < n)
    )
    other = {k: f"_group{i}" for i, k in enumerate([*keys, "_part"])}
    renamed = counts.select(*[F.col(k).alias(other[k]) for k in other], "_n", "_before")
    near = placed.join(renamed, [F.col(k).eqNullSafe(F.col(other[k])) for k in other])
    cut = F.col("_before") + F.col("_n") > n
    ranked = Window.partitionBy(*keys, "_part").orderBy(*order)
    split = near.where(cut).withColumn("_rank", F.row_number().over(ranked)).where(F.col("_before") + F.col("_rank") <= n)
    return near.where(~cut).select(*df.columns).unionByName(split.select(*df.columns))


def nth(df: DataFrame, order: str, n: int) -> tuple | None:
    """Value of the ``n``-th row (from 1) by one sortable column, nulls first, and the rows below that value.

    None if there are fewer rows.  Only this column is dealt by ranges; the
    driver gets one count a range, and one range is sorted.
    """
    placed = _in_ranges(df.select(F.col(order).alias("_at")), [F.col("_at")])
    start = 0
    for part, count in sorted(tuple(r) for r in placed.groupBy("_part").count().collect()):
        if start + count >= n:
            mine = placed.where(F.col("_part") == part).select("_at")
            value = mine.orderBy("_at").offset(n - start - 1).limit(1).first()["_at"]
            lower = F.lit(False) if value is None else F.col("_at").isNull() | (F.col("_at") < F.lit(value))
            return value, start + mine.where(lower).count()
        start += count
    return None


def first_n(df: DataFrame, order: str, n: int) -> DataFrame:
    """First ``n`` rows over all by one sortable column, nulls first; of ties at the end any.

    Up to 1,000 rows each task sends its own first ``n``.  Beyond that the
    n-th value is found by ranges and the rest is a filter: rows do not move.
    """
    if n <= _GROUP_LIMIT:
        return df.orderBy(order).limit(n)
    found = nth(df, order, n)
    if found is None:
        return df
    value, below = found
    if value is None:
        return df.where(F.col(order).isNull()).limit(n)
    lower = df.where(F.col(order).isNull() | (F.col(order) < F.lit(value)))
    return lower.unionByName(df.where(F.col(order) == F.lit(value)).limit(n - below))


def keep_first(df: DataFrame, keys: list[str] | str, order: list[Column]) -> DataFrame:
    """The first row of every group in a total order."""
    return first_n_per(df, keys, order, 1)


def digest(*values: Column) -> Column:
    """256-bit key of several texts; null and empty differ."""
    parts = [F.coalesce(F.concat(F.lit("="), v.cast("string")), F.lit("-")) for v in values]
    sized = [F.concat(F.char_length(p).cast("string"), p) for p in parts]
    return F.unhex(F.sha2(F.concat(*sized), 256))


def mark_first(df: DataFrame, keys: list[Column], row_id: str, order: list[str], flag: str) -> DataFrame:
    """``df`` with a flag on the first row of every group.

    The group key is a digest and the winner a partial aggregate, so a group
    of a billion copies shrinks to one row per task before the exchange; the
    flag comes back over the unique ``row_id``, never over the hot key.
    """
    if order == [row_id]:
        winner = F.min(row_id)
    else:
        winner = F.min_by(F.col(row_id), F.struct(*order))
    winners = (
        df.select(digest(*keys).alias("_key"), row_id, *[c for c in order if c != row_id])
        .groupBy("_key")
        .agg(winner.alias(row_id))
        .select(row_id, F.lit(True).alias(flag))
    )
    return df.join(winners, row_id, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def bucket_edges(df: DataFrame, order: str, buckets: int) -> list:
    """Near-even edges of a numeric order column: fewer than ``buckets`` numbers."""
    shares = [i / buckets for i in range(1, buckets)]
    if not shares:
        return []
    found = df.select(F.percentile_approx(order, shares, buckets * 10).alias("edges")).first()
    return sorted(set(found["edges"] or []))


def _bucket_of(value: Column, edges: list, low: int, high: int) -> Column:
    """Number of edges at or below ``value``, by bisection."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(value < F.lit(edges[middle]), _bucket_of(value, edges, low, middle)).otherwise(
        _bucket_of(value, edges, middle + 1, high)
    )


def page_slice(df: DataFrame, order: str, offset: int = 0, limit: int | None = None) -> DataFrame:
    """Rows after the first ``offset`` in the order of a unique numeric column.

    ``orderBy(...).offset(...).limit(...)`` brings offset + limit rows into one
    task.  Here rows are cut into near-even ranges of the order column, only
    ranges that overlap the page are kept, and rows are numbered within their
    range from the count of all lower ranges.
    """
    if limit is None and offset == 0:
        return df
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    edges = bucket_edges(df, order, min(partitions, 1000))
    placed = df.withColumn("_bucket", _bucket_of(F.col(order), edges, 0, len(edges)))
    # one row per range, 1,000 at most, whatever the table holds
    below = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        placed.groupBy("_bucket")
        .agg(F.count("*").alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(below), F.lit(0)))
        .where(F.col("_start") + F.col("_n") > offset)
    )
    if limit is not None:
        ranges = ranges.where(F.col("_start") < offset + limit)
    position = F.col("_start") + F.row_number().over(Window.partitionBy("_bucket").orderBy(order))
    paged = (
        placed.join(F.broadcast(ranges.drop("_n")), "_bucket")
        .withColumn("_position", position)
        .where(F.col("_position") > offset)
    )
    if limit is not None:
        paged = paged.where(F.col("_position") <= offset + limit)
    return paged.drop("_bucket", "_start", "_position")
