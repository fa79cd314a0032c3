"""Id filters, resume, limits and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.operators.ordering import first_n, first_n_per


def only_ids(df: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    return df.join(ids.select(key), key, "left_semi")


def not_done(df: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key is not yet in the finished set."""
    return df.join(done.select(key), key, "left_anti")


def first_per_source(df: DataFrame, n: int | None, source: str = "source_state", order: str = "_ord") -> DataFrame:
    """First ``n`` rows of every source, taken before any filter."""
    return df if n is None else first_n_per(df, source, [F.col(order)], n)


def sample_per_source(
    df: DataFrame, n: int | None, seed: int = 0, source: str = "source_state", key: str = "id"
) -> DataFrame:
    """Pseudo-random ``n`` rows per source; the same rows for the same seed."""
    if n is None:
        return df
    return first_n_per(df, source, [F.xxhash64(F.col(key), F.lit(seed)), F.col(key)], n)


def first_rows(df: DataFrame, n: int | None, order: str = "_ord") -> DataFrame:
    """First ``n`` rows over all."""
    return df if not n else first_n(df, order, n)
