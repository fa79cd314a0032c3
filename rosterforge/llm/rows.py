"""Whole rows picked by decisions that were made on narrow ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of `docs` whose (doc_id, hash of the text) is in `kept`; of exactly repeated ones, the first.

    `kept` has `doc_id` and `text_hash` (Spark's xxhash64 of the text).  The
    rows move once: both the numbering of repeated rows (limited per task before
    the shuffle) and the join need the same partitioning.
    """
    columns = docs.columns
    own = numbered(docs, F.struct(*[quoted(c) for c in columns]).alias("_row")).where("_n = 1")
    return own.join(wanted(kept), KEY, "left_semi").select("_row.*")


def quoted(name: str) -> Column:
    """The column of this very name, whatever signs it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


# A null id is told by a column of its own: plain equalities let the join reuse the numbering's shuffle.
KEY = ["_id", "_no_id", "_hash"]


def numbered(docs: DataFrame, payload: Column) -> DataFrame:
    """`payload` with the key of each row and `_n`, which numbers rows that repeat an id and a text."""
    own = docs.select(payload, *_key(docs["doc_id"], F.xxhash64(docs["text"])))
    return own.withColumn("_n", F.row_number().over(Window.partitionBy(*KEY).orderBy(F.lit(0))))


def wanted(decisions: DataFrame, *more: str) -> DataFrame:
    """Decisions (`doc_id`, `text_hash`) by the same key."""
    return decisions.select(*_key(F.col("doc_id"), F.col("text_hash")), *more)


def _key(doc_id: Column, text_hash: Column) -> list[Column]:
    return [
        F.coalesce(doc_id.cast("long"), F.lit(0)).alias("_id"), doc_id.isNull().alias("_no_id"), text_hash.alias("_hash"),
    ]
