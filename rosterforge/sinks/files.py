"""JSON Lines outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jsonl(df: DataFrame, path: str, resume: bool = False) -> None:
    """JSON Lines folder: a fresh run replaces it, a resumed run adds to it."""
    df.write.mode("append" if resume else "overwrite").option("ignoreNullFields", "false").json(path)


def append_retries(ledger: DataFrame, path: str) -> None:
    ledger.write.mode("append").option("ignoreNullFields", "false").json(path)
