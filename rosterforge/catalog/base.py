"""Registry of queries, and derived inputs written once per engine."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterforge.functions.text import SPACES
from rosterforge.sources.spread import spread

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def add(run: Run) -> Run:
        REGISTRY[name] = Query(run, sql)
        return run

    return add


def table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    """Table of the benchmark; with columns, over all cores for heavy work."""
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    return spread(df.select(*columns)) if columns else df


# --- the same derived value in both engines --------------------------------

def pick(key: str, *values: str | None) -> Column:
    """One of several values by key; ``=`` marks a Spark SQL expression."""
    options = ", ".join(f"CAST({_spark_option(v)} AS STRING)" for v in values)
    return F.expr(f"element_at(array({options}), CAST(pmod({key}, {len(values)}) + 1 AS INT))")


def _spark_option(value: str | None) -> str:
    if value is None:
        return "NULL"
    if value.startswith("="):
        return value[1:]
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def sql_text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def sql_pick(key: str, *values: str | None) -> str:
    """As `pick`, for DuckDB."""
    options = [v[1:] if v is not None and v.startswith("=") else sql_text(v) for v in values]
    casts = ", ".join(f"CAST({o} AS VARCHAR)" for o in options)
    return f"list_extract([{casts}], CAST(({key}) % {len(options)} + 1 AS INTEGER))"


# --- rules as DuckDB SQL ----------------------------------------------------

SQL_SPACE = "[" + "".join(rf"\x{{{ord(c):x}}}" for c in SPACES) + "]"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SQL_SPACE}+|{SQL_SPACE}+$', '', 'g')"


def sql_name(x: str) -> str:
    squeezed = f"regexp_replace({sql_strip(x)}, '{SQL_SPACE}+', ' ', 'g')"
    cased = r"\p{Lu}\p{Ll}\p{Lt}"
    runs = f"regexp_extract_all({squeezed}, '[{cased}]+|[^{cased}]+')"
    first = "CASE WHEN substr(w, 1, 1) = 'ß' THEN 'Ss' ELSE upper(substr(w, 1, 1)) END"
    titled = f"array_to_string(list_transform({runs}, lambda w: {first} || lower(substr(w, 2))), '')"
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN 'Unknown' ELSE {titled} END"


def sql_any(x: str, words: list[str]) -> str:
    return "COALESCE((" + " OR ".join(f"contains({x}, {sql_text(w)})" for w in words) + "), false)"


def sql_type(x: str) -> str:
    t = f"lower({x})"
    return (
        f"CASE WHEN {sql_any(t, ['child placing', 'agency', 'placement'])} THEN 'Agency'"
        f" WHEN {sql_any(t, ['residential', 'treatment', 'shelter'])} THEN 'Residential'"
        f" WHEN {sql_any(t, ['center'])} THEN 'Center'"
        f" WHEN {sql_any(t, ['home', 'family'])} THEN 'Home'"
        f" WHEN {sql_any(t, ['school'])} THEN 'School' ELSE 'Other' END"
    )


def sql_status_flag(x: str) -> str:
    return f"CASE lower({x}) WHEN 'y' THEN 'Active' WHEN 'n' THEN 'Inactive' ELSE 'Unknown' END"


def sql_status_words(x: str) -> str:
    return (
        f"CASE WHEN contains(lower({x}), 'not active') THEN 'Inactive'"
        f" WHEN contains(lower({x}), 'active') THEN 'Active' ELSE 'Unknown' END"
    )


def sql_date(x: str) -> str:
    part = lambda i: f"split_part({x}, '/', {i})"
    pad = lambda p: f"CASE WHEN length({p}) < 2 THEN lpad({p}, 2, '0') ELSE {p} END"
    return (
        f"CASE WHEN {x} = '' THEN NULL WHEN contains({x}, 'T') THEN split_part({x}, 'T', 1)"
        f" WHEN length({x}) - length(replace({x}, '/', '')) = 2"
        f" THEN {part(3)} || '-' || {pad(part(1))} || '-' || {pad(part(2))} ELSE {x} END"
    )


def sql_phone(x: str) -> str:
    digits = rf"regexp_replace({x}, '[^\p{{Nd}}]', '', 'g')"
    ten = f"CASE WHEN length({digits}) = 11 AND {digits} LIKE '1%' THEN substr({digits}, 2) ELSE {digits} END"
    return f"CASE WHEN length({ten}) = 10 THEN {ten} END"


def sql_email(x: str) -> str:
    folded = f"lower({sql_strip(x)})"
    return f"CASE WHEN contains({folded}, '@') AND contains({folded}, '.') THEN {folded} END"


def sql_capacity(x: str) -> str:
    return f"CASE WHEN regexp_full_match({x}, '[0-9]+') THEN TRY_CAST({x} AS BIGINT) END"


def sql_domain(x: str) -> str:
    return f"regexp_replace(regexp_extract({x}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^www\\.', '')"


def sql_blank(x: str) -> str:
    return f"COALESCE({x} = '', true)"


def sql_or(a: str, b: str) -> str:
    return f"COALESCE(NULLIF({a}, ''), {b})"
