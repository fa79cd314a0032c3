"""Normalisers for licence-register fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterforge import fixed
from rosterforge.functions.text import any_word, strip

ACTIVE = "Active"
INACTIVE = "Inactive"
UNKNOWN = "Unknown"
TEMPORARILY_CLOSED = "Temporarily Closed"


def status_from_flag(flag: Column) -> Column:
    """Register that keeps a Y/N flag."""
    folded = F.lower(flag)
    return F.when(folded == "y", ACTIVE).when(folded == "n", INACTIVE).otherwise(UNKNOWN)


def status_from_words(words: Column) -> Column:
    """Register that describes the status in words; only "not active" negates."""
    folded = F.lower(words)
    return (
        F.when(folded.contains("not active"), INACTIVE)
        .when(folded.contains("active"), ACTIVE)
        .otherwise(UNKNOWN)
    )


def normalize_type(raw: Column) -> Column:
    folded = F.lower(raw)
    chosen = F
    for label, words in fixed.TYPE_WORDS:
        chosen = chosen.when(folded.rlike(any_word(words)), label)
    return chosen.otherwise(fixed.OTHER_TYPE)


def normalize_date(raw: Column) -> Column:
    """ISO date of a timestamp or of M/D/YYYY; other texts stay as they are."""
    padded = F.regexp_replace(F.regexp_replace(raw, r"^([^/])/", "0$1/"), r"/([^/])/", "/0$1/")
    padded = F.regexp_replace(F.regexp_replace(padded, r"^/", "00/"), r"//", "/00/")
    return (
        F.when(raw.contains("T"), F.substring_index(raw, "T", 1))
        .when(raw.rlike(r"^[^/]*/[^/]*/[^/]*\z"), F.regexp_replace(padded, r"^([^/]*)/([^/]*)/([^/]*)\z", "$3-$1-$2"))
        .when(raw != "", raw)
    )


def normalize_phone(raw: Column) -> Column:
    digits = F.regexp_replace(raw, r"[^\p{Nd}]", "")
    # ten digits, after one leading country digit 1 if there is one
    return F.nullif(F.regexp_extract(digits, r"^1?(\p{Nd}{10})\z", 1), F.lit(""))


def normalize_email(raw: Column) -> Column:
    # both an @ and a dot, in any order
    whole = r"(?s)^.*(?:@.*\.|\..*@).*\z"
    return F.nullif(F.regexp_extract(F.lower(strip(raw)), whole, 0), F.lit(""))


def parse_capacity(raw: Column) -> Column:
    return F.when(raw.rlike(r"^[0-9]+\z"), raw.try_cast("bigint"))


def parse_coordinate(raw: Column) -> Column:
    """Number of a coordinate; absent and empty ones are zero, unreadable ones null."""
    return F.when(strip(raw) != "", strip(raw).try_cast("double")).otherwise(F.lit(0.0))
