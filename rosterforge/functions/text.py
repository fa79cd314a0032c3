"""Text rules as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterforge import fixed

# White space as `str.strip` and `str.split` see it.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def blank_to_null(value: Column) -> Column:
    """Null for the empty string: `blank_to_null(a)` then coalesce is "a or b"."""
    return F.when(value != "", value)


def first_filled(*values: Column) -> Column:
    """First value that is neither null nor empty; the last one as it is."""
    return F.coalesce(*[blank_to_null(v) for v in values[:-1]], values[-1])


def is_blank(value: Column) -> Column:
    return F.coalesce(value == "", F.lit(True))


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(SPACES))


def plain_spaces(value: Column) -> Column:
    """Every white-space character as a plain space."""
    return F.translate(value, SPACES, " " * len(SPACES))


def squeeze(value: Column) -> Column:
    """Edges stripped, inner white space runs turned into one space."""
    return F.trim(F.regexp_replace(plain_spaces(value), "  +", " "))


# a code point that no text holds
_MARK = "\uffff "


def title_words(value: Column) -> Column:
    """Capital after every character without case: O'Brien Kid-Care 1St.

    ``initcap`` only looks at spaces, so a marked space goes in wherever a
    cased character follows another one without case, and comes out again.
    """
    cased = r"\p{IsUppercase}\p{IsLowercase}\p{IsTitlecase}"
    marked = F.regexp_replace(value, f"([^{cased} ])(?=[{cased}])", f"$1{_MARK}")
    return F.replace(F.initcap(marked), F.lit(_MARK), F.lit(""))


def normalize_name(value: Column) -> Column:
    return F.when(is_blank(value), fixed.UNKNOWN_NAME).otherwise(title_words(squeeze(value)))


def any_word(words: list[str]) -> str:
    """Pattern that finds any of the plain words."""
    return "|".join(re.escape(word) for word in words)


def contains_any(value: Column, words: list[str]) -> Column:
    """True where one of the plain words occurs; null text never matches."""
    return F.coalesce(value.rlike(any_word(words)), F.lit(False))


def has_words(value: Column, n: int) -> Column:
    """At least ``n`` words; the pattern stops at the n-th."""
    return plain_spaces(value).rlike(rf"^ *[^ ]+(?: +[^ ]+){{{n - 1}}}")


def is_upper(value: Column) -> Column:
    """At least one cased character and none in lower case."""
    return (F.upper(value) == value) & (F.lower(value) != value)


def truncate_sentence(value: Column, limit: int = fixed.DESCRIPTION_CAP) -> Column:
    """Cut over-long text after its last sentence, else at its last space."""
    head = F.substring(value, 1, limit)
    sentences = F.regexp_extract(head, r"(?s)^.*[.!?]", 0)
    words = F.regexp_extract(head, r"(?s)^(.*) ", 1)
    cut = (
        F.when(F.char_length(sentences) > limit - fixed.DESCRIPTION_WINDOW + 1, sentences)
        .when(head.contains(" "), F.concat(words, F.lit("...")))
        .otherwise(F.concat(head, F.lit("...")))
    )
    return F.when(is_blank(value), "").when(F.char_length(value) <= limit, value).otherwise(cut)


def key_value_text(raw_json: Column) -> Column:
    """One `key: value` line per filled field of a raw JSON row, in its order."""
    entries = F.map_entries(F.from_json(raw_json, "map<string,string>"))
    filled = F.filter(entries, lambda e: F.coalesce(strip(e["value"]), F.lit("")) != "")
    lines = F.transform(filled, lambda e: F.concat(e["key"], F.lit(": "), strip(e["value"])))
    return F.array_join(lines, "\n")


def fold_lower(value: Column) -> Column:
    return F.lower(strip(value))


def fold_upper(value: Column) -> Column:
    return F.upper(strip(value))
