"""Model replies and epoch times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterforge.functions.text import strip


def strip_fence(reply: Column) -> Column:
    """Reply text without a surrounding Markdown code fence."""
    text = strip(reply)
    size = F.char_length(text)
    return (
        F.when(text.startswith("```json"), F.substring(text, F.lit(8), F.greatest(size - 10, F.lit(0))))
        .when(text.startswith("```"), F.substring(text, F.lit(4), F.greatest(size - 6, F.lit(0))))
        .otherwise(text)
    )


def is_json_object(text: Column) -> Column:
    """Whole text is one well-formed JSON object, whatever its fields.

    Repeated keys (the last counts) and NaN are well-formed.  The text is read
    as the first of two array elements.  The second is the text's own digest,
    which no text can hold: an array that the text itself closes, whatever
    follows, does not end in it.
    """
    mark = F.md5(text)
    pair = F.from_json(F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]')), "array<string>", {"allowSingleQuotes": "false"})
    return F.coalesce(strip(text).startswith("{") & (F.size(pair) == 2) & (F.element_at(pair, -1) == mark), F.lit(False))


def parse_object(text: Column, schema: T.StructType | str) -> Column:
    """Typed object of a JSON text; null where the text is not a JSON object."""
    return F.when(is_json_object(text), F.from_json(text, schema))


def epoch_seconds(value: Column) -> Column:
    """Whole epoch seconds; zero, blank and unreadable give null."""
    seconds = strip(value.cast("string")).try_cast("bigint")
    return F.when(seconds != 0, seconds)


def epoch_to_timestamp(value: Column) -> Column:
    """Epoch seconds as an instant."""
    return F.timestamp_seconds(epoch_seconds(value))


def epoch_to_iso(value: Column) -> Column:
    """Epoch seconds as UTC text, whatever the time zone of the session."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.date_format(F.timestamp_add("SECOND", epoch_seconds(value), epoch), "yyyy-MM-dd'T'HH:mm:ss")
