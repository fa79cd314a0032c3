"""URL and file-name rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterforge import fixed
from rosterforge.functions.text import any_word, contains_any


def clean_url(url: Column) -> Column:
    """URL without its query string; the fragment stays."""
    return F.regexp_replace(url, r"^([^?#]*)\?[^#]*", "$1")


def site_domain(url: Column) -> Column:
    """Authority part of an absolute URL minus one leading ``www.``."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    return F.regexp_replace(authority, r"^www\.", "")


def asset_kind(url: Column) -> Column:
    folded = F.lower(url)
    image = folded.rlike(f"(?:{any_word(fixed.IMAGE_SUFFIXES)})\\z")
    return F.when(folded.endswith(".pdf"), "pdf").when(image, "image")


def text_asset_name(url: Column) -> Column:
    return F.concat(F.lit("content_"), F.md5(url), F.lit(".txt"))


def image_asset_name(url: Column) -> Column:
    suffix = F.when(url.endswith(".png"), ".png").when(url.endswith(".webp"), ".webp").otherwise(".jpg")
    return F.concat(F.lit("img_"), F.md5(url), suffix)


def pdf_asset_name(url: Column) -> Column:
    return F.concat(F.lit("doc_"), F.md5(url), F.lit(".pdf"))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def content_type(path: Column) -> Column:
    """MIME type by extension, with a default for the unknown."""
    extension = F.lower(F.regexp_extract(base_name(path), r"\.([^.]+)\z", 1))
    known = F.create_map(*[F.lit(x) for pair in fixed.CONTENT_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, extension), F.lit(fixed.DEFAULT_CONTENT_TYPE))


def normalize_link(url: Column) -> Column:
    """Link as the frontier compares it: no fragment, no trailing slashes."""
    return F.regexp_replace(F.substring_index(url, "#", 1), r"/+\z", "")


def resolve_link(base: Column, href: Column) -> Column:
    """Absolute form of an ``href`` found on page ``base``.

    Covers absolute, scheme-relative, root-relative, fragment, query and
    plain relative references.  Dot segments are left as they are.
    """
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    without_fragment = F.substring_index(base, "#", 1)
    without_query = F.substring_index(without_fragment, "?", 1)
    path = F.substring(without_query, F.char_length(root) + 1, F.lit(1 << 30))
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_extract(path, r"^(.*/)", 1))
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(root, href))
        .when(href == "", without_fragment)
        .when(href.startswith("#"), F.concat(without_fragment, href))
        .when(href.startswith("?"), F.concat(without_query, href))
        .otherwise(F.concat(root, folder, href))
    )


def is_blocked_link(url: Column) -> Column:
    return contains_any(F.lower(url), fixed.BLOCKED_LINK_WORDS)


def is_priority_link(url: Column) -> Column:
    return contains_any(F.lower(url), fixed.PRIORITY_LINK_WORDS)


def pdf_score(url: Column, path: Column) -> Column:
    """Two points per wanted word, minus one per unwanted word."""
    text = F.lower(F.when(F.coalesce(url, F.lit("")) != "", url).otherwise(base_name(path)))
    score = F.lit(0)
    for word in fixed.PDF_PRIORITY_WORDS:
        score = score + F.when(text.contains(word), 2).otherwise(0)
    for word in fixed.PDF_LOW_WORDS:
        score = score - F.when(text.contains(word), 1).otherwise(0)
    return score
