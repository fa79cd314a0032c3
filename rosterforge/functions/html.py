"""Readable text, links and media of stored pages.

Scripts, styles and comments go first: they may hold text that looks like
markup.  Elements end where their nesting says.  Everything stays in the JVM
and works on one row at a time.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterforge import fixed
from rosterforge.functions.text import plain_spaces, strip

# Patterns start with a literal "<", so that other characters are passed at once.
HIDDEN = (
    r"(?is)<(?:script\b[^>]*>.*?</script\s*>|style\b[^>]*>.*?</style\s*>"
    r"|noscript\b[^>]*>.*?</noscript\s*>|template\b[^>]*>.*?</template\s*>|!--.*?-->)"
)
HEAD = r"(?is)<head\b[^>]*>.*?</head\s*>"
BREAKING = (
    r"(?i)<(?:br\b|/?(?:p|div|li|ul|ol|h[1-6]|tr|table|section|article|main|header|footer|nav|"
    r"aside|form|blockquote|pre|dl|dt|dd|figure|figcaption|address|hr)\b)[^>]*>"
)
TAG = r"<[^>]*>"
# a link's target in double, single or no quotes
ANCHOR = r"(?is)<a\s(?:[^>]*?[\s\"'])?href\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'<>=`]+)"

# main content candidates, in order: element name or id/class value
CONTENT_ELEMENTS = ["main", "article"]
CONTENT_NAMES = ["content", "main"]

# fixed values: elements without content
VOID_ELEMENTS = [
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
]

# Named references are the table of the HTML standard as Python ships it; the
# older ones among them may stand without the closing semicolon.
NAMED = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
OPEN_NAMES = sorted((name for name in html5 if not name.endswith(";")), key=len, reverse=True)
# numbers 128 to 159 mean characters of Windows code page 1252, where it has any
CONTROLS = "".join(map(chr, range(128, 160)))
CONTROLS_MEAN = "".join(bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160))
REPLACEMENT = "\ufffd"


def visible(html: Column) -> Column:
    return F.regexp_replace(html, HIDDEN, "")


def _once(value: Column, rule) -> Column:
    """A rule that reads its value several times, over a value worked out once."""
    return F.get(F.transform(F.array(value), rule), F.lit(0))


def _character(number: Column) -> Column:
    """Character of a code point; the replacement character where there is none."""
    none = number.isNull() | (number == 0) | (number > 0x10FFFF) | number.between(0xD800, 0xDFFF)
    wide = F.lpad(F.hex(F.when(none, F.lit(0xFFFD)).otherwise(number)), 8, "0")
    return F.translate(F.decode(F.unhex(wide), "UTF-32"), CONTROLS, CONTROLS_MEAN)


def _number(digits: Column, base: int) -> Column:
    """Value of a digit string; null beyond seven digits, which no code point has."""
    bare = F.ltrim(digits, F.lit("0"))
    return F.when(F.char_length(bare) <= 7, F.coalesce(F.conv(bare, base, 10).cast("bigint"), F.lit(0)))


def _named_text() -> Column:
    """Text of every named reference."""
    return F.from_json(F.lit(json.dumps(NAMED)), "map<string,string>")


def _behind_ampersand(part: Column, in_attribute: bool) -> Column:
    """Text of one part between ampersands, with its reference resolved."""
    # a name without semicolon counts in an attribute only if no more of a name or "=" follows
    limit = "(?![A-Za-z0-9=])" if in_attribute else ""
    decimal = F.regexp_extract(part, "^#([0-9]+);?", 1)
    hexadecimal = F.regexp_extract(part, "^#[xX]([0-9a-fA-F]+);?", 1)
    closed = F.regexp_extract(part, "^([A-Za-z][A-Za-z0-9]*);", 1)
    opened = F.regexp_extract(part, f"^({'|'.join(OPEN_NAMES)}){limit}", 1)
    named = F.when(closed != "", F.try_element_at(_named_text(), closed))
    rest = lambda pattern: F.regexp_replace(part, pattern, "")
    numeric = "^#(?:[0-9]+|[xX][0-9a-fA-F]+);?"
    return (
        F.when(part.startswith("amp;"), F.concat(F.lit("&"), F.substr(part, F.lit(5))))
        .when(decimal != "", F.concat(_character(_number(decimal, 10)), rest(numeric)))
        .when(hexadecimal != "", F.concat(_character(_number(hexadecimal, 16)), rest(numeric)))
        .when(named.isNotNull(), F.concat(named, F.substr(part, F.char_length(closed) + 2)))
        .when(
            opened != "",
            F.concat(F.try_element_at(_named_text(), opened), F.substr(part, F.char_length(opened) + 1)),
        )
        .otherwise(F.concat(F.lit("&"), part))
    )


def decode(text: Column, in_attribute: bool = False) -> Column:
    """Character references resolved once: numbers in both bases and every name of the standard.

    What is no reference stays as it is.  The parts between ampersands are
    looked at one by one, so nothing is resolved twice.
    """
    def joined(parts: Column) -> Column:
        tail = F.transform(F.slice(parts, 2, F.size(parts)), lambda p: _behind_ampersand(p, in_attribute))
        return F.concat(F.get(parts, F.lit(0)), F.array_join(tail, ""))

    return _once(text, lambda t: F.when(t.contains("&"), _once(F.split(t, "&"), joined)).otherwise(t))


def inner_text(fragment: Column) -> Column:
    """Rendered text: blocks on their own lines, inline space collapsed."""
    collapsed = F.regexp_replace(plain_spaces(fragment), "  +", " ")
    broken = F.regexp_replace(collapsed, BREAKING, "\n")
    # space on both sides of an inline tag is one space
    bare = decode(F.regexp_replace(F.regexp_replace(broken, TAG, ""), "  +", " "))
    return F.btrim(F.regexp_replace(bare, " *\n[ \n]*", "\n"), F.lit(" \n"))


def _opening(name: str, has: str = "") -> str:
    """Pattern of a start tag (group 1: its name) and all behind it (group 2)."""
    return rf"(?s)<({name})(?=[\s/>]){has}[^>]*>(.*)$"


def _has(attribute: str, value: str) -> str:
    """Pattern of an attribute that holds a value among words; names ignore case, values do not."""
    letters = "".join(f"[{c.upper()}{c}]" for c in attribute)
    around = lambda quote: rf"{quote}(?:[^{quote}>]*\s)?{value}(?:\s[^{quote}>]*)?{quote}"
    return rf"(?:[^>]*[\s\"'])?(?<=[\s\"']){letters}\s*=\s*(?:{around(chr(34))}|{around(chr(39))}|{value}(?=[\s>]))"


def content_openings(shown: Column) -> Column:
    """Name and rest of the page behind the start tag, for every main-content candidate in order."""
    patterns = [_opening(f"(?i:{name})") for name in CONTENT_ELEMENTS]
    for value in CONTENT_NAMES:
        patterns += [_opening("[A-Za-z][A-Za-z0-9-]*", r"\s" + _has(a, value)) for a in ("id", "class")]
    found = [
        F.struct(
            F.lower(F.regexp_extract(shown, pattern, 1)).alias("name"), F.regexp_extract(shown, pattern, 2).alias("rest")
        )
        for pattern in patterns
    ]
    return F.array(*found)


def _closings(opening: Column) -> Column:
    """Rest behind a start tag cut at each end tag of the same name; nothing behind a void element."""
    void = (opening["name"] == "") | opening["name"].isin(VOID_ELEMENTS)
    parts = F.split(opening["rest"], F.concat(F.lit("(?i)</"), opening["name"], F.lit(r"\s*>")))
    return F.struct(opening["name"].alias("name"), F.when(~void, parts).alias("parts"))


def _inside(cut: Column) -> Column:
    """The parts up to the end tag that brings the nesting of its name back to nothing, else all."""
    start_tag = F.concat(F.lit("(?i)<"), cut["name"], F.lit(r"(?=[\s/>])"))

    def step(state: Column, part: Column) -> Column:
        depth = state["depth"] + F.regexp_count(part, start_tag) - F.lit(1)
        return F.when(state["depth"] == 0, state).otherwise(
            F.struct(depth.alias("depth"), (state["taken"] + 1).alias("taken"))
        )

    begin = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("taken"))
    taken = F.aggregate(cut["parts"], begin, step, lambda state: state["taken"])
    # the end tags come back, since they may break lines
    closed = F.transform(
        F.slice(cut["parts"], F.lit(1), taken), lambda part: F.concat(part, F.lit("</"), cut["name"], F.lit(">"))
    )
    return F.coalesce(F.array_join(closed, ""), F.lit(""))


def body(html: Column) -> Column:
    """Page without hidden parts and head."""
    return F.regexp_replace(visible(html), HEAD, "")


def content_texts(openings: Column) -> Column:
    """Texts of the main-content candidates in their order, empty where absent."""
    # one lambda for all: six copies of the text rules outgrow compiled code
    return F.transform(F.transform(openings, _closings), lambda cut: inner_text(_inside(cut)))


def chosen_text(texts: Column, shown: Column) -> Column:
    """First rich candidate, else the text of the whole body."""
    rich = F.get(F.filter(texts, lambda t: F.char_length(t) > fixed.MAIN_TEXT_MIN_CHARS), F.lit(0))
    return F.when(rich.isNotNull(), rich).otherwise(inner_text(shown))


def attribute(tag: Column, name: str) -> Column:
    """Raw value of a tag attribute, null where absent or empty."""
    quoted = F.regexp_extract(tag, rf"(?is)[\s\"']{name}\s*=\s*([\"'])(.*?)\1", 2)
    bare = F.regexp_extract(tag, rf"(?is)[\s\"']{name}\s*=\s*([^\s\"'<>=`]+)", 1)
    return F.coalesce(F.nullif(quoted, F.lit("")), F.nullif(bare, F.lit("")))


def anchors(html: Column) -> Column:
    """`href` values of the page's links in page order."""
    targets = F.regexp_extract_all(visible(html), F.lit(ANCHOR), F.lit(1))
    return F.transform(targets, lambda h: decode(strip(F.regexp_replace(h, r"^[\"']|[\"']$", "")), True))


def image_tags(html: Column) -> Column:
    return F.regexp_extract_all(visible(html), F.lit(r"(?is)(<img\b[^>]*>)"), F.lit(1))


def image_source(tag: Column) -> Column:
    """src, else the lazy-load attributes, else the first of the srcset."""
    found = F.coalesce(
        attribute(tag, "src"),
        attribute(tag, "data-src"),
        attribute(tag, "data-original"),
        # an empty match is no http link and falls out later
        F.regexp_extract(attribute(tag, "srcset"), r"^\s*([^\s,]+)", 1),
    )
    return decode(strip(found), True)
