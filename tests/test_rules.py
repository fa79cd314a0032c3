"""Edge rows of every rule; one job per rule keeps this quick."""

import pytest
from pyspark.sql import functions as F

from rosterforge.functions import images as im
from rosterforge.functions import matching as match
from rosterforge.functions import register as reg
from rosterforge.functions import replies as rp
from rosterforge.functions import text as tx
from rosterforge.functions import urls as u
from rosterforge.operators import publish, refine, synth
from rosterforge.operators.unify import LocationFilter



SINGLE = {
    "name": (tx.normalize_name, [
        ("  o'brien   kid-care 1st ", "O'Brien Kid-Care 1St"), (None, "Unknown"), ("", "Unknown"), ("élan vital", "Élan Vital"),
        ("don't", "Don'T"), ("ABC\tdEF", "Abc Def"), ("straße ßa", "Straße Ssa"),
    ]),
    "status flag": (reg.status_from_flag, [("Y", "Active"), ("n", "Inactive"), ("Yes", "Unknown"), (None, "Unknown")]),
    "status words": (reg.status_from_words, [
        ("Not Active", "Inactive"), ("Active", "Active"), ("Inactive", "Active"), ("Closed", "Unknown"), (None, "Unknown"),
    ]),
    "type": (reg.normalize_type, [
        ("Child Placing Agency", "Agency"), ("Residential Center", "Residential"), ("Family Center", "Center"),
        ("Family Home", "Home"), ("School-Age", "School"), ("X", "Other"), (None, "Other"), ("", "Other"),
    ]),
    "date": (reg.normalize_date, [
        ("2020-01-31T00:00", "2020-01-31"), ("1/2/2020", "2020-01-02"), ("2020-01-02", "2020-01-02"), ("junk", "junk"),
        ("", None), (None, None), ("1/2", "1/2"), ("//2020", "2020-00-00"), ("123/4/5", "5-123-04"), ("1//", "-01-00"),
    ]),
    "phone": (reg.normalize_phone, [
        ("(512) 555-0100", "5125550100"), ("1-512-555-0100", "5125550100"), ("555-0100", None), ("25125550100", None), (None, None), ("", None),
        ("1234567890", "1234567890"),
    ]),
    "email": (reg.normalize_email, [(" A@B.com ", "a@b.com"), ("a@b", None), (None, None), ("x.y@z", "x.y@z"), ("", None)]),
    "capacity": (reg.parse_capacity, [("12", 12), ("0", 0), ("12.0", None), ("-5", None), (None, None), ("99999999999", 99999999999)]),
    "clean url": (u.clean_url, [("http://a/b?x=1#f", "http://a/b#f"), (None, None), ("http://a/b#f?x", "http://a/b#f?x")]),
    "domain": (u.site_domain, [("https://www.a.com/x", "a.com"), ("https://m.a.com", "m.a.com"), ("a.com", ""), ("http://www.www.b.c:80?x", "www.b.c:80")]),
    "asset kind": (u.asset_kind, [("http://a/B.PDF", "pdf"), ("a.jpeg", "image"), ("a.webp", "image"), ("a.html", None), ("a.pdf?x", None)]),
    "asset name": (lambda x: F.substring_index(u.image_asset_name(x), ".", -1), [("a.png", "png"), ("a.webp", "webp"), ("a.gif", "jpg"), ("a.PNG", "jpg")]),
    "content type": (u.content_type, [("a/b.JPG", "image/jpeg"), ("a", "application/octet-stream"), ("x.y/z", "application/octet-stream"), ("a.pdf", "application/pdf")]),
    "normal link": (u.normalize_link, [("http://a/b//#t", "http://a/b"), ("http://a/#", "http://a"), ("#x", "")]),
    "short": (refine.is_short, [("Our Team", True), ("Hours:", False), ("ABOUT US", False), ("ABOUT", True), ("one two three four", False), ("123456", True)]),
    "noise": (refine.is_noise, [
        ("View our menu today please", True), ("Cart (3)", True), ("COPYRIGHT 2020 x", True), ("copyright x", False), ("Log In", True), ("a plain line", False),
    ]),
    "fence": (rp.strip_fence, [("```json\n{}\n```", "\n{}\n"), ("```{}```", "{}"), (" {} ", "{}"), ("```json", ""), ("```", "")]),
    "json object": (rp.is_json_object, [('{"a": 1}', True), ("{bad", False), ('{"a": 1, "a": 2}', True), ('{"a": NaN}', True), ("{'a': 1}", False), ("[1]", False), ("", False), (None, False), ('{"a":1} x', False), ('{"a":1},0] junk', False), ('{"a":1},0],[', False), ('{"a":1},"x"]', False), (' {"a": [1, {"b": "]"}]}\n', True)]),
    "epoch": (rp.epoch_to_iso, [("1700000000", "2023-11-14T22:13:20"), ("0", None), ("x", None), (None, None), ("", None)]),
    "tier": (lambda x: synth.tier_of(x.cast("int")), [("90", "Top Rated"), ("85", "Top Rated"), ("84", "Verified"), ("70", "Verified"), ("50", "Standard"), ("49", "Needs Review")]),
}
PAIR = {
    "names": (match.names_contain, [("ABC", "The abc School", True), (None, "x", False), ("", "x", False), ("ab", "xy", False)]),
    "streets": (match.street_numbers_agree, [
        ("12 A", "12 B", True), ("12", "13", False), ("A", "13", True), ("", "13", False), (None, "13", False), (" 12 A", "12", True),
    ]),
    "ratio": (lambda a, b: F.round(match.sequence_ratio(a, b), 4), [("abcd", "bcde", 0.75), ("a", "b", 0.0), (None, "b", None), ("sun school", "moon school", 0.7619)]),
    "pdf": (u.pdf_score, [
        ("http://x/Parent-Handbook.pdf", "p", 4), ("http://x/lunch-menu.pdf", "p", -2), ("http://x/calendar-update.pdf", "p", 1), (None, "a/policy.pdf", 2), ("", "rates/x.pdf", 0),
    ]),
    "resolve": (u.resolve_link, [
        ("http://a.b/c/d?e#f", "/x", "http://a.b/x"), ("http://a.b/c/d?e=/q#f", "x", "http://a.b/c/x"), ("http://a.b", "x", "http://a.b/x"),
        ("https://a.b/c", "//h/i", "https://h/i"), ("http://a.b/c?d", "#t", "http://a.b/c?d#t"), ("http://a.b/c?d", "?e", "http://a.b/c?e"),
        ("http://a.b/c", "mailto:x@y.z", "mailto:x@y.z"), ("http://a.b/c", "https://z/", "https://z/"),
    ]),
}


@pytest.mark.parametrize("rule", SINGLE)
def test_single(spark, rule):
    make, cases = SINGLE[rule]
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, x string")
    found = [r["out"] for r in rows.select("i", make(F.col("x")).alias("out")).orderBy("i").collect()]
    assert found == [c[1] for c in cases]


@pytest.mark.parametrize("rule", PAIR)
def test_pair(spark, rule):
    make, cases = PAIR[rule]
    rows = spark.createDataFrame([(i, c[0], c[1]) for i, c in enumerate(cases)], "i int, x string, y string")
    found = [r["out"] for r in rows.select("i", make(F.col("x"), F.col("y")).alias("out")).orderBy("i").collect()]
    assert found == [c[2] for c in cases]


def test_truncate(spark):
    cases = [
        ("", ""), (None, ""), ("short", "short"), ("a" * 1000, "a" * 1000),
        ("a" * 851 + "." + "b" * 500, "a" * 851 + "."),
        ("a" * 500 + " " + "b" * 349 + "." + "c" * 500, "a" * 500 + "..."),
        ("a" * 1200, "a" * 1000 + "..."), ("a" * 900 + "!" + "b" * 50 + "?" + "c" * 200, "a" * 900 + "!" + "b" * 50 + "?"),
    ]
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, x string")
    found = [r["out"] for r in rows.select("i", tx.truncate_sentence(F.col("x")).alias("out")).orderBy("i").collect()]
    assert found == [c[1] for c in cases]


def test_screen(spark):
    cases = [
        ("pdf", 5119, None, None, "small_pdf"), ("pdf", 5120, None, None, None), ("image", 10240, 200, 200, None),
        ("image", 10239, 200, 200, "small_image"), ("image", 20000, 199, 300, "small_sides"), ("image", 20000, 700, 200, "extreme_ratio"),
        ("image", 20000, 600, 200, None), ("image", 20000, None, 200, "unreadable"), ("text", 1, 1, 1, "unreadable"),
    ]
    rows = spark.createDataFrame([(i, *c[:4]) for i, c in enumerate(cases)], "i int, k string, s int, w int, h int")
    out = im.screen_reason(F.col("k"), F.col("s"), F.col("w"), F.col("h"))
    assert [r["out"] for r in rows.select("i", out.alias("out")).orderBy("i").collect()] == [c[4] for c in cases]


def test_location(spark):
    rows = spark.createDataFrame([(30.2, -97.7), (0.0, 5.0), (None, 1.0), (1.0, None)], "lat double, lng double")
    out = [r["out"] for r in rows.select(publish.location_ewkt(F.col("lat"), F.col("lng")).alias("out")).collect()]
    assert out == ["SRID=4326;POINT(-97.7 30.2)", None, None, None]


def test_zip_and_state_filter(spark):
    rows = spark.createDataFrame(
        [("Austin", "TX", "78750-1234"), ("austin ", "tx", "78750"), (None, "TX", "78750"), ("Austin", "OK", "78750"), ("Austin", "TX", None), ("Austin", "TX", "787")],
        "city string, state string, zip string",
    ).select(F.struct("city", "state", "zip").alias("a"))
    where = LocationFilter("Austin", "TX", "78750")
    found = [r["out"] for r in rows.select(where.reason(F.col("a")).alias("out")).collect()]
    assert found == [None, None, "filtered_city", "filtered_state", "filtered_zip", "filtered_zip"]
    assert LocationFilter(state="ALL").wants("WA") and not LocationFilter(state="TX").wants("WA")
