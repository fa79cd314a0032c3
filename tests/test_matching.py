"""The matching-block kernel and the bounds in front of it."""

import difflib
import random

import pytest
from pyspark.sql import functions as F

from rosterforge import fixed
from rosterforge.functions import matching as match
from rosterforge.operators.places import with_names_agree


def texts(seed, count, longest):
    """Pairs over small alphabets, half of them variants of one another."""
    made = random.Random(seed)
    for n in range(count):
        letters = made.choice(["ab", "abcd", "abcdefghij klmnop ", "aé😀ñ b"])
        one = "".join(made.choice(letters) for _ in range(made.randrange(longest)))
        if n % 2:
            cut = made.randrange(len(one) + 1)
            yield one, one[cut:] + made.choice(letters) + one[:cut]
        else:
            yield one, "".join(made.choice(letters) for _ in range(made.randrange(longest)))


def brute(one, other):
    return sum(block.size for block in difflib.SequenceMatcher(None, one, other).get_matching_blocks())


@pytest.mark.parametrize("seed, count, longest", [(1, 1500, 40), (2, 60, 260), (3, 12, 900)])
def test_blocks(seed, count, longest):
    pairs = list(texts(seed, count, longest)) + [("", ""), ("", "a"), ("a", ""), ("x", "x"), ("a" * 300, "a" * 300)]
    got = match.matched_characters([a for a, _ in pairs], [b for _, b in pairs])
    assert list(got) == [brute(a, b) for a, b in pairs]


def test_no_pairs():
    assert list(match.matched_characters([], [])) == []
    assert list(match.matched_characters(["", ""], ["", "b"])) == [0, 0]


def test_small_steps(monkeypatch):
    """Splitting the open intervals changes nothing."""
    pairs = list(texts(4, 200, 30))
    monkeypatch.setattr(match, "STEP_CELLS", 7)
    got = match.matched_characters([a for a, _ in pairs], [b for _, b in pairs])
    assert list(got) == [brute(a, b) for a, b in pairs]


def test_bounds_agree_with_ratio(spark):
    """Whatever the bounds decide is what the ratio decides; nulls and blanks are no match."""
    pairs = list(texts(5, 600, 40)) + list(texts(6, 20, 300))
    pairs += [(None, "a"), ("a", None), (None, None), ("", "a"), ("", ""), ("Sun School", "moon SCHOOL"), (" ", "  ")]
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    decided = rows.select("*", match.names_decided(F.col("a"), F.col("b")).alias("decided"))
    judged = {r["i"]: r for r in with_names_agree(decided, F.col("a"), F.col("b"), "agree").collect()}
    bounded = 0
    for i, (a, b) in enumerate(pairs):
        if not a or not b:
            want = False
        else:
            one, other = a.lower(), b.lower()
            ratio = 2.0 * brute(one, other) / (len(one) + len(other))
            want = one in other or other in one or ratio >= fixed.NAME_RATIO_THRESHOLD
        assert judged[i]["agree"] is want, (a, b)
        assert judged[i]["decided"] in (None, want), (a, b)
        bounded += judged[i]["decided"] is not None
    assert len(pairs) / 4 < bounded < len(pairs) - 100  # both ways are reached
