"""Do a register record and a place describe the same provider?"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterforge import fixed
from rosterforge.functions.text import is_blank, strip

# cells of one comparison step: bounds the kernel's working arrays to a few MB
STEP_CELLS = 1 << 20
# from this length of the second text on, its frequent characters start no block
LONG_TEXT = 200


class _Texts:
    """Texts of a batch as one array of code points."""

    def __init__(self, texts: list[str]):
        self.sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.int32)

    def at(self, rows: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Characters at places that may lie outside; read only where they count."""
        return self.codes[np.clip(self.begins[rows] + places, 0, len(self.codes) - 1)]


def _starters(right: _Texts) -> np.ndarray:
    """Which characters of the second texts may start a block.

    In a text of 200 or more characters, one that makes up more than a
    hundredth of it (and one more) may only extend a block.
    """
    able = np.ones(len(right.codes), bool)
    for row in np.flatnonzero(right.sizes >= LONG_TEXT):
        size, begin = right.sizes[row], right.begins[row]
        _, kind, count = np.unique(right.codes[begin:begin + size], return_inverse=True, return_counts=True)
        able[begin:begin + size] = count[kind] <= size // 100 + 1
    return able


def _longest_blocks(left, right, able, rows, a0, a1, b0, b1):
    """Longest common block of every open interval: its starts and size.

    Of equal sizes the one that starts first on the left wins, then on the
    right.  One step compares one left character of all intervals with their
    whole right parts; a run's length grows along its diagonal.
    """
    width = int((b1 - b0).max())
    columns = np.arange(width)
    inside = columns < (b1 - b0)[:, None]
    spots = np.where(inside, (right.begins[rows] + b0)[:, None] + columns, 0)
    letters = np.where(inside & able[spots], right.codes[spots], -1)
    runs = np.zeros((len(rows), width + 1), np.int32)
    size, at_a, at_b = np.zeros(len(rows), np.int64), a0.copy(), b0.copy()
    every = np.arange(len(rows))
    for step in range(int((a1 - a0).max())):
        letter = np.where(a0 + step < a1, left.at(rows, a0 + step), -2)
        runs[:, 1:] = np.where(letters == letter[:, None], runs[:, :-1] + 1, 0)
        end = runs[:, 1:].argmax(axis=1)
        found = runs[every, end + 1]
        better = found > size
        size[better] = found[better]
        at_a[better] = (a0 + step + 1 - found)[better]
        at_b[better] = (b0 + end + 1 - found)[better]
    long = np.flatnonzero(right.sizes[rows] >= LONG_TEXT)
    if len(long):
        args = (v[long] for v in (rows, a0, a1, b0, b1, size, at_a, at_b))
        size[long], at_a[long], at_b[long] = _extended(left, right, *args)
    return at_a, at_b, size


def _extended(left, right, rows, a0, a1, b0, b1, size, at_a, at_b):
    """Blocks grown to both sides over equal characters of any frequency."""
    while True:
        grow = (at_a > a0) & (at_b > b0) & (left.at(rows, at_a - 1) == right.at(rows, at_b - 1))
        if not grow.any():
            break
        at_a, at_b, size = at_a - grow, at_b - grow, size + grow
    while True:
        grow = (at_a + size < a1) & (at_b + size < b1) & (left.at(rows, at_a + size) == right.at(rows, at_b + size))
        if not grow.any():
            return size, at_a, at_b
        size = size + grow


def matched_characters(lefts: list[str], rights: list[str]) -> np.ndarray:
    """Characters in matching blocks of every pair.

    The longest block splits a pair into the parts before and behind it, which
    are intervals of the next round; all open intervals of the batch advance
    together, narrow ones with narrow ones.
    """
    left, right = _Texts(lefts), _Texts(rights)
    total = np.zeros(len(lefts), np.int64)
    rows = np.flatnonzero((left.sizes > 0) & (right.sizes > 0))
    if not len(rows):
        return total
    able = _starters(right)
    zero = np.zeros(len(rows), np.int64)
    work = np.stack([rows, zero, left.sizes[rows], zero, right.sizes[rows]])
    while work.shape[1]:
        # by doubling left length, then by width: few intervals take many steps
        steps = np.ceil(np.log2(work[2] - work[1] + 1))
        order = np.lexsort((work[4] - work[3], steps))
        work, steps = work[:, order], steps[order]
        parts, begin = [], 0
        while begin < work.shape[1]:
            # as many intervals of one step class as the widest of them allows
            last = int(np.searchsorted(steps, steps[begin], side="right"))
            widths = work[4, begin:last] - work[3, begin:last]
            cells = widths * np.arange(1, len(widths) + 1)
            count = max(1, int(np.searchsorted(cells, STEP_CELLS)))
            rows, a0, a1, b0, b1 = work[:, begin:begin + count]
            begin += count
            at_a, at_b, size = _longest_blocks(left, right, able, rows, a0, a1, b0, b1)
            np.add.at(total, rows, size)
            for part in (np.stack([rows, a0, at_a, b0, at_b]), np.stack([rows, at_a + size, a1, at_b + size, b1])):
                parts.append(part[:, (size > 0) & (part[1] < part[2]) & (part[3] < part[4])])
        work = np.concatenate(parts, axis=1)
    return total


@F.pandas_udf(T.DoubleType())
def sequence_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """Share of both texts that lies in matching blocks (Ratcliff and Obershelp).

    Null where a side is null, 1 for two empty texts.  A batch's distinct pairs
    are compared together.
    """
    out = np.full(len(left), np.nan)
    open_rows = np.flatnonzero(left.notna() & right.notna())
    if len(open_rows):
        kind, pairs = pd.factorize(pd.MultiIndex.from_arrays([left.iloc[open_rows], right.iloc[open_rows]]))
        lefts, rights = ([pair[side] for pair in pairs] for side in (0, 1))
        sizes = np.array([len(a) + len(b) for a, b in zip(lefts, rights)])
        ratio = np.where(sizes > 0, 2.0 * matched_characters(lefts, rights) / np.maximum(sizes, 1), 1.0)
        out[open_rows] = ratio[kind]
    return pd.Series(out).astype(object).where(~np.isnan(out), None)


def shared_letters(left: Column, right: Column) -> Column:
    """Size of the multiset of characters that both texts hold: no matching is larger."""
    def held(text: Column, letter: Column) -> Column:
        return F.char_length(text) - F.char_length(F.replace(text, letter, F.lit("")))

    letters = F.array_distinct(F.split(left, F.lit("")))
    return F.aggregate(
        letters, F.lit(0), lambda total, letter: total + F.least(held(left, letter), held(right, letter))
    )


def longest_shared_word(left: Column, right: Column) -> Column:
    """Length of the longest word of one text inside the other: no matching is smaller."""
    words = F.filter(F.split(left, " "), lambda word: right.contains(word))
    return F.coalesce(F.array_max(F.transform(words, F.char_length)), F.lit(0))


def names_decided(left: Column, right: Column) -> Column:
    """Name test where it needs no matching blocks, else null.

    Empty names and containment decide first.  Then bounds of the ratio: the
    shorter name and the letters in common from above, the longest shared word
    from below (only for texts without frequent characters, see `LONG_TEXT`).
    """
    a, b = F.lower(left), F.lower(right)
    both = F.char_length(a) + F.char_length(b)

    def reaches(matched: Column) -> Column:
        return F.lit(2.0) * matched / both >= fixed.NAME_RATIO_THRESHOLD

    return (
        F.when(~both_filled(left, right), False)
        .when(a.contains(b) | b.contains(a), True)
        .when(~reaches(F.least(F.char_length(a), F.char_length(b))), False)
        .when((F.char_length(b) < LONG_TEXT) & reaches(longest_shared_word(a, b)), True)
        .when(~reaches(shared_letters(a, b)), False)
    )


def both_filled(left: Column, right: Column) -> Column:
    return ~is_blank(left) & ~is_blank(right)


def names_contain(left: Column, right: Column) -> Column:
    """One name holds the other, ignoring case; false if either is empty."""
    a, b = F.lower(left), F.lower(right)
    return F.coalesce(both_filled(left, right) & (a.contains(b) | b.contains(a)), F.lit(False))


def ratio_agrees(ratio: Column) -> Column:
    return F.coalesce(ratio >= fixed.NAME_RATIO_THRESHOLD, F.lit(False))


def street_numbers_agree(left: Column, right: Column) -> Column:
    """Leading digits equal; not disproved where one side has none."""
    a = F.regexp_extract(strip(left), r"^(\p{Nd}+)", 1)
    b = F.regexp_extract(strip(right), r"^(\p{Nd}+)", 1)
    return (
        F.when(~both_filled(left, right), False)
        .when((a != "") & (b != ""), a == b)
        .otherwise(True)
    )
