"""Repeated strings against a plain count of every string."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from rosterforge.llm import repeat_spans
from tests.conftest import SF


def covered(texts: list[bytes], least: int) -> list[np.ndarray]:
    """Bytes of each text under a string of this length that starts twice or more."""
    seen = Counter(t[i : i + least] for t in texts for i in range(len(t) - least + 1))
    out = []
    for t in texts:
        under = np.zeros(len(t), bool)
        for i in range(len(t) - least + 1):
            if seen[t[i : i + least]] > 1:
                under[i : i + least] = True
        out.append(under)
    return out


def brute(rows, least):
    texts = [(t or "").encode() for _, t in rows]
    out = []
    for (doc_id, _), text, under in zip(rows, texts, covered(texts, least), strict=True):
        kept = bytes(b for b, u in zip(text, under, strict=True) if not u)
        runs = int(np.count_nonzero(np.diff(np.concatenate([[0], under.astype(int)])) == 1))
        out.append((doc_id, len(text), int(under.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return order(out)


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def made_rows(seed):
    """Copies, near copies, shared passages, runs of one letter, periodic text, short and odd texts."""
    rng = random.Random(seed)

    def words(n):
        return " ".join(rng.choice(["alpha", "be", "gamma", "éé", "中文", "d", "epsilon", "zeta"]) for _ in range(n))

    passage, family = words(30), words(60)
    texts = [words(rng.randint(1, 80)) for _ in range(15)]
    texts += [words(rng.randint(0, 20)) + " " + passage + " " + words(rng.randint(0, 20)) for _ in range(25)]
    for _ in range(25):
        at = rng.randrange(len(family))
        texts.append(family[:at] + rng.choice("XYZ") + family[at + 1 :])
    texts += [passage, passage, passage[:40], family + family, "a" * 300, "ab" * 150, "a" * 90, None, "", "x", "中" * 60]
    rows = list(enumerate(texts))
    return [*rows, rows[3], (rows[4][0], rows[4][1]), (None, "no id " + passage), (None, None)]


SCHEMA = "doc_id long, text string, text_hash string, lo int, `a.b` int, kind int"


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA).repartition(parts)


@pytest.mark.parametrize(("least", "most_contexts"), [(40, 256), (40, 1), (64, 6), (33, 0)])
def test_removed_equals_the_count(spark, least, most_contexts):
    rows = made_rows(least + most_contexts)
    found = [tuple(r) for r in repeat_spans.removed(frame(spark, rows), least, most_contexts).collect()]
    assert order(found) == brute(rows, least)


@pytest.mark.parametrize("most_contexts", [256, 1])
def test_groups_are_equal_strings_with_all_their_places(spark, most_contexts):
    least = 40
    rows = made_rows(2)
    texts = {d: (t or "").encode() for d, t in rows if d is not None}
    rows = [(d, t) for d, t in {d: t for d, t in rows if d is not None}.items()]
    places = defaultdict(set)
    for r in repeat_spans.groups(frame(spark, rows), least, most_contexts).collect():
        places[(r.grp, r.n_bytes)].add((r.doc_id, r.start))
    under = {d: np.zeros(len(t), bool) for d, t in texts.items()}
    for (_, length), own in places.items():
        strings = {texts[d][a : a + length] for d, a in own}
        assert len(strings) == 1 and length >= least
        string = strings.pop()
        every = {(d, i) for d, t in texts.items() for i in range(len(t) - length + 1) if t[i : i + length] == string}
        assert own == every
        for d, a in own:
            under[d][a : a + length] = True
    expected = dict(zip([d for d, _ in rows], covered([(t or "").encode() for _, t in rows], least), strict=True))
    assert all((under[d] == expected[d]).all() for d in under)


def test_anchors_across_pieces(monkeypatch):
    rng = np.random.default_rng(4)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    offsets = np.array([0, 10, 900, 900, 2500, 2530, 5000])
    whole = repeat_spans.anchors(data, offsets, 60)
    monkeypatch.setattr(repeat_spans, "STEP", 333)
    for x, y in zip(whole, repeat_spans.anchors(data, offsets, 60), strict=True):
        assert (x == y).all()


def test_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    found = [tuple(r) for r in repeat_spans.removed(frame(spark, rows)).collect()]
    assert order(found) == brute(rows, 400)


def test_empty_table(spark):
    assert repeat_spans.removed(frame(spark, [], 1)).collect() == []
    assert repeat_spans.groups(frame(spark, [], 1)).collect() == []
