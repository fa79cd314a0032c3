"""Cross-tokenizer alignment against a plain recomputation, pair by pair."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from rosterforge.llm import cross_tokens

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    library = Tokenizer.from_file(A)
    library.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = cross_tokens.byte_letters()

    def spans(text: str) -> tuple[list, list] | None:
        if not text:
            return None
        sides = [
            [(i, bytes(letters[c] for c in library.id_to_token(i))) for i in library.encode(" " + text, add_special_tokens=False).ids],
            [
                (i, bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode())
                for i in pieces.encode(text)
            ],
        ]
        if any(b"".join(b for _, b in side) != b" " + text.encode() for side in sides):
            return None
        found = []
        for side in sides:
            at, made = 0, []
            for i, b in side:
                made.append((i, at, at + len(b)))
                at += len(b)
            found.append(made)
        return found[0], found[1]

    return spans


def brute(rows: list[tuple], spans) -> list[tuple]:
    """Every A token against every B token."""
    held, linked = Counter(), []
    for _, text in rows:
        both = spans(text or "")
        pairs = [(x[0], y[0]) for x in both[0] for y in both[1] if x[1] < y[2] and y[1] < x[2]] if both else []
        linked.append((both, pairs))
        held.update(set(pairs))
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    out = []
    for (doc_id, _), (both, pairs) in zip(rows, linked, strict=True):
        if both is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        cuts = sorted({x[2] for x in both[0]} & {y[2] for y in both[1]})
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(t[0]) for t in side if low < t[2] <= cut) for side in both))
            low = cut
        out.append((
            doc_id, len(both[0]), len(both[1]), len(groups), len(pairs), sum(held[p] == best[p[0]] for p in pairs),
            sum(held[p] for p in pairs), hashlib.sha256(";".join(groups).encode()).hexdigest(),
        ))
    return out


def odd_rows() -> list[tuple]:
    rng = random.Random(7)
    letters = "ab eé ß中文🙂\n\t  ▁ .,'1x\x00‍"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(120)]
    texts += [None, "", " ", "  two  blanks ", "<s>", "<|endoftext|> as text", "<0x41>", "a" * 3000, "The same text.", "The same text."]
    texts += ["The quick brown fox can't jump over 12345 lazy dogs.\n\n  Unhappiness", "é" * 700, "中" * 300, "\r\n" * 40]
    rows = [(i, t) for i, t in enumerate(texts)]
    return [*rows, (None, "No id here."), (rows[5][0], rows[5][1]), rows[5]]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("most_sent", [0, 40, 1 << 20])
def test_link_scores_equal_a_recomputation(spark, plain, most_sent):
    rows = odd_rows()
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, n_a string, `row.x` int")
    found = [tuple(r) for r in cross_tokens.link_scores(docs.repartition(5), A, B, most_sent).collect()]
    assert order(found) == order(brute(rows, plain))


def test_given_documents(spark, plain):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    rows = sorted(rows, key=lambda r: len(r[1] or ""))[:150]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [tuple(r) for r in cross_tokens.link_scores(docs, A, B, 500).collect()]
    assert order(found) == order(brute(rows, plain))


def test_alignment_spells_the_text(spark):
    docs = spark.createDataFrame([(1, "Wörter und words."), (2, None), (3, "▁ is a letter here")], "doc_id long, text string")
    two = cross_tokens.loaded(A, B)
    for row in cross_tokens.align(docs, A, B).collect():
        if row.doc_id != 1:
            assert (row.a_ids, row.b_ids, row.a_cuts, row.b_cuts) == ([], [], [], [])
            continue
        low_a = low_b = 0
        for x, y in zip(row.a_cuts, row.b_cuts, strict=True):
            spelled = b"".join(two.a_bytes[i] for i in row.a_ids[low_a:x])
            assert spelled == b"".join(two.b_bytes[i] for i in row.b_ids[low_b:y])
            low_a, low_b = x, y
        assert (low_a, low_b) == (len(row.a_ids), len(row.b_ids))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert cross_tokens.link_scores(docs, A, B).collect() == []
    assert cross_tokens.align(docs, A, B).collect() == []


def test_arrays_against_plain_loops():
    """Groups and overlaps of random token ends, and texts that are or are not spelled."""
    rng = np.random.default_rng(11)
    for _ in range(60):
        n = int(rng.integers(1, 200))
        a_end, b_end = (np.unique(np.append(rng.integers(1, n + 1, rng.integers(1, n + 1)), n)) for _ in range(2))
        holder, common = cross_tokens.meet(a_end, b_end)
        cuts = np.sort(cross_tokens.divide(holder, common, np.array([0]), np.array([len(a_end)])))
        assert a_end[cuts - 1].tolist() == sorted(set(a_end.tolist()) & set(b_end.tolist()))
    table = cross_tokens._table([b"", b" a", b"\x00", "é".encode()])
    got = cross_tokens.spells(table, np.array([1, 3, 2, 1]), np.array([0, 2, 2, 3, 4]), [" aé".encode(), None, b"\x00", b" b"])
    assert got.tolist() == [True, False, True, False]
