"""Token groups of two tokenizers over the same text, and how often their ids meet in the corpus.

Every text is encoded twice: by a byte-level BPE (side A) and by a piece model
with byte fallback (side B).  Both sides spell the same bytes, a space and the
text.  Byte offsets where a token of each side ends cut the text into groups.

Method: divide and conquer at shared cuts.  An interval of tokens looks for a
common end near its middle: ends of A tokens, from the middle outwards, that
bisection has found among the ends of B; the first such one splits the interval
and both halves go on; an interval without an inner common end is a leaf, one
group.  All intervals of all documents of a slice are halved together,
round by round, so a round is a handful of array operations.

Links are the pairs of an A and a B token whose bytes overlap.  How many
documents of the corpus hold an id pair linked is counted by partial counts in
the tasks and one aggregate over pairs.  The most frequent pairs (at most
`most_sent`, whatever the corpus) are sent to the tasks; links of all other
pairs are rare by that choice and meet their counts in a join, so the result is
whole and no document's links move but the rare ones.

Defined cases: a null or empty text, and one whose tokens on either side do not
spell a space and the text, has no tokens (zeros, the groups' digest is '').
Strings of special tokens inside a text are plain text.  Repeated rows are
documents of their own; a null doc_id stays null; other columns are not read; an
empty table gives an empty result.  A text is held whole in its task.
"""

from __future__ import annotations

import hashlib
import json
import math
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.llm.arrow_text import column_bytes, slices
from rosterforge.session import durable_path, ship_package

SLICE_BYTES = 2 << 20
MOST_SENT = 1 << 20
_LOADED: dict[tuple[str, str], TwoTokenizers] = {}


def byte_letters() -> dict[str, int]:
    """The letter by which a byte-level vocabulary writes each byte: itself where it prints, else from U+0100 on."""
    printing = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printing)]
    return {chr(b): b for b in printing} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class TwoTokenizers:
    """Both tokenizers, and for every id its bytes and its decimal digits."""

    def __init__(self, bpe_json: str, piece_model: str) -> None:
        import sentencepiece
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        with open(bpe_json, encoding="utf-8") as file:
            described = json.load(file)
        letters = byte_letters()
        vocabulary = described["model"]["vocab"] | {t["content"]: t["id"] for t in described["added_tokens"]}
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.a_bytes[number] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.library = Tokenizer.from_file(bpe_json)
        self.library.encode_special_tokens = True
        self.fast = None
        merges = [m.split(" ") if isinstance(m, str) else m for m in described["model"]["merges"]]
        plain = described["model"]["vocab"]
        if all(plain["".join(m)] == 256 + i for i, m in enumerate(merges)):
            # ids follow the order of merges: a byte-pair library that merges by rank gives the same ids, four times as fast
            ranks = {self.a_bytes[number]: number for number in plain.values()}
            self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        self.b_bytes = []
        for number in range(self.pieces.get_piece_size()):
            piece = self.pieces.id_to_piece(number)
            if self.pieces.is_byte(number):
                self.b_bytes.append(bytes([int(piece[3:5], 16)]))
            else:
                self.b_bytes.append(piece.replace("▁", " ").encode())
        self.a_table, self.b_table = _table(self.a_bytes), _table(self.b_bytes)
        self.a_size, self.b_size = np.diff(self.a_table[1]), np.diff(self.b_table[1])
        # digits and what follows them: A within a group, A at its end, B within, B at its end
        width = max(len(self.a_bytes), len(self.b_bytes))
        self.width = width
        spelled = [b"%d%s" % (i, mark) for mark in (b",", b"|", b",", b";") for i in range(width)]
        self.spelled = np.array(spelled, f"S{-(-max(map(len, spelled)) // 8) * 8}")
        self.spelled_size = np.char.str_len(self.spelled)

    def encode_a(self, text: str) -> np.ndarray:
        if self.fast is not None:
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=())
            except (KeyboardInterrupt, SystemExit, MemoryError):
                raise
            except BaseException:  # its pattern engine gives up on some very long runs; the library then answers
                pass
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: list[str]) -> Encoded:
        """Ids of both sides for each text; none where either side does not spell a space and the text."""
        nothing = np.zeros(0, np.uint32)
        a, a_at = _flat([self.encode_a(" " + text) if text else nothing for text in texts])
        b, b_at = _flat([np.frombuffer(array("I", x), np.uint32) for x in self.pieces.encode(texts, num_threads=1)] if texts else [])
        wanted = [b" " + text.encode() if text else None for text in texts]
        good = spells(self.a_table, a, a_at, wanted) & spells(self.b_table, b, b_at, wanted)
        return Encoded(self, *_only(good, a, a_at), *_only(good, b, b_at))


class Encoded:
    """Tokens of a slice of texts as flat arrays, cut into groups."""

    def __init__(self, two: TwoTokenizers, a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray) -> None:
        self.two = two
        self.a, self.a_at, self.b, self.b_at = a, a_at, b, b_at
        # byte ends count on over the documents of the slice, so that they rise throughout
        self.a_end = np.cumsum(two.a_size[self.a])
        self.b_end = np.cumsum(two.b_size[self.b])
        #: for each A token the B token that holds its last byte, and whether both end there
        self.holder, self.common = meet(self.a_end, self.b_end)
        full = np.flatnonzero(np.diff(self.a_at))
        last = np.zeros(len(self.a), bool)
        last[divide(self.holder, self.common, self.a_at[full], self.a_at[full + 1]) - 1] = True
        ends = np.flatnonzero(last)
        #: token counts up to the end of every group, on both sides, and the groups of each document
        self.cut_a, self.cut_b = ends + 1, self.holder[ends] + 1
        self.group_at = np.searchsorted(self.cut_a, self.a_at, side="right")
        self.group_at[0] = 0

    def __len__(self) -> int:
        return len(self.a_at) - 1

    def link_pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Document and id pair (A id x number of B ids + B id) of every link.

        Between two neighbouring ends of either side lies exactly one A and one
        B token, and every overlapping pair shares exactly one such stretch: it
        ends with an A token, inside or at the end of that token's holder, or
        with a B token alone, inside the A token that follows all A ends before.
        """
        alone = np.ones(len(self.b), bool)
        alone[self.holder[self.common]] = False
        alone = np.flatnonzero(alone)
        follows = np.cumsum(np.bincount(self.holder + self.common, minlength=len(self.b) + 1))[alone]
        doc_a = np.repeat(np.arange(len(self)), np.diff(self.a_at))
        first = np.concatenate([self.a, self.a[follows]])
        return np.concatenate([doc_a, doc_a[follows]]), first * len(self.two.b_bytes) + np.concatenate([self.b[self.holder], self.b[alone]])

    def written_groups(self) -> list[bytes]:
        """Per document `a1,a2|b1;a3|b2,b3`: ids of A and B, group by group."""
        n = len(self.cut_a)
        if n == 0:
            return [b""] * len(self)
        width = self.two.width
        group_a = np.repeat(np.arange(n), np.diff(self.cut_a, prepend=0))
        group_b = np.repeat(np.arange(n), np.diff(self.cut_b, prepend=0))
        code_a, code_b = self.a.copy(), self.b + 2 * width
        code_a[self.cut_a - 1] += width
        code_b[self.cut_b - 1] += width
        codes = np.empty(len(code_a) + len(code_b), np.int64)
        codes[np.arange(len(code_a)) + np.concatenate([[0], self.cut_b])[group_a]] = code_a
        codes[np.arange(len(code_b)) + self.cut_a[group_b]] = code_b
        # spellings end with zero bytes, which are left out
        letters = self.two.spelled[codes].view(np.uint8)
        letters = letters[letters != 0]
        at = np.concatenate([[0], np.cumsum(self.two.spelled_size[codes])])[self.a_at + self.b_at].tolist()
        return [letters[x : max(y - 1, x)].tobytes() for x, y in zip(at[:-1], at[1:], strict=True)]


def _flat(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    at = np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)]).astype(np.int64)
    return np.concatenate([np.zeros(0, np.uint32), *lists]).astype(np.int64), at


def _only(good: np.ndarray, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of good texts; all others have none."""
    if good.all():
        return ids, at
    n = np.diff(at)
    return ids[np.repeat(good, n)], np.concatenate([[0], np.cumsum(n * good)])


def _table(token_bytes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all tokens and where each begins."""
    return np.frombuffer(b"".join(token_bytes), np.uint8), np.concatenate([[0], np.cumsum([len(b) for b in token_bytes])])


def spells(table: tuple[np.ndarray, np.ndarray], ids: np.ndarray, at: np.ndarray, wanted: list[bytes | None]) -> np.ndarray:
    """Do the tokens of each text spell the wanted bytes?  Never where these are None."""
    letters, begin = table
    sizes = np.diff(begin)[ids]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    # each byte's place in the table: its token's begin there and its own place in the token
    spelled = letters[np.repeat(begin[ids] - ends[:-1], sizes) + np.arange(ends[-1])].tobytes()
    ends = ends[at].tolist()
    return np.array([w is not None and spelled[x:y] == w for x, y, w in zip(ends[:-1], ends[1:], wanted, strict=True)], bool)


def meet(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every A end looked up among the ends of B by bisection: the first that is not before it, and whether it is the same."""
    holder = np.searchsorted(b_end, a_end)
    return holder, b_end[holder] == a_end


def divide(holder: np.ndarray, common: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A token counts up to the end of every group of the given intervals, in no order.

    An interval holds A tokens low..high-1, whose last one ends together with a B
    token.  `tried` tells how many inner ends next to the middle are no common ends.
    """
    leaves = [np.zeros(0, np.int64)]
    tried = np.zeros(len(low), np.int64)
    while len(low):
        inner = high - low - 1
        # all A ends within one B token: none but the last can end with it
        leaf = (inner <= 0) | (holder[low] == holder[high - 1]) | (tried > 2 * inner)
        leaves.append(high[leaf])
        go = np.flatnonzero(~leaf)
        low, high, tried = low[go], high[go], tried[go]
        # middle, one after, one before, two after, ...
        at = (low + high - 2) // 2 + np.where(tried % 2 == 1, (tried + 1) // 2, -(tried // 2))
        found = (at >= low) & (at <= high - 2)
        found &= common[np.minimum(np.maximum(at, low), high - 2)]
        cut, left = at[found] + 1, ~found
        low, high, tried = (
            np.concatenate([low[left], low[found], cut]),
            np.concatenate([high[left], cut, high[found]]),
            np.concatenate([tried[left] + 1, np.zeros(2 * len(cut), np.int64)]),
        )
    return np.concatenate(leaves)


def loaded(bpe_json: str, piece_model: str) -> TwoTokenizers:
    """Both tokenizers; a worker loads them once and keeps them between tasks."""
    key = (bpe_json, piece_model)
    if key not in _LOADED:
        _LOADED[key] = TwoTokenizers(*key)
    return _LOADED[key]


def _texts(column: pa.Array) -> Iterator[tuple[int, int, list[str]]]:
    """Runs of rows with their texts, about SLICE_BYTES each; null is empty."""
    _, offsets = column_bytes(column)
    for low, high in slices(offsets, SLICE_BYTES):
        yield low, high, [t or "" for t in column.slice(low, high - low).to_pylist()]


def align(docs: DataFrame, bpe_json: str, piece_model: str) -> DataFrame:
    """Both sides' ids and the groups of every document.

    `a_cuts` and `b_cuts` hold, per group, how many tokens of that side lie up
    to the group's end.
    """
    ship_package(docs.sparkSession)

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two = loaded(bpe_json, piece_model)
        for batch in batches:
            for low, high, texts in _texts(batch.column(1)):
                found = two.encode(texts)
                groups = np.diff(found.group_at)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        _lists(found.a, found.a_at),
                        _lists(found.b, found.b_at),
                        _lists(found.cut_a - np.repeat(found.a_at[:-1], groups), found.group_at),
                        _lists(found.cut_b - np.repeat(found.b_at[:-1], groups), found.group_at),
                    ],
                    ["doc_id", "a_ids", "b_ids", "a_cuts", "b_cuts"],
                )

    ints = "array<int>"
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(aligned, f"doc_id long, a_ids {ints}, b_ids {ints}, a_cuts {ints}, b_cuts {ints}")


def _lists(values: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, pa.int32()))


ALIGNED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs binary, times binary"
)


def link_scores(docs: DataFrame, bpe_json: str, piece_model: str, most_sent: int = MOST_SENT) -> DataFrame:
    """Per document its numbers of tokens, groups and links, and how its links stand in the whole corpus.

    `n_best`: links whose pair is held by as many documents as any pair of that
    A id; `count_sum`: the number of documents of its pair, summed over links;
    `groups_sha256`: digest of the groups as `a1,a2|b1;a3|b2,b3`.
    """
    spark = docs.sparkSession
    ship_package(spark)

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two = loaded(bpe_json, piece_model)
        for batch in batches:
            for low, high, texts in _texts(batch.column(2)):
                found = two.encode(texts)
                doc, pair = found.link_pairs()
                # distinct pairs of each document, and how often each is linked there
                keys, times = np.unique((doc << 32) | pair, return_counts=True)
                at = np.searchsorted(keys, np.arange(len(found) + 1) << 32).tolist()
                pairs, times = (keys & 0xFFFFFFFF).astype("<i4"), times.astype("<i4")
                digests = [hashlib.sha256(g).hexdigest() if g else "" for g in found.written_groups()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        batch.column(1).slice(low, high - low),
                        pa.array(np.diff(found.a_at)),
                        pa.array(np.diff(found.b_at)),
                        pa.array(np.diff(found.group_at)),
                        pa.array(np.bincount(doc, minlength=len(found)).astype(np.int64)),
                        pa.array(digests, pa.string()),
                        pa.array([pairs[x:y].tobytes() for x, y in zip(at[:-1], at[1:], strict=True)], pa.binary()),
                        pa.array([times[x:y].tobytes() for x, y in zip(at[:-1], at[1:], strict=True)], pa.binary()),
                    ],
                    ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
                )

    # the row's number is written with its links, so it stays what it is however the table is read again
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text")
    path = durable_path(spark, "cross-links")
    rows.mapInArrow(aligned, ALIGNED).write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(ALIGNED).parquet(path)

    counts = pair_counts(stored, len_b=loaded(bpe_json, piece_model).pieces.get_piece_size())
    frequent = spark.sparkContext.broadcast(_frequent(counts, most_sent))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held, best = frequent.value
        for batch in batches:
            blobs, offsets = column_bytes(batch.column(7))
            pairs, at = np.frombuffer(blobs.tobytes(), "<i4"), offsets // 4
            times = np.frombuffer(column_bytes(batch.column(8))[0].tobytes(), "<i4").astype(np.int64)
            row = np.repeat(np.arange(len(batch)), np.diff(at))
            place = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
            hit = known[place] == pairs if len(known) else np.zeros(len(pairs), bool)
            sums, bests = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            np.add.at(sums, row[hit], held[place[hit]] * times[hit])
            np.add.at(bests, row[hit], best[place[hit]] * times[hit])
            rest = np.concatenate([[0], np.cumsum(np.bincount(row[~hit], minlength=len(batch)))])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:7], pa.array(bests), pa.array(sums), _lists(pairs[~hit], rest), _lists(times[~hit], rest)],
                [*batch.schema.names[:7], "n_best", "count_sum", "pair", "times"],
            )

    head = ALIGNED.split(", pairs")[0]
    path = durable_path(spark, "cross-scores")
    schema = f"{head}, n_best long, count_sum long, pair array<int>, times array<int>"
    stored.mapInArrow(scored, schema).write.parquet(path)
    scores = spark.read.schema(schema).parquet(path)
    rare = scores.where("size(pair) > 0").selectExpr("row", "inline(arrays_zip(pair, times))")
    rare = rare.join(counts, "pair").groupBy("row").agg(
        F.sum(F.col("held") * F.col("times")).alias("_sum"), F.sum(F.col("best") * F.col("times")).alias("_best")
    )
    return scores.join(rare, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )


def pair_counts(stored: DataFrame, len_b: int, most_held: int = 4_000_000) -> DataFrame:
    """`pair, held, best`: documents that hold each linked pair, and 1 where no pair of its A id is held by more.

    Tasks count what they read and pass on a pair once per `most_held` distinct
    pairs, so the shuffle follows the pairs of the two vocabularies, not the links.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, held, waiting, n_waiting = np.zeros(0, np.int32), np.zeros(0, np.int64), [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            fresh, times = np.unique(np.concatenate(waiting), return_counts=True)
            both, place = np.unique(np.concatenate([pairs, fresh]), return_inverse=True)
            total = np.zeros(len(both), np.int64)
            np.add.at(total, place, np.concatenate([held, times]))
            return both, total

        def sent() -> Iterator[pa.RecordBatch]:
            for at in range(0, len(pairs), 100_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs[at : at + 100_000]), pa.array(held[at : at + 100_000])], ["pair", "held"]
                )

        for batch in batches:
            waiting.append(np.frombuffer(column_bytes(batch.column(0))[0].tobytes(), "<i4"))
            n_waiting += len(waiting[-1])
            if n_waiting >= most_held:
                pairs, held = merged()
                waiting, n_waiting = [], 0
                if len(pairs) >= most_held:
                    yield from sent()
                    pairs, held = pairs[:0], held[:0]
        if waiting:
            pairs, held = merged()
        yield from sent()

    path = durable_path(stored.sparkSession, "cross-pairs")
    partial = stored.select("pairs").mapInArrow(counted, "pair int, held long")
    partial.groupBy("pair").agg(F.sum("held").alias("held")).write.parquet(path)
    counts = stored.sparkSession.read.schema("pair int, held long").parquet(path)
    by_a = counts.withColumn("_a", F.expr(f"pair DIV {len_b}"))
    # one row per A id, so never more than the vocabulary has
    most = by_a.groupBy("_a").agg(F.max("held").alias("_most"))
    return by_a.join(most, "_a").select("pair", "held", (F.col("held") == F.col("_most")).cast("int").alias("best"))


def _frequent(counts: DataFrame, most_sent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs held by most documents, sorted: as many whole steps of the count as hold at most `most_sent` pairs."""
    step = F.floor(F.log2("held") * 8).cast("int")
    # at most 8 steps per doubling of a 64-bit count
    sizes = dict(counts.groupBy(step.alias("step")).count().collect())
    total, least = 0, math.inf
    for at in sorted(sizes, reverse=True):
        total += sizes[at]
        if total > most_sent:
            break
        least = at
    if least is math.inf:
        return np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    found = counts.where(step >= int(least)).toArrow()
    pairs = found.column("pair").to_numpy()
    order = np.argsort(pairs)
    return pairs[order], found.column("held").to_numpy()[order], found.column("best").to_numpy()[order].astype(np.int8)
