"""Masked pseudo-likelihood scores of documents by a bidirectional window network.

Tokens are words (A-Z lower-cased).  The vocabulary is counted over the whole
corpus and grows with it: every word counted at least sqrt(tokens) / 8 times has
an id of its own (and the 960 most frequent ones in any case), all others share
hashed ids, whose number and that of the classes grow along.  For every token
the network sees the two tokens on either side, never the token itself,

    h = tanh(sum over the four sides of E_side[neighbour] + b)

and gives the token's probability in two steps, its class and its place in the
class, each a softmax.  A word in a shared id has its share of that id: n / (N + 1)
for n counts of the word among N of the id, and 1 / (N + 1) for all words that
were never counted, so that every context's probabilities add up to 1.  The sum
of these conditional log-probabilities over all tokens is the document's
pseudo-log-likelihood.

The counts of words in shared ids are not held by any task: scoring writes these
tokens in pieces by a hash of the word, the pieces meet the counted words of the
same hash in a shuffle, and their sums go back to the documents.

Training is numpy inside tasks and covers every document: in each round every
task takes one pass of minibatch steps over its part of the corpus from the
shared parameters, and the parameters are averaged, weighted by tokens, in a
shuffle that adds them up piece by piece.  A round takes the documents whose
hash falls to it, so all rounds together read each document once.

Defined cases: a null text and a text without words have no tokens and a sum
and mean of 0; sides beyond a document's ends are a token of their own;
repeated rows are scored each and count each; an empty table gives no rows;
other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.llm.arrow_text import column_bytes, mix, slices, word_bounds, word_hashes
from rosterforge.session import durable, ship_package

OWN_WORDS = 960
SHARED = 63
EDGE = OWN_WORDS + SHARED  # beyond a document's ends
VOCABULARY = OWN_WORDS + SHARED + 1
CLASSES = 32  # these five are the sizes for a small corpus
OWN_PART = 8
PIECES, PIECE_WORDS = 256, 1 << 14
SIZE = 16
SIDES = (-2, -1, 1, 2)
ROUNDS = 2
GROUPS = 64


@dataclass
class Vocabulary:
    """Sorted hashes of the words with ids of their own, their ids, and each id's class and place in it."""

    hashes: np.ndarray
    ids: np.ndarray
    class_of: np.ndarray
    place: np.ndarray
    log_share: np.ndarray
    own: int = OWN_WORDS
    shared: int = SHARED
    totals: np.ndarray | None = None  # counts of each shared id
    pieces: int = PIECES

    @property
    def edge(self) -> int:
        return self.own + self.shared

    @property
    def classes(self) -> int:
        return int(self.class_of.max()) + 1

    def encode(self, hashes: np.ndarray) -> np.ndarray:
        shared = self.own + (hashes % np.uint64(self.shared)).astype(np.int64)
        if not len(self.hashes):
            return shared
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.ids[at], shared)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash and count of the words of each slice of texts."""
    for batch in batches:
        data, offsets = column_bytes(batch.column(0))
        for low, high in slices(offsets, 8 << 20):
            part, own = data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
            begin, end, _ = word_bounds(part, own)
            found, n = np.unique(word_hashes(part, begin, end), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], ["hash", "n"])


def count_words(docs: DataFrame) -> DataFrame:
    """`hash, n` of every word of the corpus."""
    ship_package(docs.sparkSession)
    return docs.select("text").mapInArrow(_words, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


def sizes(own: int) -> tuple[int, int]:
    """Classes, and shared ids beside `own` words: as many places in a class as classes."""
    classes = max(CLASSES, math.isqrt(own * VOCABULARY // OWN_WORDS - 1) + 1)
    return classes, classes * classes - own - 1


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Ids by falling count; what the driver gathers is the words with ids of their own and the sums of the shared ids."""
    return _vocabulary(durable(counts, "lm-words"))


def _vocabulary(counts: DataFrame) -> Vocabulary:
    tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    often = counts.where(F.col("n") >= math.sqrt(tokens) / OWN_PART)
    own = often.count()
    if own <= OWN_WORDS:
        own, often = OWN_WORDS, counts.orderBy(F.desc("n"), "hash").limit(OWN_WORDS)
    top = often.select("hash", "n").toArrow()
    signed, n = top.column("hash").to_numpy(), top.column("n").to_numpy()
    order = np.lexsort((signed, -n))
    hashes, n = signed[order].astype(np.int64).view(np.uint64), n[order]
    classes, shared = sizes(own)
    size = classes * classes
    share = np.zeros(size)
    share[: len(n)] = n
    # a signed hash is its unsigned value less 2**64
    slot = F.pmod(F.pmod("hash", F.lit(shared)) + F.expr(f"IF(hash < 0, {(1 << 64) % shared}, 0)"), F.lit(shared))
    for row in counts.groupBy(slot.alias("slot")).agg(F.sum("n").alias("n")).collect():
        share[own + row["slot"]] = row["n"]
    share[own : own + shared] -= np.bincount((hashes % np.uint64(shared)).astype(np.int64), weights=n, minlength=shared)
    # classes of equal size, dealt by falling count, so that each holds frequent and rare ids
    order = np.argsort(-share, kind="stable")
    class_of, place = np.zeros(size, np.int64), np.zeros(size, np.int64)
    class_of[order] = np.arange(size) % classes
    place[order] = np.arange(size) // classes
    ids = np.arange(len(hashes))
    by_hash = np.argsort(hashes)
    return Vocabulary(
        hashes[by_hash], ids[by_hash], class_of, place, np.log((share + 1) / (share + 1).sum()),
        own, shared, share[own : own + shared], PIECES + distinct // PIECE_WORDS,
    )


Parameters = dict[str, np.ndarray]
NAMES = "EbCcWw"


def shapes(classes: int) -> dict[str, tuple[int, ...]]:
    return {
        "E": (len(SIDES), classes * classes, SIZE), "b": (SIZE,), "C": (SIZE, classes), "c": (classes,),
        "W": (classes, SIZE, classes), "w": (classes, classes),
    }


def start(words: Vocabulary, seed: int = 3) -> Parameters:
    """Small random weights; the biases give the corpus shares, so the network begins as a unigram model."""
    rng = np.random.default_rng(seed)
    p = {k: (rng.normal(0, 0.1, s) if k in "ECW" else np.zeros(s)).astype(np.float32) for k, s in shapes(words.classes).items()}
    share = np.exp(words.log_share)
    mass = np.bincount(words.class_of, weights=share, minlength=words.classes)
    p["c"] = np.log(mass).astype(np.float32)
    p["w"][words.class_of, words.place] = np.log(share / mass[words.class_of])
    return p


def flat(p: Parameters) -> np.ndarray:
    return np.concatenate([p[k].reshape(-1) for k in NAMES])


def shaped(values: np.ndarray, classes: int) -> Parameters:
    out, at = {}, 0
    for k, s in shapes(classes).items():
        n = int(np.prod(s))
        out[k] = values[at : at + n].reshape(s).astype(np.float32)
        at += n
    return out


def contexts(ids: np.ndarray, words: np.ndarray, edge: int = EDGE) -> np.ndarray:
    """Ids on the four sides of every token; beyond the ends of its document the edge."""
    n, ends = len(ids), np.cumsum(words)
    out = np.full((len(SIDES), n), edge, np.int64)
    for k, side in enumerate(SIDES):
        if side < 0:
            out[k, -side:] = ids[:side]
        else:
            out[k, :-side] = ids[side:]
        for j in range(abs(side)):
            long = words > j
            out[k, (ends - words)[long] + j if side < 0 else ends[long] - 1 - j] = edge
    return out


def _calm(weights: np.ndarray, bias: np.ndarray) -> bool:
    """Can no score of these outputs overflow or vanish as an exponential?  Hidden values lie in -1 .. 1."""
    return float((np.abs(weights).sum(axis=-2) + np.abs(bias)).max()) < 60


def _exps(x: np.ndarray, calm: bool) -> np.ndarray:
    """Exponentials of scores in place, up to one factor a row."""
    if not calm:
        x -= x.max(axis=1, keepdims=True)
    return np.exp(x, out=x)


def _log_share(x: np.ndarray, at: np.ndarray, calm: bool) -> np.ndarray:
    """Log of each row's softmax at one column; `x` is overwritten."""
    if not calm:
        x -= x.max(axis=1, keepdims=True)
    own = x[np.arange(len(at)), at]
    return own - np.log(np.exp(x, out=x).sum(axis=1))


def _by_class(p: Parameters, words: Vocabulary, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order of the tokens by class, class and place of each in that order, and where classes begin."""
    classes = len(p["c"])
    own = words.class_of[ids]
    order = np.argsort(own.astype(np.uint16) if classes < 1 << 16 else own, kind="stable")
    own = own[order]
    return order, own, words.place[ids[order]], np.searchsorted(own, np.arange(classes + 1))


def _hidden(p: Parameters, around: np.ndarray) -> np.ndarray:
    h = p["E"][0][around[0]] + p["b"]
    for k in range(1, len(SIDES)):
        h += p["E"][k][around[k]]
    return np.tanh(h, out=h)


def log_probability(p: Parameters, words: Vocabulary, ids: np.ndarray, around: np.ndarray) -> np.ndarray:
    """Conditional log-probability of every token given its sides."""
    out = np.zeros(len(ids))
    calm_first, calm = _calm(p["C"], p["c"]), _calm(p["W"], p["w"])
    step = 256 * len(p["c"])
    for low in range(0, len(ids), step):
        part = slice(low, low + step)
        order, own, place, bounds = _by_class(p, words, ids[part])
        h = _hidden(p, around[:, part][:, order])
        found = _log_share(h @ p["C"] + p["c"], own, calm_first)
        for c in range(len(p["c"])):
            rows = slice(bounds[c], bounds[c + 1])
            if bounds[c] < bounds[c + 1]:
                found[rows] += _log_share(h[rows] @ p["W"][c] + p["w"][c], place[rows], calm)
        out[part][order] = found
    return out


def gradient(p: Parameters, words: Vocabulary, ids: np.ndarray, around: np.ndarray) -> tuple[float, Parameters]:
    """Sum of the tokens' negative log-probabilities, and its derivative by every parameter."""
    n = len(ids)
    calm_first, calm = _calm(p["C"], p["c"]), _calm(p["W"], p["w"])
    order, own, place, bounds = _by_class(p, words, ids)
    around = around[:, order]
    h = _hidden(p, around)
    every = np.arange(n)
    first = _exps(h @ p["C"] + p["c"], calm_first)
    first *= 1 / first.sum(axis=1, keepdims=True)
    loss = -np.log(first[every, own] + 1e-30).sum()
    first[every, own] -= 1
    g = {k: np.zeros(v.shape, np.float32) for k, v in p.items()}
    g["C"], g["c"] = h.T @ first, first.sum(axis=0)
    dh = first @ p["C"].T
    for c in range(len(p["c"])):
        rows = slice(bounds[c], bounds[c + 1])
        if bounds[c] < bounds[c + 1]:
            hc = h[rows]
            second = _exps(hc @ p["W"][c] + p["w"][c], calm)
            second *= 1 / second.sum(axis=1, keepdims=True)
            spot = every[: len(hc)], place[rows]
            loss -= np.log(second[spot] + 1e-30).sum()
            second[spot] -= 1
            g["W"][c], g["w"][c] = hc.T @ second, second.sum(axis=0)
            dh[rows] += second @ p["W"][c].T
    dh *= 1 - h * h
    g["b"] = dh.sum(axis=0)
    for k in range(len(SIDES)):
        # narrow numbers are sorted faster
        by = np.argsort(around[k].astype(np.uint16) if p["E"].shape[1] <= 1 << 16 else around[k], kind="stable")
        ids_k = around[k][by]
        heads = np.flatnonzero(np.r_[True, ids_k[1:] != ids_k[:-1]])
        g["E"][k][ids_k[heads]] = np.add.reduceat(dh[by], heads, axis=0)
    return float(loss), g


def descend(p: Parameters, state: Parameters, words: Vocabulary, ids: np.ndarray, around: np.ndarray, rate: float, batch: int) -> None:
    """One pass of Adagrad steps over the tokens, changing `p` and `state` in place."""
    for low in range(0, len(ids), batch):
        part = slice(low, low + batch)
        _, g = gradient(p, words, ids[part], around[:, part])
        n = len(ids[part])
        for k in p:
            g[k] /= n
            size = g[k] * g[k]
            state[k] += size
            np.sqrt(state[k], out=size)
            size += 1e-6
            g[k] *= rate
            g[k] /= size
            p[k] -= g[k]


def train(docs: DataFrame, words: Vocabulary, rounds: int = ROUNDS, rate: float = 0.05, batch: int = 8192) -> Parameters:
    """Parameters after `rounds` of local passes and averaging; every document is read in one round."""
    spark = docs.sparkSession
    ship_package(spark)
    p, classes = start(words), words.classes
    step = batch * classes // CLASSES  # as many tokens for each class, however many classes
    width = 1024
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast((flat(p), words))

        def local(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            begun, known = shared.value
            own = shaped(begun, classes)
            state = {k: np.full(v.shape, 1e-8, np.float32) for k, v in own.items()}
            tokens = 0
            for batch_ in batches:
                data, offsets = column_bytes(batch_.column(0))
                for low, high in slices(offsets, 2 << 20):
                    part, at = data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
                    begin, end, counts = word_bounds(part, at)
                    ids = known.encode(word_hashes(part, begin, end))
                    descend(own, state, known, ids, contexts(ids, counts, known.edge), rate, step)
                    tokens += len(ids)
            if tokens:
                values = flat(own)
                values = np.append(values, np.zeros(-len(values) % width, np.float32)).reshape(-1, width)
                rows = len(values)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(rows)), pa.array(np.full(rows, tokens)), pa.array([v.tobytes() for v in values], pa.binary())],
                    ["piece", "tokens", "values"],
                )

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            tokens: dict[int, int] = {}
            for batch_ in batches:
                for piece, n, values in zip(*[c.to_pylist() for c in batch_.columns], strict=True):
                    sums[piece] = sums.get(piece, 0) + np.frombuffer(values, np.float32) * np.float64(n)
                    tokens[piece] = tokens.get(piece, 0) + n
            if sums:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(sums)), pa.array(list(tokens.values())),
                        pa.array([(v / tokens[k]).astype(np.float32).tobytes() for k, v in sums.items()], pa.binary()),
                    ],
                    ["piece", "tokens", "values"],
                )

        mine = docs.where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == turn).select("text")
        schema = "piece long, tokens long, values binary"
        # a piece holds a thousand parameters; groups of tasks are added first, then the groups
        groups = F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("group")
        parts = mine.mapInArrow(local, schema).select("piece", "tokens", "values", groups)
        parts = parts.repartition("piece", "group").select("piece", "tokens", "values").mapInArrow(added, schema)
        summed = parts.repartition("piece").mapInArrow(added, schema)
        rows = summed.collect()  # the size of the model, however large the corpus
        shared.unpersist()
        if rows:
            rows = sorted(rows, key=lambda r: r["piece"])
            total = np.concatenate([np.frombuffer(r["values"], np.float32) for r in rows])
            p = shaped(total[: len(flat(p))], classes)
    return p


def _pieces(hashes: np.ndarray, rows: np.ndarray, pieces: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Number, hashes and what belongs to them of each piece."""
    piece = (mix(hashes) % np.uint64(pieces)).astype(np.int64)
    order = np.argsort(piece, kind="stable")
    hashes, rows, piece = hashes[order], rows[order], piece[order]
    bounds = np.flatnonzero(np.diff(piece, prepend=-1, append=-1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        yield int(piece[a]), hashes[a:b].tobytes(), rows[a:b].tobytes()


def _packed(part: int, found: list[tuple[int, bytes, bytes]]) -> list[pa.Array]:
    """Columns `part, piece, hashes, rows`."""
    piece, hashes, rows = zip(*found, strict=True) if found else ((), (), ())
    return [
        pa.array(np.full(len(found), part)), pa.array(piece, pa.int64()), pa.array(hashes, pa.binary()), pa.array(rows, pa.binary()),
    ]


PACKED = "part long, piece long, hashes binary, rows binary"
SCORED = "doc_id long, tokens long, pseudo_log_likelihood double"


def score(docs: DataFrame, words: Vocabulary, p: Parameters, counts: DataFrame | None = None) -> DataFrame:
    """`doc_id, tokens, pseudo_log_likelihood, mean_log_probability` of every row's whole text.

    `counts` (`hash, n` of the counted words) gives words in shared ids their
    own probability; without it they have that of the shared id.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((flat(p), words))
    apart = counts is not None

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, known = shared.value
        own = shaped(values, known.classes)
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            for low, high in slices(offsets, 4 << 20):
                part, at = data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
                begin, end, counts = word_bounds(part, at)
                hashes = word_hashes(part, begin, end)
                ids = known.encode(hashes)
                each = log_probability(own, known, ids, contexts(ids, counts, known.edge))
                n = high - low
                found = []
                if apart:
                    rare = np.flatnonzero((ids >= known.own) & (ids < known.edge))
                    each[rare] -= np.log(known.totals[ids[rare] - known.own] + 1)
                    text = np.repeat(np.arange(n, dtype=np.int32), counts)
                    found = list(_pieces(hashes[rare], text[rare], known.pieces))
                sums = np.concatenate([[0.0], np.cumsum(each)])
                ends = np.concatenate([[0], np.cumsum(counts)])
                total = sums[ends[1:]] - sums[ends[:-1]]
                total[counts == 0] = 0.0
                scores = [pa.array(np.arange(uid, uid + n)), batch.column(0).slice(low, n), pa.array(counts), pa.array(total)]
                columns = [pa.concat_arrays([x, pa.nulls(len(found), x.type)]) for x in scores]
                columns += [pa.concat_arrays([pa.nulls(n, x.type), x]) for x in _packed(uid, found)]
                yield pa.RecordBatch.from_arrays(columns, NAMED)
                uid += n

    made = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scored, f"uid long, {SCORED}, {PACKED}")
    if counts is not None:
        made = durable(made, "lm-scores")
        more = _own_shares(made.where("piece IS NOT NULL").select("part", "piece", "hashes", "rows"), counts, words.pieces)
        made = made.where("piece IS NULL").select("uid", "doc_id", "tokens", "pseudo_log_likelihood").join(more, "uid", "left")
        made = made.withColumn("pseudo_log_likelihood", F.col("pseudo_log_likelihood") + F.coalesce("more", F.lit(0.0)))
    return made.select(
        "doc_id", "tokens", "pseudo_log_likelihood",
        (F.col("pseudo_log_likelihood") / F.greatest("tokens", F.lit(1))).alias("mean_log_probability"),
    )


NAMED = ["uid", "doc_id", "tokens", "pseudo_log_likelihood", "part", "piece", "hashes", "rows"]


def _own_shares(tokens: DataFrame, counts: DataFrame, pieces: int) -> DataFrame:
    """`uid, more`: sum of log n over each document's tokens in shared ids (a word counted once, or never, adds nothing)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, n = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns)
            yield pa.RecordBatch.from_arrays(_packed(-1, list(_pieces(hashes.view(np.uint64), n, pieces))), NAMED[4:])

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, held = None, []
        hashes, logs = np.zeros(0, np.uint64), np.zeros(0)
        for batch in batches:
            parts, rows, values = [], [], []
            # the words of a piece come first
            for part, own, packed, other in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if own != piece:
                    piece, held, hashes, logs = own, [], np.zeros(0, np.uint64), np.zeros(0)
                if part < 0:
                    held.append((np.frombuffer(packed, np.uint64), np.frombuffer(other, np.int64)))
                    continue
                if held:
                    hashes, n = (np.concatenate(c) for c in zip(*held, strict=True))
                    order, held = np.argsort(hashes), []
                    hashes, logs = hashes[order], np.log(n[order])
                if not len(hashes):
                    continue
                token, text = np.frombuffer(packed, np.uint64), np.frombuffer(other, np.int32)
                at = np.minimum(np.searchsorted(hashes, token), len(hashes) - 1)
                sums = np.bincount(text, weights=np.where(hashes[at] == token, logs[at], 0.0))
                there = np.flatnonzero(sums)
                parts.append(part)
                rows.append(there.astype(np.int32).tobytes())
                values.append(sums[there].tobytes())
            columns = [pa.array(parts, pa.int64()), pa.array(rows, pa.binary()), pa.array(values, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["part", "rows", "sums"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, sums = None, np.zeros(0)

        def done() -> pa.RecordBatch:
            there = np.flatnonzero(sums)
            return pa.RecordBatch.from_arrays([pa.array(there + (part or 0)), pa.array(sums[there])], ["uid", "more"])

        for batch in batches:
            for own, rows, values in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if own != part:
                    yield done()
                    part, sums = own, np.zeros(0)
                at = np.frombuffer(rows, np.int32)
                if len(at):
                    sums = np.pad(sums, (0, max(0, int(at[-1]) + 1 - len(sums))))
                    sums[at] += np.frombuffer(values, np.float64)
        yield done()

    words = counts.where("n > 1").select("hash", "n").mapInArrow(counted, PACKED)
    both = tokens.union(words).repartition("piece").sortWithinPartitions("piece", "part")
    shares = both.select("part", "piece", "hashes", "rows").mapInArrow(met, "part long, rows binary, sums binary")
    return shares.repartition("part").sortWithinPartitions("part").mapInArrow(added, "uid long, more double")


def score_corpus(docs: DataFrame) -> DataFrame:
    """Count, train and score the same documents."""
    counts = durable(count_words(docs), "lm-words")
    words = _vocabulary(counts)
    return score(docs, words, train(docs, words), counts)
