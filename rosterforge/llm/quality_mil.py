"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages (64 words each).  Every passage of the whole
text is encoded: shares of character kinds, hashed byte pairs, repetition and
length.  A gated attention layer learns from document labels alone which
passages tell most; the document's score is a logistic function of the
attention-weighted sum of its passages' hidden representations:

    h_k = tanh(W x_k + b)
    a_k = softmax over the document of  v . (tanh(V h_k) * sigmoid(U h_k))
    score = sigmoid(c . sum_k a_k h_k + c0)

The model is fitted in numpy on a bounded sample of labelled documents (the
bounds are parameters); scoring is one pass over the texts without a shuffle.
Memory in a task follows the longest single text, never a group of rows.

Defined cases: a null text is an empty text and scores as one passage without
words; texts without words likewise; documents whose labels disagree, labels
other than 0 and 1, and null ids are not learned from; repeated rows each get
their score; with no label of one of the two classes every score is the share
of label 1 (1.0 without any label), so that nothing is rejected unlearned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterforge.llm.arrow_text import column_bytes, mix, slices, word_bounds, word_hashes
from rosterforge.llm.rows import quoted
from rosterforge.session import ship_package

PASSAGE_WORDS = 64
PAIR_BUCKETS = 64

# Kinds of characters, each byte in one; what is not listed is "other".
_KINDS = (
    "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r", ".", ",", "!", "?", ";:",
    "|", "*", "#", "$", "%", "&", "@", "/\\", "'\"`", "()[]{}<>", "-_=+~^",
)
_KIND = np.full(256, len(_KINDS), dtype=np.int64)
for _at, _chars in enumerate(_KINDS):
    _KIND[list(_chars.encode())] = _at
_KIND[0x80:0xC0] = len(_KINDS) + 1  # the rest of a character of several bytes
_KIND[0xC0:] = len(_KINDS) + 2
_N_KINDS = len(_KINDS) + 3
_PAIR = (mix(np.arange(65536, dtype=np.uint64)) % np.uint64(PAIR_BUCKETS)).astype(np.int64)
WIDTH = _N_KINDS + PAIR_BUCKETS + 4


def encode(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage, and where each text's passages begin (one more entry at the end)."""
    begin, end, words = word_bounds(data, offsets)
    passages = np.maximum(1, -(-words // PASSAGE_WORDS))
    starts = np.zeros(len(words) + 1, np.int64)
    np.cumsum(passages, out=starts[1:])
    n = int(starts[-1])
    out = np.zeros((n, WIDTH), np.float32)
    if len(begin) == 0:
        return out, starts
    text_of = np.repeat(np.arange(len(words)), words)
    within = np.arange(len(begin)) - np.repeat(np.cumsum(words) - words, words)
    passage = starts[text_of] + within // PASSAGE_WORDS
    # bytes belong to the passage of the last word begun; bytes before the first word to the first
    heads = np.flatnonzero(within % PASSAGE_WORDS == 0)
    bounds = np.full(n + 1, len(data), np.int64)
    bounds[:-1] = np.repeat(offsets[:-1], passages)
    later = heads[within[heads] > 0]
    bounds[passage[later]] = begin[later]
    size = np.diff(bounds)
    per = np.maximum(size, 1)[:, None]
    at, step = 0, 1 << 19
    while at < n:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + step)) - 1)
        to = min(to, n)
        low, high = bounds[at], bounds[to]
        chunk = data[low:high]
        row = np.repeat(np.arange(to - at), size[at:to])
        kinds = np.bincount(row * _N_KINDS + _KIND[chunk], minlength=(to - at) * _N_KINDS)
        out[at:to, :_N_KINDS] = kinds.reshape(to - at, _N_KINDS) / per[at:to]
        if len(chunk) > 1:
            pair = _PAIR[chunk[:-1].astype(np.int64) * 256 + chunk[1:]]
            inside = row[:-1] == row[1:]  # no pair crosses passages, or texts
            pairs = np.bincount((row[:-1] * PAIR_BUCKETS + pair)[inside], minlength=(to - at) * PAIR_BUCKETS)
            out[at:to, _N_KINDS : _N_KINDS + PAIR_BUCKETS] = pairs.reshape(to - at, PAIR_BUCKETS) / per[at:to]
        at = to
    hashes = word_hashes(data, begin, end)
    count = np.bincount(passage, minlength=n)
    key = np.sort((passage.astype(np.uint64) << np.uint64(36)) | (hashes >> np.uint64(28)))
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[1:] != key[:-1]
    distinct = np.bincount((key[fresh] >> np.uint64(36)).astype(np.int64), minlength=n)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (passage[1:] == passage[:-1])
    some = np.maximum(count, 1)
    tail = _N_KINDS + PAIR_BUCKETS
    out[:, tail] = np.where(count > 0, 1.0 - distinct / some, 0.0)
    out[:, tail + 1] = np.bincount(passage[again], minlength=n) / some
    out[:, tail + 2] = np.bincount(passage, weights=end - begin, minlength=n) / some / 16.0
    out[:, tail + 3] = np.log1p(count) / 4.0
    return out, starts


@dataclass
class Model:
    """Parameters, or a constant score where there was nothing to learn."""

    constant: float | None
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: dict[str, np.ndarray] | None = None

    def score(self, features: np.ndarray, starts: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(starts) - 1, self.constant)
        x = np.clip((features - self.mean) * self.scale, -8, 8)
        return _forward(self.weights, x, starts[:-1])["score"]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def _forward(p: dict[str, np.ndarray], x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    h = np.tanh(x @ p["W"] + p["b"])
    t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
    e = (t * g) @ p["v"]
    sizes = np.diff(np.append(first, len(x)))
    top = np.repeat(np.maximum.reduceat(e, first), sizes)
    a = np.exp(e - top)
    a /= np.repeat(np.add.reduceat(a, first), sizes)
    z = np.add.reduceat(a[:, None] * h, first, axis=0)
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "sizes": sizes, "score": _sigmoid(z @ p["c"] + p["c0"][0])}


def loss_and_gradient(
    p: dict[str, np.ndarray], x: np.ndarray, first: np.ndarray, y: np.ndarray, weight: np.ndarray, decay: float
) -> tuple[float, dict[str, np.ndarray]]:
    """Weighted cross-entropy over documents, and its derivative by every parameter."""
    f = _forward(p, x, first)
    s = np.clip(f["score"], 1e-12, 1 - 1e-12)
    loss = -float(np.sum(weight * (y * np.log(s) + (1 - y) * np.log(1 - s))))
    loss += decay * sum(float(np.sum(p[k] ** 2)) for k in ("W", "V", "U", "v", "c"))
    out = weight * (f["score"] - y)
    grad = {"c": f["z"].T @ out, "c0": np.array([out.sum()])}
    dz = np.repeat(out[:, None] * p["c"], f["sizes"], axis=0)
    along = np.sum(dz * f["h"], axis=1)
    mean = np.repeat(np.add.reduceat(f["a"] * along, first), f["sizes"])
    de = f["a"] * (along - mean)
    grad["v"] = (f["t"] * f["g"]).T @ de
    dt = de[:, None] * p["v"] * f["g"] * (1 - f["t"] ** 2)
    dg = de[:, None] * p["v"] * f["t"] * f["g"] * (1 - f["g"])
    grad["V"], grad["U"] = f["h"].T @ dt, f["h"].T @ dg
    dh = f["a"][:, None] * dz + dt @ p["V"].T + dg @ p["U"].T
    dh *= 1 - f["h"] ** 2
    grad["W"], grad["b"] = x.T @ dh, dh.sum(axis=0)
    for k in ("W", "V", "U", "v", "c"):
        grad[k] = grad[k] + 2 * decay * p[k]
    return loss, grad


def fit(
    bags: list[np.ndarray], labels: np.ndarray, weight: np.ndarray, hidden: int = 24, gate: int = 12,
    steps: int = 250, rate: float = 0.02, decay: float = 1e-4, seed: int = 7,
) -> Model:
    """Adam on all bags at once; the same bags in the same order give the same model."""
    features = np.concatenate(bags).astype(np.float64)
    first = np.concatenate([[0], np.cumsum([len(b) for b in bags])[:-1]])
    mean, spread = features.mean(axis=0), features.std(axis=0)
    scale = np.where(spread > 1e-6, 1.0 / np.maximum(spread, 1e-6), 0.0)
    x = np.clip((features - mean) * scale, -8, 8)
    rng = np.random.default_rng(seed)

    def some(*shape: int) -> np.ndarray:
        return rng.normal(0, 1.0 / np.sqrt(shape[0]), shape)

    p = {
        "W": some(WIDTH, hidden), "b": np.zeros(hidden), "V": some(hidden, gate), "U": some(hidden, gate),
        "v": some(gate), "c": some(hidden), "c0": np.zeros(1),
    }
    first_moment = {k: np.zeros_like(v) for k, v in p.items()}
    second_moment = {k: np.zeros_like(v) for k, v in p.items()}
    weight = weight / weight.sum()
    for step in range(1, steps + 1):
        _, grad = loss_and_gradient(p, x, first, labels, weight, decay)
        for k in p:
            first_moment[k] = 0.9 * first_moment[k] + 0.1 * grad[k]
            second_moment[k] = 0.999 * second_moment[k] + 0.001 * grad[k] ** 2
            p[k] = p[k] - rate * (first_moment[k] / (1 - 0.9**step)) / (
                np.sqrt(second_moment[k] / (1 - 0.999**step)) + 1e-8
            )
    return Model(None, mean, scale, p)


def held_out(doc_id: Column) -> Column:
    """True for documents whose labels must not be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = column_bytes(batch.column(2))
        for low, high in slices(offsets, 4 << 20):
            features, starts = encode(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
            blobs = [features[starts[i] : starts[i + 1]].tobytes() for i in range(high - low)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(low, high - low), batch.column(1).slice(low, high - low), pa.array(blobs, pa.binary())],
                ["doc_id", "quality", "bag"],
            )


def train(
    docs: DataFrame, labels: DataFrame, per_class: int = 1500, longest: int = 200_000, learn_from: Column | None = None
) -> Model:
    """Model from at most `per_class` labelled documents of each class, chosen by a hash of their id.

    Texts of more than `longest` characters are scored but not learned from;
    both bounds together bound what the driver gathers.  `learn_from` limits
    the documents (over `doc_id`); by default those not held out.
    """
    ship_package(docs.sparkSession)
    allowed = ~held_out(F.col("doc_id")) if learn_from is None else learn_from
    agreed = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & allowed)
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("quality"), F.max("quality").cast("int").alias("most"))
        .where("quality = most")
        .select("doc_id", "quality")
    )
    counts = {r["quality"]: r["n"] for r in agreed.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return Model(1.0 if not counts.get(0) else 0.0 if not counts.get(1) else None)
    chosen = None
    for value in (0, 1):
        some = agreed.where(F.col("quality") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = some if chosen is None else chosen.union(some)
    # at most 2 x per_class ids: the bound that allows the broadcast
    texts = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .where(F.coalesce(F.length("text"), F.lit(0)) <= longest)
        .join(F.broadcast(chosen), "doc_id")
        .select("doc_id", "quality", "text")
    )
    made = texts.mapInArrow(_bags, "doc_id long, quality int, bag binary")
    # however often rows repeat an id, it counts once
    once = made.groupBy("doc_id", "quality").agg(F.min("bag").alias("bag"))
    rows = sorted(once.toArrow().to_pylist(), key=lambda r: r["doc_id"])
    y = np.array([r["quality"] for r in rows], dtype=np.float64)
    if len(set(y)) < 2:
        return Model(counts.get(1, 0) / max(1, sum(counts.values())))
    bags = [np.frombuffer(r["bag"], np.float32).reshape(-1, WIDTH) for r in rows]
    seen = {v: float(np.sum(y == v)) for v in (0, 1)}
    weight = np.array([counts[int(v)] / seen[int(v)] for v in y])
    return fit(bags, y, weight)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """`doc_id, score` of every row's whole text."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            for low, high in slices(offsets, 4 << 20):
                features, starts = encode(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(shared.value.score(features, starts), pa.float64())],
                    ["doc_id", "score"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scored, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, **bounds: int) -> DataFrame:
    """`doc_id, held_out, score, predicted` of every document."""
    return score(docs, train(docs, labels, **bounds)).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def reject(docs: DataFrame, labels: DataFrame, **bounds: int) -> DataFrame:
    """All columns of the documents that score 0.5 or more, in one pass without a shuffle."""
    model = train(docs, labels, **bounds)
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    at = names.index("text")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for packed in batches:
            batch = pa.RecordBatch.from_arrays(packed.column(0).flatten(), names)
            data, offsets = column_bytes(batch.column(at))
            for low, high in slices(offsets, 4 << 20):
                features, starts = encode(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
                good = pa.array(shared.value.score(features, starts) >= 0.5)
                yield batch.slice(low, high - low).filter(good)

    return docs.select(F.struct(*[quoted(c) for c in names]).alias("row")).mapInArrow(kept, docs.schema)
