"""Language identification in two steps: family first, then one-versus-one linear SVMs within it.

A text is its letters' byte trigrams (A-Z lower-cased, everything that is no
letter a space), hashed to buckets; the square roots of their shares have
length one.  Linear support vector machines, one per family against the rest,
choose the family; machines for every pair of its languages then vote, ties
going to the larger summed margin.  All are trained in numpy (squared hinge,
accelerated gradient) on a bounded sample of each language; whole texts are
scored in one pass without a shuffle.

Families are a parameter.  A language that it doesn't name is a family of its own.

Defined cases: a null text, and a text without any letter, is `und` with score
0; with no learned language every text is; a single learned language is
predicted for every text that has letters, with score 1; repeated rows each get
a row and their id is learned from once; null languages are not learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterforge.llm.arrow_text import column_bytes, mix, slices
from rosterforge.session import ship_package

BUCKETS = 2048
NONE = "und"

# --- fixed values: families of common language codes -----------------------------
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb", "yi"),
    "romance": ("fr", "es", "pt", "it", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "tt"),
    "semitic": ("ar", "he", "mt", "am"),
    "indic": ("hi", "bn", "ur", "mr", "gu", "pa", "ne"),
    "sinitic": ("zh", "yue"),
}

_LETTER = np.full(256, 32, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)
_HASH = mix(np.arange(3 * 256, dtype=np.uint64)).reshape(3, 256).astype(np.uint32)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of unit length per text (all zero for a text of fewer than three bytes)."""
    n = len(offsets) - 1
    out = np.zeros((n, BUCKETS), np.float32)
    if len(data) < 3:
        return out
    letters = _LETTER[data]
    code = _HASH[0][letters[:-2]] + _HASH[1][letters[1:-1]] + _HASH[2][letters[2:]]
    code = ((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64)
    blank = (letters[:-2] == 32) & (letters[1:-1] == 32) & (letters[2:] == 32)
    text = np.repeat(np.arange(n), np.diff(offsets))[:-2]
    last = np.repeat(offsets[1:], np.diff(offsets))[:-2]
    good = (np.arange(len(code)) + 3 <= last) & ~blank
    counts = np.bincount(text[good] * BUCKETS + code[good], minlength=n * BUCKETS).reshape(n, BUCKETS)
    total = counts.sum(axis=1, keepdims=True)
    np.sqrt(counts / np.maximum(total, 1), out=out, casting="same_kind")
    return out


def svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, steps: int = 200) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise |w|^2 / 2 + cost * mean(max(0, 1 - y (w x + b))^2), classes weighing alike."""
    each = np.where(y > 0, 0.5 / max(1, np.sum(y > 0)), 0.5 / max(1, np.sum(y < 0)))
    x1 = np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1).astype(np.float64)
    rate = 1.0 / (1.0 + 2 * cost * 2.0)  # rows have length sqrt(2) at most
    w = np.zeros(x1.shape[1])
    ahead, t = w.copy(), 1.0
    for _ in range(steps):
        short = np.maximum(0.0, 1.0 - y * (x1 @ ahead))
        grad = ahead - 2 * cost * (x1.T @ (each * short * y))
        new = ahead - rate * grad
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return w[:-1], float(w[-1])


@dataclass
class Model:
    """Languages by family, one machine per family, and one per pair of languages of a family."""

    families: list[list[str]]
    family_weights: np.ndarray | None
    family_bias: np.ndarray | None
    pairs: list[tuple[int, int, int]]  # family, and two places in it
    pair_weights: np.ndarray | None
    pair_bias: np.ndarray | None

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        n = len(x)
        if not self.families:
            return [NONE] * n, np.zeros(n)
        family, score = np.zeros(n, np.int64), np.ones(n)
        if self.family_weights is not None:
            margin = x @ self.family_weights + self.family_bias
            family = margin.argmax(axis=1)
            e = np.exp(2 * (margin - margin.max(axis=1, keepdims=True)))
            score = e[np.arange(n), family] / e.sum(axis=1)
        most = max(len(f) for f in self.families)
        votes, sums = np.zeros((n, len(self.families), most)), np.zeros((n, len(self.families), most))
        if self.pair_weights is not None:
            margin = x @ self.pair_weights + self.pair_bias
            for k, (f, a, b) in enumerate(self.pairs):
                votes[:, f, a] += margin[:, k] >= 0
                votes[:, f, b] += margin[:, k] < 0
                chance = 1 / (1 + np.exp(-np.clip(2 * margin[:, k], -60, 60)))
                sums[:, f, a] += chance
                sums[:, f, b] += 1 - chance
        row = np.arange(n)
        sizes = np.array([len(f) for f in self.families])[family]
        ranked = votes[row, family] * most + sums[row, family]
        ranked[np.arange(most)[None, :] >= sizes[:, None]] = -1
        best = ranked.argmax(axis=1)
        score = score * np.where(sizes > 1, sums[row, family, best] / np.maximum(sizes - 1, 1), 1.0)
        return [self.families[f][b] for f, b in zip(family.tolist(), best.tolist(), strict=True)], np.clip(score, 0, 1)


def fit(x: np.ndarray, langs: list[str], families: dict[str, tuple[str, ...]]) -> Model:
    of = {lang: name for name, members in families.items() for lang in members}
    grouped: dict[str, list[str]] = {}
    for lang in sorted(set(langs)):
        grouped.setdefault(of.get(lang, f"only:{lang}"), []).append(lang)
    names = sorted(grouped)
    lang_of = np.array(langs)
    family_of = np.array([of.get(lang, f"only:{lang}") for lang in langs])
    model = Model([grouped[name] for name in names], None, None, [], None, None)
    if len(names) > 1:
        made = [svm(x, np.where(family_of == name, 1.0, -1.0)) for name in names]
        model.family_weights, model.family_bias = np.stack([w for w, _ in made], axis=1), np.array([b for _, b in made])
    pairs = []
    for f, name in enumerate(names):
        for (a, one), (b, two) in combinations(enumerate(grouped[name]), 2):
            some = (lang_of == one) | (lang_of == two)
            model.pairs.append((f, a, b))
            pairs.append(svm(x[some], np.where(lang_of[some] == one, 1.0, -1.0)))
    if pairs:
        model.pair_weights, model.pair_bias = np.stack([w for w, _ in pairs], axis=1), np.array([b for _, b in pairs])
    return model


def held_out(doc_id: Column) -> Column:
    """True for documents whose language must not be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = column_bytes(batch.column(2))
        for low, high in slices(offsets, 4 << 20):
            x = features(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(low, high - low), batch.column(1).slice(low, high - low), pa.array([r.tobytes() for r in x], pa.binary())],
                ["doc_id", "lang", "x"],
            )


def train(
    docs: DataFrame, per_language: int = 400, most: int = 12_000, longest: int = 200_000,
    families: dict[str, tuple[str, ...]] | None = None,
) -> Model:
    """Model from at most `per_language` documents of each language and `most` in all, chosen by a hash of their ids.

    Held-out documents and texts of more than `longest` characters are not learned from.
    """
    ship_package(docs.sparkSession)
    known = docs.where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & (F.length("text") <= longest)
    )
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
        .withColumn("n", F.row_number().over(order))
        .where(F.col("n") <= per_language)
        .orderBy("n", F.xxhash64("doc_id"), "doc_id", "lang")
        .limit(most)
        .groupBy("doc_id")
        .agg(F.min("lang").alias("lang"))
    )
    # at most `most` ids: the bound that allows the broadcast
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.length("text") <= longest)
    made = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "lang", "text").mapInArrow(_featured, "doc_id long, lang string, x binary")
    rows = made.groupBy("doc_id", "lang").agg(F.min("x").alias("x")).toArrow().to_pylist()
    rows = sorted((r for r in rows if any(r["x"])), key=lambda r: r["doc_id"])
    if not rows:
        return Model([], None, None, [], None, None)
    x = np.stack([np.frombuffer(r["x"], np.float32) for r in rows])
    return fit(x, [r["lang"] for r in rows], FAMILIES if families is None else families)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """`doc_id, held_out, lang_pred, score` of every row's whole text."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            data, offsets = column_bytes(texts)
            for low, high in slices(offsets, 4 << 20):
                part, own = data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
                langs, scores = shared.value.predict(features(part, own))
                plain = np.concatenate([[0], np.cumsum((_LETTER[part] != 32) & (part < 128))])
                for i in np.flatnonzero(plain[own[1:]] == plain[own[:-1]]).tolist():
                    if not any(map(str.isalpha, texts[low + i].as_py() or "")):
                        langs[i], scores[i] = NONE, 0.0
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                    ["doc_id", "lang_pred", "score"],
                )

    made = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(predicted, "doc_id long, lang_pred string, score double")
    return made.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
