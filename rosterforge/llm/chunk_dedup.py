"""Exact dedup through content-defined chunk recipes.

A text (A-Z lower-cased) is cut where a rolling hash of its last 32 bytes hits
a pattern, about every kilobyte, so equal passages give equal chunks wherever
they stand.  A document becomes its recipe: the ordered list of its chunks'
identifiers, a hundredth of its size.  Only recipes are shuffled; the texts are
read once and never move.

An identifier is 64 bits of the chunk's SHA-256.  All chunks of the corpus are
deduplicated by identifier (map-side first, so a passage that a third of the
documents share costs one row per task) and each identifier is verified: it
must stand for one chunk only, told by 128 more bits of the digest.  Documents
with an identifier that fails compare by whole digests instead.  Equal ordered
lists are equal documents: recipes alone make the groups.  The SHA-256 of the
whole text, made in the same pass, confirms each group; one it does not confirm
is split by it.

Defined cases: a null text is an empty text, and all empty texts are equal; of
a group the largest doc_id stays (null is smallest); of rows that repeat both
doc_id and text exactly one stays; other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.llm.arrow_text import LOWER, column_bytes, mix, slices
from rosterforge.llm.rows import keep_rows
from rosterforge.session import durable, ship_package

WINDOW = 32
_GEAR = (mix(np.arange(256, dtype=np.uint64) + np.uint64(7 << 30)) >> np.uint64(32)).astype(np.uint32)
NULL_HASH = 42  # what Spark's xxhash64 gives for a null

SCHEMA = (
    "uid long, doc_id long, text_hash long, text_sha256 string, n_bytes long, ids array<long>, checks array<long>"
)


def boundaries(data: np.ndarray, offsets: np.ndarray, mean: int = 1024, most: int = 8192) -> tuple[np.ndarray, np.ndarray]:
    """Where chunks begin (and the end of the last), and how many chunks each text has; an empty text has none."""
    n = len(data)
    if n == 0:
        return np.zeros(1, np.int64), np.zeros(len(offsets) - 1, np.int64)
    rolled = _GEAR[data]
    reach = 1
    while reach < WINDOW:  # after each step the hash covers twice as many bytes
        rolled[reach:] = rolled[reach:] + (rolled[:-reach] << np.uint32(reach % 32))
        reach *= 2
    bits = max(0, int(mean).bit_length() - 1)
    cuts = np.flatnonzero((rolled >> np.uint32(32 - bits)) == 0) + 1 if bits else np.arange(1, n + 1)
    # within a text's first bytes the window would reach into its neighbour
    at = np.searchsorted(offsets, cuts, side="left") - 1
    cuts = cuts[cuts - offsets[at] >= WINDOW]
    begins = np.unique(np.concatenate([offsets[:-1][np.diff(offsets) > 0], cuts[cuts < n]]))
    gaps = np.diff(np.append(begins, n))
    parts = -(-gaps // most)
    if parts.max(initial=1) > 1:
        within = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        begins = np.repeat(begins, parts) + within * most
    counts = np.diff(np.searchsorted(begins, offsets))
    return np.append(begins, n), counts


def recipes(docs: DataFrame, mean: int = 1024, id_bits: int = 64) -> DataFrame:
    """One row per document: its whole digest and its ordered chunk identifiers with 128 check bits each."""
    ship_package(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            nulls = batch.column(1).is_null().to_numpy(zero_copy_only=False)
            data, offsets = column_bytes(batch.column(1))
            for low, high in slices(offsets, 4 << 20):
                raw = data[offsets[low] : offsets[high]]
                own = offsets[low : high + 1] - offsets[low]
                small = LOWER[raw]
                bounds, counts = boundaries(small, own, mean)
                view, whole = memoryview(small), memoryview(np.ascontiguousarray(raw))
                digests = b"".join(
                    [hashlib.sha256(view[a:b]).digest()[:24] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                )
                parts = np.frombuffer(digests, np.int64).reshape(-1, 3)
                ids = parts[:, 0] if id_bits == 64 else parts[:, 0] & ((1 << id_bits) - 1)
                ends = np.concatenate([[0], np.cumsum(counts)])
                places = own.tolist()
                pairs = list(zip(places[:-1], places[1:], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(uid, uid + high - low)),
                        batch.column(0).slice(low, high - low),
                        pa.array(
                            np.array(
                                [
                                    NULL_HASH if nulls[low + i] else xxhash.xxh64_intdigest(whole[a:b], 42)
                                    for i, (a, b) in enumerate(pairs)
                                ],
                                np.uint64,
                            ).view(np.int64)
                        ),
                        pa.array([hashlib.sha256(view[a:b]).hexdigest() for a, b in pairs], pa.string()),
                        pa.array(np.diff(own)),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.ascontiguousarray(ids))),
                        pa.ListArray.from_arrays(
                            pa.array(ends * 2, pa.int32()), pa.array(np.ascontiguousarray(parts[:, 1:]).reshape(-1))
                        ),
                    ],
                    ["uid", "doc_id", "text_hash", "text_sha256", "n_bytes", "ids", "checks"],
                )
                uid += high - low

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, SCHEMA)


def _chunks(made: DataFrame) -> DataFrame:
    return made.select(
        "uid", F.expr("inline(transform(ids, (x, i) -> struct(x AS id, checks[2 * i] AS c1, checks[2 * i + 1] AS c2)))")
    )


def verify(made: DataFrame) -> DataFrame:
    """Recipes whose identifiers are verified: `recipe` is an ordered list that only equal texts share."""
    found = (
        _chunks(made)
        .groupBy("id")
        .agg(F.min("c1").alias("a1"), F.max("c1").alias("b1"), F.min("c2").alias("a2"), F.max("c2").alias("b2"))
        .where("a1 <> b1 OR a2 <> b2")
        .select("id")
    )
    failed = durable(found, "chunk-conflicts")
    if failed.isEmpty():
        return made.withColumn("recipe", F.col("ids"))
    hit = _chunks(made).join(failed, "id", "left_semi").select("uid").distinct().withColumn("hit", F.lit(True))
    whole = F.concat("ids", "checks")
    return made.join(hit, "uid", "left").withColumn("recipe", F.when(F.col("hit"), whole).otherwise(F.col("ids"))).drop("hit")


def decide(docs: DataFrame, mean: int = 1024, id_bits: int = 64) -> DataFrame:
    """`doc_id, keep_id, group_size, kept, text_sha256, text_hash, uid` of every document."""
    return grouped(verify(durable(recipes(docs, mean, id_bits), "chunk-recipes")))


def grouped(made: DataFrame) -> DataFrame:
    """Documents of one recipe are one group; the digests of its whole texts confirm it, or else split it."""
    rows = made.select("uid", "doc_id", "text_hash", "text_sha256", "recipe", F.xxhash64("text_sha256").alias("_digest"))

    def decided(*key: str) -> DataFrame:
        return rows.groupBy(*key).agg(
            F.max("doc_id").alias("keep_id"),
            F.count("*").alias("group_size"),
            F.max_by("uid", F.coalesce("doc_id", F.lit(-(1 << 63)))).alias("keep_uid"),
            F.min("_digest").alias("_low"),
            F.max("_digest").alias("_high"),
        )

    kept = ["doc_id", "keep_id", "group_size", (F.col("uid") == F.col("keep_uid")).alias("kept"), "text_sha256", "text_hash", "uid"]
    groups = durable(decided("recipe"), "chunk-groups")
    found = rows.join(groups.where("_low = _high"), "recipe").select(*kept)
    unequal = groups.where("_low <> _high").select("recipe")
    if unequal.isEmpty():
        return found
    split = decided("recipe", "_digest").join(unequal, "recipe", "left_semi").drop("_low", "_high")
    return found.unionByName(rows.join(split, ["recipe", "_digest"]).select(*kept))


def unique(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    return keep_rows(docs, decide(docs).where("kept"))
