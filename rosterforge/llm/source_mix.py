"""Mixing sources to target weights by index permutations over fixed-length blocks.

Every source is a stream of words: its documents in an order given by a hash of
their ids.  The stream is cut into blocks of `block` words.  The mix has as many
slots as all words fill blocks, in output shards of `shard_slots`.  Each shard
draws how many of its slots every source gets by one multinomial draw over all
its slots (seeded by the shard's number, so reruns and lost executors draw the
same).  What the draws leave of a target goes to one last shard; slots by which
they exceed it stay empty, so every source gives its target to the word.

The j-th slot of a source reads pass j // blocks of its stream, at the block that
the pass's own pseudorandom permutation (a Feistel network walked into range)
gives for j % blocks.  The short block at the stream's end comes last in each
pass, and the last slot is cut, so a source gives its target to the word.
Slots and blocks meet in one join on (source, block): no key is hot, for a
source is spread over its blocks, and only numbers move.

Targets.  Sources by code point, null last, weigh 1, 2, 3, repeating, and share
all words; a target stops at 3 times its source's size and the excess is
reshared by weight until none is above.  One row per source is broadcast to
the draws; more than `most_sources` of them is an error.

Defined cases: a null or empty text has size 0 and is never taken; a source
without words has target 0; repeated rows are documents of their own; no
document exceeds 3 times its size, because no pass reads a word twice; an
empty table gives an empty mix; extra columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterforge.llm.arrow_text import mix, word_bounds
from rosterforge.llm.rows import quoted
from rosterforge.session import durable, ship_package

MOST_PASSES = 3
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Shares:
    """One entry per source, in order."""

    target: np.ndarray
    size: np.ndarray

    def blocks(self, block: int) -> np.ndarray:
        return -(-self.size // block)

    def slots(self, block: int) -> np.ndarray:
        """Slots that hold exactly the rounded target of each source."""
        words = np.rint(self.target).astype(np.int64)
        passes = np.where(self.size > 0, words // np.maximum(self.size, 1), 0)
        rest = words - passes * self.size
        return passes * self.blocks(block) + -(-rest // block)


def sources(narrow: DataFrame) -> DataFrame:
    """`source_no, source, weight, source_size, target`, one row per source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    totals = (
        narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("source_no", F.row_number().over(order).cast("long") - 1)
        .withColumn("weight", F.col("source_no") % 3 + 1)
    )
    # sources that reach their ceiling first come first; the others share what is left by weight
    by_ceiling = Window.orderBy(F.expr("source_size / weight"), "source_no")
    before = by_ceiling.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ceiling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    ceiling = f"{MOST_PASSES} * source_size"
    level = totals.withColumns(
        {
            "_left": F.sum("source_size").over(everything) - F.coalesce(F.sum(F.expr(ceiling)).over(before), F.lit(0)),
            "_weights": F.sum("weight").over(after),
        }
    ).withColumn("_level", F.expr("CAST(_left AS DOUBLE) / _weights"))
    at = F.min(F.expr(f"CASE WHEN {ceiling} > _level * weight THEN struct(source_size / weight AS r, source_no AS s, _level AS l) END"))
    level = level.withColumn("_share", at.over(everything)["l"])
    target = F.expr(f"CAST(coalesce(least(CAST({ceiling} AS DOUBLE), _share * weight), {ceiling}) AS DOUBLE)")
    return level.select("source_no", "source", "weight", "source_size", target.alias("target"))


def sized(docs: DataFrame, uid: Column | None = None) -> DataFrame:
    """Narrow rows: `uid, doc_id, text_hash, source, size`."""
    return docs.select(
        (F.monotonically_increasing_id() if uid is None else uid).alias("uid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)).cast("long"), F.lit(0)).alias("size"),
    )


def _dealt(narrow: DataFrame) -> DataFrame:
    """Rows in ranges of their source's stream: `_task` is the range, `_in` the words of the source before the row in it."""

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, words = None, 0  # the source of the row before, and its words so far
        for batch in batches:
            if not len(batch):
                continue
            owner, size = (np.asarray(batch.column(c)) for c in ("source_no", "size"))
            before = np.cumsum(size) - size
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            base = before[first]
            if owner[0] == last:
                base[0] -= words
            inside = before - np.repeat(base, np.diff(np.append(first, len(owner))))
            last, words = owner[-1], int(inside[-1] + size[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(inside)], [*batch.schema.names, "_in"])

    order = ["source_no", F.xxhash64("doc_id", "text_hash"), "doc_id", "text_hash", "uid"]
    ranged = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    summed = ranged.mapInArrow(running, T.StructType([*narrow.schema.fields, T.StructField("_in", T.LongType())]))
    return durable(summed.withColumn("_task", F.spark_partition_id()), "mix-ranges")


def streams(narrow: DataFrame) -> DataFrame:
    """Adds `at`: the words of the document's source before it.

    Documents are dealt to ranges of (source, hash), of about as many rows each
    however large a source is and however often a row repeats; the words in
    front of a row are summed inside its range, those of earlier ranges are added.
    """
    dealt = _dealt(narrow)
    sums = dealt.groupBy("source_no", "_task").agg(F.sum("size").alias("_sum"))
    earlier = Window.partitionBy("source_no").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("source_no", "_task", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    return (
        dealt.join(durable(bases, "mix-bases"), ["source_no", "_task"])
        .withColumn("at", F.col("_base") + F.col("_in"))
        .drop("_task", "_in", "_base")
    )


def draw(shard: int, slots: int, share: np.ndarray, seed: int) -> np.ndarray:
    """How many of a shard's slots each source gets: one multinomial draw over all its slots."""
    # a hair below one in sum, so that rounding over many sources never makes it more
    return np.random.default_rng([seed, shard]).multinomial(slots, share * (1 - 1e-11))


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Place of each index in a pseudorandom permutation of 0 .. n-1, one permutation per key.

    Four Feistel rounds on the smallest square of two's powers that holds n;
    results outside the range are sent through again, which keeps it one-to-one.
    """
    half = np.maximum(1, np.ceil(np.log2(np.maximum(n, 2)) / 2)).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    value = index.astype(np.uint64)
    todo = np.flatnonzero(n > 0)
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = value[todo] >> h, value[todo] & m
        for r in range(4):
            left, right = right, left ^ (mix(right + k + np.uint64(r << 58)) & m)
        value[todo] = (left << h) | right
        todo = todo[value[todo] >= n[todo].astype(np.uint64)]
    return value.astype(np.int64)


def slot_rows(shares: Shares, block: int, source: np.ndarray, nth: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the nth slot of a source: pass, block number, and how many words of the block it takes."""
    size, blocks = shares.size[source], shares.blocks(block)[source]
    words = np.rint(shares.target).astype(np.int64)[source]
    whole = size // block
    turn, place = nth // np.maximum(blocks, 1), nth % np.maximum(blocks, 1)
    key = mix(source.astype(np.uint64) * np.uint64(1 << 20) + turn.astype(np.uint64) + (np.uint64(seed) << np.uint64(44)))
    inner = place < whole
    number = np.where(inner, permuted(np.where(inner, place, 0), whole, key), whole)
    rest = words - turn * size - place * block  # what the target still wants in this pass
    return turn, number, np.minimum(np.where(inner, block, size - whole * block), rest)


def mixed_slots(known: DataFrame, shares: Shares, block: int, shard_slots: int, seed: int) -> DataFrame:
    """`shard, position, source_no, pass, block, take`: the mix, one row per slot that holds words."""
    spark = known.sparkSession
    ship_package(spark)
    total = int(shares.target.sum())
    if total <= 0:
        return spark.createDataFrame([], "shard long, position long, source_no long, pass long, block long, take long")
    slots = max(1, round(total / block))
    shards = -(-slots // shard_slots)
    share = shares.target / shares.target.sum()
    given = spark.sparkContext.broadcast((shares, share))

    def drawn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard in batch["id"]:
                counts = draw(int(shard), int(min(shard_slots, slots - shard * shard_slots)), given.value[1], seed)
                yield pd.DataFrame(
                    {"shard": shard, "source_no": np.arange(len(counts)), "n": counts, "place": np.cumsum(counts) - counts}
                )

    tasks = max(1, min(shards, 4 * spark.sparkContext.defaultParallelism))
    draws = spark.range(0, shards, 1, tasks).mapInPandas(drawn, "shard long, source_no long, n long, place long")
    draws = durable(draws.where("n > 0"), "mix-draws")
    earlier = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counted = draws.withColumn("first", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    # what the draws leave of each target is the last shard: one row per source
    passes = "CAST(rint(target) AS BIGINT) DIV source_size"
    ends = known.where("source_size > 0").selectExpr(
        "source_no",
        f"({passes}) * ceil(source_size / {block})"
        f" + ceil((CAST(rint(target) AS BIGINT) - ({passes}) * source_size) / {block}) AS wanted",
    )
    left = (
        ends.join(draws.groupBy("source_no").agg(F.sum("n").alias("had")), "source_no", "left")
        .select(
            F.lit(shards).cast("long").alias("shard"), "source_no",
            F.expr("greatest(wanted - coalesce(had, 0), 0)").alias("n"), F.coalesce("had", F.lit(0)).alias("first"),
        )
        .withColumn("place", F.sum("n").over(Window.orderBy("source_no")) - F.col("n"))
        .where("n > 0")
    )

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = given.value[0]
        limit = held.slots(block)
        for batch in batches:
            for shard, source, n, first, place in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                for low in range(0, n, 1 << 18):
                    part = np.arange(low, min(n, low + (1 << 18)))
                    part = part[first + part < limit[source]]
                    if not len(part):
                        continue
                    owner = np.full(len(part), source)
                    turn, number, take = slot_rows(held, block, owner, first + part, seed)
                    width = min(shard_slots, slots - shard * shard_slots) if shard < shards else 0
                    spot = place + part
                    if width:
                        spot = permuted(spot, np.full(len(part), width), np.full(len(part), mix(np.array([shard], np.uint64))[0]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(part), shard)), pa.array(spot), pa.array(owner), pa.array(turn), pa.array(number), pa.array(take)],
                        ["shard", "position", "source_no", "pass", "block", "take"],
                    )

    rows = counted.select("shard", "source_no", "n", "first", "place").union(left.select("shard", "source_no", "n", "first", "place"))
    return rows.mapInArrow(filled, "shard long, position long, source_no long, pass long, block long, take long")


@dataclass
class Mix:
    """The mix as tables: documents with their place, sources, and the spans that fill the slots."""

    documents: DataFrame
    sources: DataFrame
    spans: DataFrame


def plan(
    docs: DataFrame, block: int = 64, shard_slots: int = 1 << 16, seed: int = 17, most_sources: int = 1_000_000, uid: Column | None = None
) -> Mix:
    """The mix of `docs`; `uid` is a column that numbers the rows, if there is one."""
    narrow = durable(sized(docs, uid), "mix-sizes")
    known = durable(sources(narrow), "mix-sources")
    if known.count() > most_sources:
        raise ValueError(f"more than {most_sources} sources")
    rows = known.orderBy("source_no").select("target", "source_size").collect()  # at most most_sources rows of two numbers
    shares = Shares(np.array([r[0] for r in rows], float), np.array([r[1] for r in rows], np.int64))
    numbered = narrow.join(
        known.select(F.col("source").alias("_source"), "source_no", "source_size", "target"),
        F.col("source").eqNullSafe(F.col("_source")),
    ).drop("_source")
    placed = durable(streams(numbered), "mix-streams")
    # the words [at, at + size) of a stream lie in these blocks
    pieces = placed.where("size > 0").select(
        "source_no", "uid", "at", "size",
        F.explode(F.expr(f"sequence(at DIV {block}, (at + size - 1) DIV {block})")).alias("block"),
    ).selectExpr(
        "source_no", "block", "uid", f"greatest(at - block * {block}, 0) AS low",
        f"least(at + size - block * {block}, {block}) AS high", f"greatest(block * {block} - at, 0) AS doc_start",
    )
    slots = mixed_slots(known, shares, block, shard_slots, seed)
    # the slots come from a small table of draws, whose size tells nothing of theirs: no broadcast
    spans = slots.hint("merge").join(pieces.hint("merge"), ["source_no", "block"]).where("low < take").selectExpr(
        "shard", "position", "source_no", "pass", "block", "uid", "doc_start", "least(high, take) - low AS length", "low AS offset"
    )
    return Mix(placed, known, spans)


def taken(docs: DataFrame, **options: int) -> DataFrame:
    """`doc_id, size, source_size, target, taken` of every document."""
    made = plan(docs, **options)
    words = made.spans.groupBy("uid").agg(F.sum("length").alias("taken"))
    return made.documents.join(words, "uid", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def excerpt(text: str, spans: list[tuple[int, int]]) -> str:
    """The words of these spans (first word, number), sorted; neighbours keep what stands between them."""
    data = np.frombuffer(text.encode(), np.uint8)
    begin, end, _ = word_bounds(data, np.array([0, len(data)]))
    runs: list[list[int]] = []
    for start, length in spans:
        if runs and runs[-1][1] == start:
            runs[-1][1] = start + length
        else:
            runs.append([start, start + length])
    if runs == [[0, len(begin)]]:
        return text
    raw = data.tobytes()
    return b"\n".join([raw[begin[a] : end[b - 1]] for a, b in runs]).decode()


def apply(docs: DataFrame, **options: int) -> DataFrame:
    """The mix as rows of `docs`: one row per document and pass that takes words of it, with the taken text.

    A whole document keeps its text; of a part, the taken words keep the white
    space between them, and gaps become one line break.  `n_chars`, where there
    is one, follows the text.
    """
    names = docs.columns
    row = F.struct(*[quoted(c) for c in names])
    own = durable(docs.select(F.monotonically_increasing_id().alias("uid"), row.alias("row")), "mix-rows")
    inner = own.select("uid", "row.doc_id", "row.text", "row.source")
    made = plan(inner, uid=F.col("uid"), **options)
    spans = made.spans.groupBy("uid", "pass").agg(F.sort_array(F.collect_list(F.struct("doc_start", "length"))).alias("spans"))
    text_at = names.index("text")
    chars_at = names.index("n_chars") if "n_chars" in names else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.column(0).flatten()
            texts = [
                excerpt(text, [(s["doc_start"], s["length"]) for s in parts])
                for text, parts in zip(columns[text_at].to_pylist(), batch.column(1).to_pylist(), strict=True)
            ]
            if chars_at is not None:
                columns[chars_at] = pa.array([len(t) for t in texts]).cast(columns[chars_at].type)
            columns[text_at] = pa.array(texts, columns[text_at].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return own.join(spans, "uid").select("row", "spans").mapInArrow(cut, docs.schema)
