"""MinHash near-dedup of word-shingle multisets by BagMinHash signatures.

A document is the multiset of its five-word shingles (A-Z lower-cased, words
between whitespace; a text of one to four words is one shingle).  Similarity is
weighted Jaccard: the sum of the smaller counts over the sum of the larger.

Signatures.  The weights of a shingle are cut into dyadic rings (1], (1, 2],
(2, 4], (4, 8] ...; every (shingle, ring) owns a Poisson process whose rate is
the ring's width.  Its points carry an arrival time, a signature position and a
level inside the ring; a point counts for a document if its level is not above
the shingle's count there.  The earliest counted point per position is the
signature, so two documents agree at a position with a probability of exactly
their weighted Jaccard similarity.  A process stops at the first point later
than every position's minimum, so a document takes about n + m log m points
however heavy its repetitions are.

Links.  Documents with equal multisets are one class at once.  The others meet
in 24 bands of 5 positions (a pair at 0.8 is missed with a chance below 1 in
10,000); for a lower threshold the bands are shorter and more, to the same chance.
In a band's bucket, candidates are first compared with one leader, the
document that shares most buckets, so that a group of thousands of near copies
costs one comparison each; links join components.  Where a bucket then still
holds several components, those outside its largest are compared with all of
the bucket in blocks, inside tasks that hold the members' signatures and whole
multisets: pairs of different components whose signatures agree in 74 of 120
positions or more (a pair at 0.8 has fewer with a chance of 1 in a million; a
lower threshold asks for fewer, to the same chance) are
compared exactly, and only links that join components leave the task.  So a
group of thousands of texts just below the threshold costs comparisons, but no
rows.  Pairs already in one component need no comparison.

Defined cases: null and empty texts have no shingles and are all one class;
rows that repeat an id or a text are members of one class; the smallest doc_id
of a class stays (of repeated rows with that id, one); other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterforge.llm.arrow_text import column_bytes, mix, slices, unit, word_bounds, word_hashes
from rosterforge.llm.chunk_dedup import NULL_HASH
from rosterforge.llm.components import connected
from rosterforge.llm.rows import KEY, keep_rows, numbered, wanted
from rosterforge.session import durable, ship_package

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 5
AGREE = 74
BLOCK = 256
_FACTORS = mix(np.arange(1, WORDS + 1, dtype=np.uint64) << np.uint64(33)) | np.uint64(1)
_LOW48 = np.uint64((1 << 48) - 1)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every shingle, in order, and how many each text has."""
    begin, end, words = word_bounds(data, offsets)
    w = word_hashes(data, begin, end)
    counts = np.where(words >= WORDS, words - WORDS + 1, np.minimum(words, 1))
    first = np.cumsum(words) - words
    start = np.repeat(first, counts) + (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts))
    left = np.repeat(words, counts)  # words a short text really has
    total = np.zeros(len(start), np.uint64)
    for i in range(WORDS):
        there = np.minimum(start + i, len(w) - 1)
        part = w[there] * _FACTORS[i]
        if i:
            part[left <= i] = 0
        total += part
    return mix(total), counts


def bags(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct 48-bit shingles per text with their counts: text number, shingle, count; and elements.

    `elements` has one 48-bit number for each occurrence, sorted within its
    text, so that the overlap of two multisets is that of two sets.
    """
    text = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    key = np.sort((text << np.uint64(48)) | (hashes & _LOW48))
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(fresh)
    weight = np.diff(np.append(at, len(key)))
    nth = np.arange(len(key)) - np.repeat(at, weight)
    again = nth > 0
    if again.any():
        extra = mix((key[again] & _LOW48) + (nth[again].astype(np.uint64) << np.uint64(48))) & _LOW48
        key = key.copy()
        key[again] = (key[again] & ~_LOW48) | extra
        elements = np.sort(key)
    else:
        elements = key
    head = key[fresh]
    return (head >> np.uint64(48)).astype(np.int64), head & _LOW48, weight, elements & _LOW48


def signatures(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int, m: int = BANDS * ROWS) -> np.ndarray:
    """Earliest counted arrival per text and position; infinite for texts without shingles."""
    rings = 1 + np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64)
    ring = np.arange(rings.sum()) - np.repeat(np.cumsum(rings) - rings, rings)
    text = np.repeat(text, rings)
    low = np.where(ring == 0, 0, 1 << np.maximum(ring - 1, 0)).astype(np.int64)
    width = np.maximum(low, 1)
    room = np.repeat(weight, rings) - low  # levels of the ring that count here
    seed = mix(np.repeat(shingle, rings) ^ (ring.astype(np.uint64) << np.uint64(56)))
    best = np.full(n * m, np.inf)
    last = np.full(n, np.inf)
    time = np.zeros(len(text))
    step = np.uint64(0)
    while len(text):
        step += np.uint64(1)
        x = mix(seed + (step << np.uint64(40)))
        time = time - np.log(unit(x)) / width
        go = time <= last[text]
        if not go.all():
            text, time, width, room, seed, x = text[go], time[go], width[go], room[go], seed[go], x[go]
            if not len(text):
                break
        y = mix(x)
        place = ((y >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        level = ((y & np.uint64(0xFFFFFFFF)) * width.astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        spot, when = text * m + place, time
        counted = level < room
        if not counted.all():
            spot, when = spot[counted], when[counted]
        np.minimum.at(best, spot, when)
        alive = np.flatnonzero(np.bincount(text, minlength=n))
        last[alive] = best.reshape(n, m)[alive].max(axis=1)
    return best.reshape(n, m)


def banding(threshold: float) -> tuple[int, int, int]:
    """Bands, positions in a band, and the agreeing positions asked for, that keep the stated chances at `threshold`."""
    if threshold >= THRESHOLD:
        return BANDS, ROWS, AGREE
    m = BANDS * ROWS
    for rows in range(ROWS, 0, -1):
        if m % rows == 0 and (1 - max(threshold, 0) ** rows) ** (m // rows) < 1e-4:
            break
    else:
        raise ValueError(f"{m} positions cannot find pairs at a similarity of {threshold}")
    fewer, agree = 0.0, 0
    while (fewer := fewer + math.comb(m, agree) * threshold**agree * (1 - threshold) ** (m - agree)) <= 1e-6:
        agree += 1
    return m // rows, rows, min(agree, AGREE)


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per text and band; equal keys mean equal arrivals at all positions of the band."""
    bits = signature.view(np.uint64).reshape(len(signature), bands, rows)
    key = np.tile(mix(np.arange(bands, dtype=np.uint64) + np.uint64(99 << 40)), (len(signature), 1))
    for i in range(rows):
        key = mix(key ^ bits[:, :, i])
    return key


def _bag_rows(batches: Iterator[pa.RecordBatch], with_bands: bool, n_bands: int = BANDS, rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    uid = TaskContext.get().partitionId() << 40
    for batch in batches:
        nulls = batch.column(1).is_null().to_numpy(zero_copy_only=False)
        data, offsets = column_bytes(batch.column(1))
        for low, high in slices(offsets, 8 << 20):
            raw, own = data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
            n = high - low
            counts = np.zeros(n, np.int64)
            ends = [0]
            bands, sketches, blobs = [], [], []
            for a in range(0, n, 60_000):  # text numbers take 16 bits of a sorted key
                b = min(a + 60_000, n)
                made, counts[a:b] = shingles(raw[own[a] : own[b]], own[a : b + 1] - own[a])
                text, shingle, weight, elements = bags(made, counts[a:b])
                if with_bands:
                    signed_ = signatures(text, shingle, weight, b - a)
                    bands.append(band_keys(signed_, n_bands, rows))
                    # 32 bits of each arrival tell positions apart
                    sketches.append((mix(signed_.view(np.uint64)) >> np.uint64(32)).astype(np.uint32))
                packed = np.ascontiguousarray(elements.view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()
                ends = np.concatenate([[0], np.cumsum(counts[a:b])]) * 6
                blobs += [packed[x:y] for x, y in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            hashes = [xxhash.xxh3_128_intdigest(x) for x in blobs]
            columns = [pa.array(np.arange(uid, uid + n))] if with_bands else []
            columns.append(batch.column(0).slice(low, n))
            if with_bands:
                view = memoryview(np.ascontiguousarray(raw))
                places = own.tolist()
                columns.append(
                    pa.array(
                        np.array(
                            [
                                NULL_HASH if nulls[low + i] else xxhash.xxh64_intdigest(view[places[i] : places[i + 1]], 42)
                                for i in range(n)
                            ],
                            np.uint64,
                        ).view(np.int64)
                    )
                )
                columns.append(pa.array(np.array([h >> 64 for h in hashes], np.uint64).view(np.int64)))
                columns.append(pa.array(np.array([h & ((1 << 64) - 1) for h in hashes], np.uint64).view(np.int64)))
                columns.append(pa.array(counts))
                keys = np.concatenate(bands).view(np.int64).reshape(-1)
                # texts without shingles have no bands
                there = np.where(counts > 0, n_bands, 0)
                keys = keys[np.repeat(counts > 0, n_bands)]
                columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(there)]), pa.int32()), pa.array(keys)))
                columns.append(pa.array([x.tobytes() for x in np.concatenate(sketches)], pa.binary()))
                names = ["uid", "doc_id", "text_hash", "bag1", "bag2", "n", "bands", "sketch"]
            else:
                columns.append(pa.array(blobs, pa.binary()))
                names = ["rid", "bag"]
            yield pa.RecordBatch.from_arrays(columns, names)
            uid += n


def signed(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One narrow row per document: its multiset's digest and size, and its band keys."""
    ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lambda batches: _bag_rows(batches, True, bands, rows),
        "uid long, doc_id long, text_hash long, bag1 long, bag2 long, n long, bands array<long>, sketch binary",
    )


def unpacked(blobs: list[bytes]) -> list[np.ndarray]:
    """Elements of each multiset, from six bytes each."""
    sizes = [len(b) // 6 for b in blobs]
    wide = np.zeros((sum(sizes), 8), np.uint8)
    wide[:, :6] = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, 6)
    return np.split(wide.view(np.uint64).reshape(-1), np.cumsum(sizes)[:-1]) if sizes else []


def jaccard(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Exact weighted Jaccard similarity of each pair of multisets; two empty ones are equal."""
    sizes = np.array([[len(x), len(y)] for x, y in zip(left, right, strict=True)], np.int64).reshape(-1, 2)
    common = np.zeros(len(left), np.int64)
    for a, b in slices(np.concatenate([[0], np.cumsum(sizes.sum(axis=1))]), 1 << 20):
        for low in range(a, b, 60_000):  # pair numbers take 16 bits of a sorted key
            high = min(b, low + 60_000)
            number = np.arange(high - low, dtype=np.uint64) << np.uint64(48)
            keys = [
                np.concatenate(side[low:high]) | np.repeat(number, sizes[low:high, k]) for k, side in enumerate((left, right))
            ]
            merged = np.sort(np.concatenate(keys))
            same = merged[1:][merged[1:] == merged[:-1]]
            common[low:high] = np.bincount((same >> np.uint64(48)).astype(np.int64), minlength=high - low)
    union = sizes.sum(axis=1) - common
    return np.where(union > 0, common / np.maximum(union, 1), 1.0)


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = jaccard(unpacked(batch.column(2).to_pylist()), unpacked(batch.column(3).to_pylist()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found)], ["a", "b", "similarity"])


def similarities(pairs: DataFrame, features: DataFrame) -> DataFrame:
    """`a, b, similarity` of pairs of representatives."""
    left = features.selectExpr("rid AS a", "bag AS bag_a")
    right = features.selectExpr("rid AS b", "bag AS bag_b")
    return (
        pairs.join(left, "a").join(right, "b").select("a", "b", "bag_a", "bag_b")
        .mapInArrow(_overlaps, "a long, b long, similarity double")
    )


def _packed(count: str, number: str) -> Column:
    """One number that orders by count, then by the smaller number: its maximum needs no sort."""
    return F.expr(f"CAST({count} AS DECIMAL(38, 0)) * 10000000000000000000BD + (9223372036854775807 - {number})")


def _unpacked(name: str) -> Column:
    return F.expr(f"9223372036854775807 - CAST(top % 10000000000000000000BD AS BIGINT) AS {name}")


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`doc_id, class_id, class_size, kept, text_hash` of every document.

    `class_id` is the smallest doc_id of the class: documents linked directly or
    through others by a similarity of `threshold` or more.
    """
    bands, size, _ = banding(threshold)
    rows = durable(signed(docs, bands, size), "bag-signatures")
    # aggregates are written ahead of their joins, so that each join reads both sides from shuffles of their own, which Spark can split at a hot key
    same = durable(rows.groupBy("bag1", "bag2").agg(F.min("uid").alias("rid")), "bag-distinct")
    members = durable(
        rows.select("uid", "doc_id", "text_hash", "bag1", "bag2").join(same, ["bag1", "bag2"])
        .select("uid", "doc_id", "text_hash", "rid"), "bag-members",
    )
    # one row per distinct multiset, and per band of it
    reps = rows.join(same.select("rid"), F.col("uid") == F.col("rid"), "left_semi")
    spots = durable(reps.select(F.col("uid").alias("rid"), "n", F.posexplode("bands").alias("band", "key")), "bag-bands")
    shared = durable(spots.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "bag-shared")
    buckets = durable(spots.join(shared, "key"), "bag-buckets")
    weight = buckets.groupBy("rid").agg(F.sum("size").alias("weight"))
    buckets = durable(buckets.drop("size").join(weight, "rid"), "bag-buckets")
    # the texts of candidates are read a second time; only they are turned into multisets
    names = rows.select(F.col("uid").alias("rid"), "doc_id", "text_hash", "n", "sketch").join(weight.select("rid"), "rid", "left_semi")
    names = durable(names, "bag-candidates")
    features = durable(_features(docs, names), "bag-multisets")

    # weight first, then the smaller id: one number per document, so that the maximum needs no sort
    leaders = durable(buckets.groupBy("key").agg(F.max(_packed("weight", "rid")).alias("top")).select("key", _unpacked("leader")), "bag-leaders")
    sizes = names.select(F.col("rid").alias("leader"), F.col("n").alias("leader_n"))
    pairs = (
        buckets.select("key", "rid", "n").join(leaders, "key").where("rid <> leader").join(sizes, "leader")
        .where(f"least(n, leader_n) >= {threshold} * greatest(n, leader_n)")
        .selectExpr("least(leader, rid) AS a", "greatest(leader, rid) AS b").distinct()
    )
    linked = f"similarity >= {threshold}"
    stars = durable(similarities(pairs, features).where(linked).select("a", "b"), "bag-links")
    roots = connected(stars)
    rest = durable(_rest(buckets, roots, names.join(features, "rid"), threshold), "bag-links")
    if not rest.isEmpty():
        roots = connected(stars.union(rest))
    named = members.join(roots.selectExpr("node AS rid", "root"), "rid", "left").withColumn("root", F.coalesce("root", "rid"))
    return _with_class(durable(named, "bag-named"))


def _with_class(named: DataFrame) -> DataFrame:
    """Every document with its class, by the class's root; one class may hold a third of the rows."""
    groups = named.groupBy("root").agg(
        F.min("doc_id").alias("class_id"),
        F.count("*").alias("class_size"),
        F.min_by("uid", F.coalesce("doc_id", F.lit((1 << 63) - 1))).alias("keep_uid"),
    )
    return named.join(durable(groups, "bag-classes"), "root").select(
        "doc_id", "class_id", "class_size", (F.col("uid") == F.col("keep_uid")).alias("kept"), "text_hash"
    )


def _features(docs: DataFrame, names: DataFrame) -> DataFrame:
    """`rid, bag` of the named documents: all elements of the multiset, six bytes each."""
    own = numbered(docs, docs["text"].alias("_text")).where("_n = 1")
    return (
        own.join(wanted(names, "rid"), KEY)
        .select("rid", "_text")
        .mapInArrow(lambda batches: _bag_rows(batches, False), "rid long, bag binary")
    )


def _rest(buckets: DataFrame, roots: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links between different components that share a bucket, enough of them to join those components.

    Members outside and inside a bucket's largest component are cut into blocks
    of about `BLOCK` by hash; every two blocks meet in a task unless both are
    inside, so a bucket of any size is spread.
    """
    named = buckets.select("key", "band", "rid").join(roots.selectExpr("node AS rid", "root"), "rid", "left")
    placed = _placed(durable(named.withColumn("root", F.coalesce("root", "rid")), "bag-parts"))
    others = F.expr("sequence(0, IF(block < outer_blocks, outer_blocks + inner_blocks, outer_blocks) - 1)")
    dealt = placed.select("key", "band", "rid", "root", "block", F.explode(others).alias("other"))
    rows = dealt.join(texts.select("rid", "n", "sketch", "bag"), "rid").selectExpr(
        "xxhash64(key, least(block, other), greatest(block, other)) AS task", "key", "band", "rid", "root",
        "block", "block <> other AS across", "n", "sketch", "bag",
    )

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            marks = np.asarray(table.column("task"))
            changes = np.flatnonzero(np.diff(marks)) + 1
            last = int(changes[-1]) if len(changes) else 0
            if last:
                yield _joined(table.slice(0, last), threshold)
            held = table.slice(last)
        if held is not None:
            yield _joined(held, threshold)

    ordered = rows.repartition("task").sortWithinPartitions("task", "key")
    return ordered.mapInArrow(met, "a long, b long").distinct()


def _placed(named: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components, with their blocks; one bucket may hold a third of the rows."""
    parts = named.groupBy("key", "root").agg(F.count("*").alias("part"))
    open_ = parts.groupBy("key").agg(
        F.max(_packed("part", "root")).alias("top"), F.sum("part").alias("all"), F.max("part").alias("most")
    ).where("all > most").select(
        "key", _unpacked("main"), F.expr(f"CAST(ceil((all - most) / {BLOCK}) AS INT)").alias("outer_blocks"),
        F.expr(f"CAST(ceil(most / {BLOCK}) AS INT)").alias("inner_blocks"),
    )
    return named.join(durable(open_, "bag-open"), "key").selectExpr(
        "key", "band", "rid", "root", "outer_blocks", "inner_blocks",
        "IF(root = main, outer_blocks + CAST(pmod(xxhash64(rid), inner_blocks) AS INT), CAST(pmod(xxhash64(rid), outer_blocks) AS INT)) AS block",
    )


def _joined(table: pa.Table, threshold: float) -> pa.RecordBatch:
    """Links that join the components of each block task in `table` (its rows next to each other)."""
    task, key, band, rid, root, block, across, n = (
        np.asarray(table.column(k)) for k in ("task", "key", "band", "rid", "root", "block", "across", "n")
    )
    sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint32).reshape(len(rid), -1)
    bands, rows, least = banding(threshold)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for step in range(1, len(rid)):
        x = np.flatnonzero((task[step:] == task[:-step]) & (key[step:] == key[:-step]))
        if not len(x):
            break
        y = x + step
        fit = (root[x] != root[y]) & (np.minimum(n[x], n[y]) >= threshold * np.maximum(n[x], n[y]))
        fit &= ~across[x] | (block[x] != block[y])  # of two blocks only pairs across them
        x, y = x[fit], y[fit]
        same = sketch[x] == sketch[y]
        agree = same.sum(axis=1)
        fit = agree >= least
        x, y, same, agree = x[fit], y[fit], same[fit], agree[fit]
        if len(x):
            shared = same.reshape(len(x), bands, rows).all(axis=2).argmax(axis=1)
            fit = shared == band[x]  # a pair leaves only the first bucket it shares
            found.append((x[fit], y[fit], agree[fit]))
    x, y, agree = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
    bags_ = unpacked(table.column("bag").to_pylist())
    parent: dict[tuple[int, int], tuple[int, int]] = {}

    def top(node: tuple[int, int]) -> tuple[int, int]:
        path = []
        while node in parent:
            path.append(node)
            node = parent[node]
        for step_ in path:
            parent[step_] = node
        return node

    links = []
    order = np.argsort(-agree, kind="stable")  # the likeliest first: what they join needs no comparison
    for at in range(0, len(order), 2048):
        part = order[at : at + 2048]
        ends = [
            (top((t, r)), top((t, s)))
            for t, r, s in zip(task[x[part]].tolist(), root[x[part]].tolist(), root[y[part]].tolist(), strict=True)
        ]
        part = part[[one != two for one, two in ends]]
        alike = jaccard([bags_[i] for i in x[part]], [bags_[i] for i in y[part]])
        for i in part[alike >= threshold].tolist():
            one, two = top((int(task[x[i]]), int(root[x[i]]))), top((int(task[x[i]]), int(root[y[i]])))
            if one != two:
                parent[one] = two
                links.append(i)
    x, y = x[links], y[links]
    a, b = rid[x], rid[y]
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of `docs` per class, with all its columns."""
    return keep_rows(docs, classes(docs, threshold).where("kept"))
