"""Near-duplicate embeddings by a subspace pigeonhole join.

For unit vectors, a cosine of at least t is a squared distance of at most
2 (1 - t).  Vectors are rotated by a fixed random orthogonal matrix, which
spreads their energy evenly, and split into blocks of coordinates; each block
gets a share of the squared distance in proportion to its coordinates.  If all
blocks of a pair were beyond their share, the whole would be beyond the budget:
so every linked pair is within the share of at least one block.

Each block is a range join in few dimensions.  Pivots (a bounded sample) cut the
block into cells; a vector lives in the cell of its nearest pivot and visits
every cell whose dividing plane lies within the block's radius, so the cell where
one vector of a close pair lives holds the other.  Large cells are cut into
chunks that meet pairwise, one task each, so no cell is held in one task.

A task finds the pairs within the block's share, and verifies them at once by
their exact cosine in double precision over the whole vectors.  A pair that
several blocks find is counted by the first of them, and at the cell where the
counted vector lives, so counts are exact without a list of pairs; only counts
and links that join vectors leave a task (a group of thousands of near copies
gives one row per member, not all pairs).  Equal vectors are one from the start.

With data of no low-dimensional structure the cells of a radius this wide
overlap in most of their neighbours, and the join does about as many comparisons
as comparing all: they stay in blocks of memory-bounded tasks.

Defined cases: vectors that are null, empty or zero, or hold null or non-finite
components, link with nothing, nor do vectors of different lengths; rows that
repeat a vec_id are vectors of their own with the same id; labels and other
columns play no part; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.llm.components import connected
from rosterforge.session import durable, ship_package

BLOCKS = 4
CELL = 8192  # vectors for which one pivot is taken
LIVES, MEETS = 8192, 32_768  # vectors of a task: those counted, and those they are compared with
MOST_PIVOTS = 1024


def rotation(size: int) -> np.ndarray:
    """The same orthogonal matrix on every worker."""
    q, r = np.linalg.qr(np.random.default_rng(size).normal(size=(size, size)))
    return q * np.sign(np.diag(r))


def blocks_of(size: int, blocks: int = BLOCKS) -> list[slice]:
    ends = np.linspace(0, size, min(blocks, size) + 1).astype(int)
    return [slice(a, b) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def shares(size: int, threshold: float, blocks: int = BLOCKS) -> list[float]:
    """Squared distance that each block may take, with room for rounding."""
    return [2 * (1 - threshold) * (s.stop - s.start) / size + 1e-9 for s in blocks_of(size, blocks)]


def cells(unit: np.ndarray, pivots: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of every row, and which cells each row belongs to (its own and those within the radius)."""
    squared = np.maximum(
        (unit**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1)[None, :] - 2 * unit @ pivots.T, 0
    )
    home = squared.argmin(axis=1)
    between = np.sqrt(np.maximum((pivots**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * pivots @ pivots.T, 0))
    # distance from a row to the plane between its pivot and another; equal pivots have no plane
    gap = between[home]
    plane = (squared - squared[np.arange(len(unit)), home][:, None]) / np.where(gap > 1e-9, 2 * gap, np.inf)
    return home, plane <= radius + 1e-6


def link(embeddings: DataFrame, threshold: float = 0.9, blocks: int = BLOCKS) -> DataFrame:
    """`vec_id, n_links, component_id, kept` of every row."""
    spark = embeddings.sparkSession
    ship_package(spark)
    # single-precision input travels as it is; all arithmetic that decides is in double precision
    kind = "<f4" if embeddings.schema["embedding"].dataType.simpleString() == "array<float>" else "<f8"
    good = "size(e) > 0 AND forall(e, v -> v IS NOT NULL AND NOT isnan(v) AND abs(v) < double('Infinity')) AND exists(e, v -> v <> 0)"
    rows = durable(
        embeddings.select(
            F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e")
        ).withColumn("good", F.coalesce(F.expr(good), F.lit(False))).withColumn("e", F.expr("IF(good, e, NULL)")), "vectors",
    )
    # equal vectors (0.0 and -0.0 alike) are one, known by its smallest uid
    same = rows.where("good").withColumn("e", F.expr("transform(e, v -> v + 0D)"))
    distinct = durable(
        same.groupBy("e").agg(F.min("uid").alias("rid"), F.count("*").alias("copies"), F.min("vec_id").alias("least"))
        .withColumn("size", F.size("e")), "distinct-vectors",
    )
    sizes = {r["size"]: r["n"] for r in distinct.groupBy("size").agg(F.count("*").alias("n")).collect()}
    wanted = {size: min(MOST_PIVOTS, max(1, round(n / CELL))) for size, n in sizes.items()}
    sample = {}
    for size, n in wanted.items():
        some = distinct.where(F.col("size") == size).orderBy(F.xxhash64("rid"), "rid").limit(n).select("e").collect()
        x = np.array([r["e"] for r in some], float)
        sample[size] = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ rotation(size)
    shared = spark.sparkContext.broadcast(sample)

    def placed(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
        turns = {size: rotation(size) for size in shared.value}
        for batch in batches:
            lists = batch.column(1).to_pylist()
            length = np.array([len(v) for v in lists], np.int64)
            ids, copies = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            for size in np.unique(length).tolist():
                at = np.flatnonzero(length == size)
                x = np.array([lists[i] for i in at], float)
                unit = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ turns[size]
                blobs = [v.tobytes() for v in x.astype(kind)]
                for b, part in enumerate(blocks_of(size, blocks)):
                    radius = float(np.sqrt(shares(size, threshold, blocks)[b]))
                    home, member = cells(unit[:, part], shared.value[size][:, part], radius)
                    who, cell = np.nonzero(member)
                    place = [pa.array(np.full(len(who), size)), pa.array(np.full(len(who), b)), pa.array(cell), pa.array(home[who] == cell)]
                    if whole:
                        vectors = pa.array([blobs[i] for i in who.tolist()], pa.binary())
                        place += [pa.array(ids[at][who]), pa.array(copies[at][who]), vectors]
                    yield pa.RecordBatch.from_arrays(place, ["size", "block", "cell", "home", "rid", "copies", "vector"][: len(place)])

    given = distinct.select("rid", "e", "copies")
    place = "size long, block long, cell long, home boolean"
    # cells are worked out twice: once to count them, once to send the vectors
    counted = given.mapInArrow(lambda batches: placed(batches, False), place).groupBy("size", "block", "cell").agg(
        F.expr(f"CAST(ceil(count_if(home) / {LIVES}) AS INT)").alias("living"), F.expr(f"CAST(ceil(count(*) / {MEETS}) AS INT)").alias("met")
    )
    chunks = durable(counted.where("living > 0"), "cell-sizes")
    members = given.mapInArrow(lambda batches: placed(batches, True), place + ", rid long, copies long, vector binary")
    # one row per cell: small beside the members, broadcast or not as its written size tells
    dealt = members.join(chunks, ["size", "block", "cell"])
    # living vectors of a chunk meet all members of every chunk
    one = ("CAST(pmod(xxhash64(rid), living) AS INT) AS lives", "explode(sequence(0, met - 1)) AS meets", "0 AS side")
    two = ("explode(sequence(0, living - 1)) AS lives", "CAST(pmod(xxhash64(rid), met) AS INT) AS meets", "1 AS side")
    columns = ("size", "block", "cell", "rid", "copies", "vector")
    sides = dealt.where("home").selectExpr(*columns, *one).unionByName(dealt.selectExpr(*columns, *two))
    tasks = sides.selectExpr("xxhash64(size, block, cell, lives, meets) AS task", "size", "block", "side", "rid", "copies", "vector")
    found = (
        tasks.repartition("task").sortWithinPartitions("task", "side")
        .mapInArrow(lambda batches: _meet(batches, threshold, blocks, kind), "a long, b long, n long")
    )
    found = durable(found, "vector-links")
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("rid")).agg(F.sum("n").alias("others"))
    roots = connected(found.where("b IS NOT NULL").select("a", "b"))
    named = (
        distinct.join(counts, "rid", "left").join(roots.selectExpr("node AS rid", "root"), "rid", "left")
        .withColumn("root", F.coalesce("root", "rid"))
    )
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    answers = named.join(least, "root").select("e", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = same.join(answers, "e").select("uid", "n_links", "component_id")
    return (
        rows.select("uid", "vec_id").join(out, "uid", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )


def _meet(batches: Iterator[pa.RecordBatch], threshold: float, blocks: int, kind: str) -> Iterator[pa.RecordBatch]:
    """Counts (`a, null, n`) and joining links (`a, b, null`) of every task; its rows come one after another."""
    held: list[pa.RecordBatch] = []
    task = None
    for batch in batches:
        marks = batch.column(0).to_numpy()
        bounds = np.r_[0, np.flatnonzero(np.diff(marks)) + 1, len(marks)]
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if held and marks[low] != task:
                yield _task_links(pa.Table.from_batches(held), threshold, blocks, kind)
                held = []
            task = marks[low]
            held.append(batch.slice(low, high - low))
    if held:
        yield _task_links(pa.Table.from_batches(held), threshold, blocks, kind)


def _task_links(table: pa.Table, threshold: float, blocks: int, kind: str) -> pa.RecordBatch:
    block, side, rid, copies = (np.asarray(table.column(k)) for k in ("block", "side", "rid", "copies"))
    size = int(table.column("size")[0].as_py())
    raw = np.frombuffer(b"".join(table.column("vector").to_pylist()), kind).astype(np.float64).reshape(-1, size)
    unit = raw / np.linalg.norm(raw, axis=1, keepdims=True)
    turned = unit @ rotation(size)
    parts, limits = blocks_of(size, blocks), shares(size, threshold, blocks)
    own = int(block[0])
    lives, meets = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    counts = np.zeros(len(rid), np.int64)
    parent: dict[int, int] = {}

    def top(node: int) -> int:
        path = []
        while node in parent:
            path.append(node)
            node = parent[node]
        for step in path:
            parent[step] = node
        return node

    links: list[tuple[int, int]] = []
    # single precision finds candidates, with room for its rounding; exactness comes after
    y = turned[meets][:, parts[own]].astype(np.float32)
    y2 = (y**2).sum(axis=1)
    for low in range(0, len(lives), 256):
        some = lives[low : low + 256]
        x = turned[some][:, parts[own]].astype(np.float32)
        near = (x**2).sum(axis=1)[:, None] + y2[None, :] - 2 * x @ y.T <= limits[own] + 1e-4
        i, j = np.nonzero(near)
        i, j = some[i], meets[j]
        keep = rid[i] != rid[j]
        i, j = i[keep], j[keep]
        for at in range(0, len(i), 1 << 16):
            a, b = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            exact = np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold
            a, b = a[exact], b[exact]
            apart = (turned[a] - turned[b]) ** 2
            within = np.stack([apart[:, p].sum(axis=1) <= limit for p, limit in zip(parts, limits, strict=True)], axis=1)
            # a pair at the very edge of all shares belongs to the first block
            first = np.where(within.any(axis=1), within.argmax(axis=1), 0)
            mine = first == own
            np.add.at(counts, a[mine], copies[b[mine]])
            for m, n in zip(rid[a].tolist(), rid[b].tolist(), strict=True):
                one, two = top(m), top(n)
                if one != two:
                    parent[max(one, two)] = min(one, two)
                    links.append((m, n))
    some = np.flatnonzero(counts)
    a = np.concatenate([rid[some], np.array([m for m, _ in links], np.int64)])
    b = pa.array([None] * len(some) + [n for _, n in links], pa.int64())
    n = pa.array(counts[some].tolist() + [None] * len(links), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(a), b, n], ["a", "b", "n"])
