"""Files that hold one JSON array, read by many tasks.

The text is cut at every closing brace, which Spark's text reader can do from
any place in a file.  A first reading leaves one small row per block of a file
(the bytes that one task reads of it): whether it turns strings inside out, and
how deep it goes for either state it may begin in.  Running sums over these
rows tell every block where it begins, so the second reading can cut each block
at the commas of the array alone.  What crosses the edges of blocks is put
together at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterforge.session import durable, ship_package

# Longer elements are no records: they come in parts, each marked as not whole.
MOST_BYTES = 64 << 20
_STRETCH = 4 << 20

_OPEN = np.zeros(256, dtype=np.int8)
_OPEN[[ord("["), ord("{")]] = 1
_OPEN[[ord("]"), ord("}")]] = -1
_BLANK = b" \t\r\n\xef\xbb\xbf"


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Text up to and with each closing brace; the last piece of a file gets one too."""
    return spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"),
        F.monotonically_increasing_id().alias("row"),
        F.concat("value", F.lit("}")).cast("binary").alias("piece"),
    )


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """First row and bytes of each stretch of a batch, of one block and about 4 MB or one piece."""
    file, block, piece = batch.column("file"), batch.column("block"), batch.column("piece")
    kind = np.int64 if pa.types.is_large_binary(piece.type) else np.int32
    ends = np.frombuffer(piece.buffers()[1], dtype=kind)[piece.offset : piece.offset + len(piece) + 1]
    text = np.frombuffer(piece.buffers()[2], dtype=np.uint8)
    other = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(block[1:], block[:-1]))
    full = np.diff(ends[1:] // _STRETCH) > 0
    cuts = np.flatnonzero(other.to_numpy(zero_copy_only=False) | full) + 1
    edges = [0, *cuts.tolist(), len(piece)]
    for begin, end in zip(edges[:-1], edges[1:]):
        yield begin, text[ends[begin] : ends[end]]


def _inside(text: np.ndarray) -> np.ndarray:
    """How many quotes were seen up to each byte, modulo 2; escaped ones do not count.

    A piece ends in a brace, so no escape reaches over its end.
    """
    quotes = text == 34
    slashes = text == 92
    if slashes.any():
        # a quote is escaped where an odd number of backslashes stands before it
        place = np.arange(len(text))
        last_other = np.maximum.accumulate(np.where(slashes, -1, place))
        before = np.flatnonzero(quotes[1:] & slashes[:-1])
        odd = (before - last_other[before]) % 2 == 1
        quotes = quotes.copy()
        quotes[before[odd] + 1] = False
    return np.cumsum(quotes, dtype=np.int64) % 2 == 1


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[tuple[str, int], list[int]] = {}
    for batch in batches:
        if batch.num_rows == 0:
            continue
        for begin, text in _stretches(batch):
            key = (batch.column("file")[begin].as_py(), batch.column("block")[begin].as_py())
            inside, steps = _inside(text), _OPEN[text].astype(np.int64)
            within, all_steps = int(steps[inside].sum()), int(steps.sum())
            sums = known.setdefault(key, [batch.column("size")[begin].as_py(), 0, 0, 0, 0])
            # depth gained if the block begins outside strings, then if inside
            outer, inner = (all_steps - within, within) if not sums[2] else (within, all_steps - within)
            sums[1] += len(text)
            sums[2] ^= int(inside[-1])
            sums[3] += outer
            sums[4] += inner
    if known:
        rows = [(*key, *sums) for key, sums in known.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in zip(*rows)], names=["file", "block", "size", "n_bytes", "flips", "outer", "inner"]
        )


def block_starts(pieces: DataFrame) -> DataFrame:
    """`file, block, in_string, depth, drop_last`: the state in which each block begins.

    One narrow row per block; those of one file are summed in order in one
    task.  ``drop_last`` marks the last block of a file that ends without a
    closing brace, which the reading added.
    """
    sums = pieces.mapInArrow(
        _summaries, "file string, block long, size long, n_bytes long, flips long, outer long, inner long"
    )
    ordered = Window.partitionBy("file").orderBy("block")
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    flips = F.coalesce(F.sum("flips").over(earlier), F.lit(0)) % 2
    whole = Window.partitionBy("file")
    entered = sums.withColumn("in_string", flips == 1)
    # a byte order mark is not handed on; of compressed files the sizes never meet
    extra = F.sum("n_bytes").over(whole) - F.col("size")
    return entered.select(
        "file",
        "block",
        "in_string",
        F.coalesce(F.sum(F.when(F.col("in_string"), F.col("inner")).otherwise(F.col("outer"))).over(earlier), F.lit(0)).alias("depth"),
        ((F.col("block") == F.max("block").over(whole)) & ~extra.isin(0, -3)).alias("drop_last"),
    )


class _Block:
    """One block on its way: regions between the array's commas and brackets."""

    def __init__(self, file: str, block: int, in_string: bool, depth: int, drop_last: bool, most: int):
        self.file, self.block, self.drop_last, self.most = file, block, drop_last, most
        self.in_string, self.depth = in_string, depth
        self.open: list[bytes] = []
        self.size = self.row = 0
        self.first, self.part = True, False
        self.rows: list[tuple] = []

    def region(self, closes: bool) -> None:
        """Hands on what is open: an element, a part of one, or what crosses an edge of the block."""
        text = b"".join(self.open)
        self.open = []
        edge = self.first or not closes
        if edge or text.strip(_BLANK):
            # an element that lies in an earlier block does not begin here
            self.rows.append((self.file, self.block, self.row, text, edge, not self.first, not self.part))
            self.row += 1
        self.first = self.part = False

    def long_part(self) -> None:
        """A part of a too long element."""
        self.rows.append((self.file, self.block, self.row, b"".join(self.open), self.first, not self.first, False))
        self.row, self.part, self.open, self.size = self.row + 1, True, [], 0

    def feed(self, text: np.ndarray) -> None:
        inside = _inside(text) ^ self.in_string
        steps = np.where(inside, 0, _OPEN[text]).astype(np.int64)
        depth = np.cumsum(steps) + self.depth
        cuts = np.flatnonzero(
            ~inside
            & (
                ((text == 44) & (depth == 1))
                | ((text == 91) & (depth == 1))
                | ((text == 93) & (depth == 0))
            )
        )
        begin = 0
        for cut in cuts.tolist():
            self.open.append(text[begin:cut].tobytes())
            self.region(closes=True)
            begin, self.size = cut + 1, 0
        self.open.append(text[begin:].tobytes())
        self.size += len(text) - begin
        self.in_string, self.depth = bool(inside[-1]), int(depth[-1])
        if self.size > self.most:
            self.long_part()

    def finish(self) -> None:
        if self.drop_last and self.open:
            self.open = [b"".join(self.open)[:-1]]
        self.region(closes=False)

    def take(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        file, block, row, raw, edge, begins, whole = zip(*rows)
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.bool_(), pa.bool_(), pa.bool_()]
        names = ["file", "block", "row", "raw", "edge", "begins", "whole"]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip((file, block, row, raw, edge, begins, whole), kinds)], names=names
        )


def _regions(most: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Block | None = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            for begin, text in _stretches(batch):
                key = (batch.column("file")[begin].as_py(), batch.column("block")[begin].as_py())
                if now is None or (now.file, now.block) != key:
                    if now is not None:
                        now.finish()
                        yield now.take()
                    state = [batch.column(c)[begin].as_py() for c in ("in_string", "depth", "drop_last")]
                    now = _Block(*key, *state, most)
                now.feed(text)
                if now.rows:
                    yield now.take()
        if now is not None:
            now.finish()
            yield now.take()

    return cut


def scan_array(spark: SparkSession, path: str, most_bytes: int = MOST_BYTES) -> DataFrame:
    """`_raw, _ord, _whole`: the elements of every JSON array under ``path``, as text.

    A file is split over tasks like one of lines, whatever its line breaks.
    Blank elements (an empty array, two commas in a row) give no row.  Text
    outside an array, a last element that its file cuts off, and what stands
    behind a quote or bracket too many are rows like others, for the reader to
    judge; nothing is lost.  Elements of more than ``most_bytes`` come in
    parts, `_whole` false.  A compressed file is one block.  A file cut off
    right behind a closing brace keeps that brace, but a compressed one does not.

    Both readings take place here, and the elements are written once to the
    shared folder.  A block that the first reading did not see ends in an error.
    """
    ship_package(spark)
    pieces = _pieces(spark, path)
    known = block_starts(pieces).withColumn("seen", F.lit(True))
    placed = pieces.join(known, ["file", "block"], "left")
    checked = F.when(F.col("seen"), F.col("in_string")).otherwise(
        F.raise_error(F.lit("blocks of the file changed between two readings; read again")).cast("boolean")
    )
    # the join may come back in any order
    rows = placed.select("file", "block", "row", "piece", checked.alias("in_string"), "depth", "drop_last").sortWithinPartitions(
        "file", "block", "row"
    )
    regions = durable(
        rows.mapInArrow(
            _regions(most_bytes),
            "file string, block long, row long, raw binary, edge boolean, begins boolean, whole boolean",
        ),
        "array-elements",
    )
    where = F.struct("file", "block", "row")
    inner = regions.where(~F.col("edge")).select(F.col("raw"), where.alias("_ord"), "whole")
    return inner.unionByName(_joined_edges(regions.where("edge"), most_bytes)).select(
        F.col("raw").cast("string").alias("_raw"), "_ord", F.col("whole").alias("_whole")
    )


def _joined_edges(edges: DataFrame, most_bytes: int) -> DataFrame:
    """Elements that cross the edges of blocks: at most two parts a block, put together in order."""
    ordered = Window.partitionBy("file").orderBy("block", "row")
    # an element begins in the tail of one block and ends in the head of a later one
    group = F.sum(F.col("begins").cast("long")).over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = edges.withColumn("group", group)
    of_group = Window.partitionBy("file", "group")
    sized = numbered.withColumn("group_bytes", F.sum(F.length("raw")).over(of_group))
    # parts of a too long element stay apart
    apart = F.when(F.col("group_bytes") > most_bytes, F.struct("block", "row"))
    parts = F.sort_array(F.collect_list(F.struct("block", "row", "raw", "whole")))
    found = (
        sized.withColumn("apart", apart)
        .groupBy("file", "group", "apart")
        .agg(parts.alias("parts"))
        .select(
            F.array_join(F.transform("parts", lambda p: p["raw"].cast("string")), "").cast("binary").alias("raw"),
            F.struct("file", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["row"].alias("row")).alias("_ord"),
            (F.col("apart").isNull() & F.forall("parts", lambda p: p["whole"])).alias("whole"),
        )
    )
    return found.where(F.regexp_replace(F.col("raw").cast("string"), r"[\uFEFF \t\r\n]+", "") != "")
