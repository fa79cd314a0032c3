"""Packing of token ids into training windows by the online sum-of-squares rule.

Each document is its token ids and an end id.  Whole windows' worth is cut off
first; what remains goes, as it comes, to the fill level that makes the sum of
squared counts of partly filled windows smallest, `counts[h]` being the number
of windows filled to `h`: opening a window, raising one from `h` to `h + r`, or
filling one up.  The rule keeps levels that complete each other in stock, so
nearly all windows fill up without cutting a document again.

The windows still open at the end of a task (or when they hold `most_open_bytes`
of ids, which bounds memory) are poured into each other, cutting documents where
windows end; the very last remainder becomes sequences of powers of two, which
need no padding.  So no sequence is padded at all.

Every task packs the rows of its own input split: nothing is shuffled, and no
key or group matters.

Defined cases: a null or empty text is the end id alone; a text longer than a
window spreads over several; repeated rows are packed each; an empty table
gives no piece; other columns play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.llm.arrow_text import column_bytes
from rosterforge.llm.word_tokens import MOST_BYTES, loaded
from rosterforge.session import ship_package

WINDOW = 4096
END_ID = 2
MOST_OPEN_BYTES = 16 << 20

# document, start in it, its ids as bytes, tokens of the document
Piece = tuple[object, int, bytes, int]


class Packer:
    """Windows of one task; `done` gathers the closed ones as lists of pieces."""

    def __init__(self, window: int = WINDOW, most_open_bytes: int = MOST_OPEN_BYTES) -> None:
        self.window, self.most_open_bytes = window, most_open_bytes
        self.counts = np.zeros(window + 1, np.int64)  # the level array; level 0 and the full level stay 0
        self.open: dict[int, list[list[Piece]]] = {}
        self.held = 0  # bytes of ids in open windows
        self.done: list[list[Piece]] = []

    def level_for(self, size: int) -> int:
        """Level to put a piece of this size on: 0 is a new window; of equal choices the fullest."""
        counts, top = self.counts, self.window - size
        change = 2 * (counts[size + 1 :] - counts[1 : top + 1] + 1)  # from level h = 1 .. top to h + size
        if len(change):
            change[-1] = 1 - 2 * counts[top]  # fills the window up
            change[counts[1 : top + 1] == 0] = np.iinfo(np.int64).max
            best = len(change) - 1 - int(np.argmin(change[::-1]))
            if change[best] <= 2 * counts[size] + 1:
                return best + 1
        return 0

    def add(self, doc_id: object, ids: bytes) -> None:
        total, full = len(ids) // 4, self.window * 4
        whole = len(ids) - len(ids) % full
        for at in range(0, whole, full):
            self.done.append([(doc_id, at // 4, ids[at : at + full], total)])
        if whole == len(ids):
            return
        rest = ids[whole:]
        size = len(rest) // 4
        level = self.level_for(size)
        pieces: list[Piece] = []
        if level:
            pieces = self.open[level].pop()
            self.counts[level] -= 1
            self.held -= 4 * level
        pieces.append((doc_id, whole // 4, rest, total))
        if level + size == self.window:
            self.done.append(pieces)
            return
        self.open.setdefault(level + size, []).append(pieces)
        self.counts[level + size] += 1
        self.held += 4 * (level + size)
        if self.held > self.most_open_bytes:
            self.pour(last=False)

    def pour(self, last: bool) -> None:
        """Close open windows by pouring them into each other; at the end of the task the last one too."""
        stream = [p for level in sorted(self.open) for pieces in self.open[level] for p in pieces]
        self.open.clear()
        self.counts[:] = 0
        self.held = 0
        window: list[Piece] = []
        room = self.window
        for doc_id, start, ids, total in stream:
            while ids:
                part, ids = ids[: room * 4], ids[room * 4 :]
                window.append((doc_id, start, part, total))
                start += len(part) // 4
                room -= len(part) // 4
                if room == 0:
                    self.done.append(window)
                    window, room = [], self.window
        if not window:
            return
        filled = self.window - room
        if not last:
            self.open[filled] = [window]
            self.counts[filled] = 1
            self.held = 4 * filled
            return
        pieces = iter(window)
        piece = next(pieces)
        for bit in range(filled.bit_length() - 1, -1, -1):
            room = filled & (1 << bit)
            if not room:
                continue
            part_of: list[Piece] = []
            while room:
                doc_id, start, ids, total = piece
                part, ids = ids[: room * 4], ids[room * 4 :]
                part_of.append((doc_id, start, part, total))
                room -= len(part) // 4
                if ids:
                    piece = (doc_id, start + len(part) // 4, ids, total)
                else:
                    piece = next(pieces, None)
            self.done.append(part_of)


def pack(
    docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = True,
    most_open_bytes: int = MOST_OPEN_BYTES, cache_bytes: int = MOST_BYTES,
) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence, its checksum and, if wanted, its ids.

    `cache_bytes` bounds what a worker keeps of known words.
    """
    ship_package(docs.sparkSession)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = loaded(tokenizer, cache_bytes)
        packer = Packer(window, most_open_bytes)
        end = end_id.to_bytes(4, "little")
        sequence = TaskContext.get().partitionId() << 32

        def rows() -> pa.RecordBatch:
            nonlocal sequence
            columns: list[list] = [[] for _ in range(8)]
            for pieces in packer.done:
                offset = 0
                for doc_id, start, ids, total in pieces:
                    n = len(ids) // 4
                    for column, value in zip(columns, (doc_id, start, n, zlib.crc32(ids), total, sequence, offset), strict=False):
                        column.append(value)
                    if with_ids:
                        columns[7].append(np.frombuffer(ids, np.int32))
                    offset += n
                sequence += 1
            packer.done = []
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            arrays = [pa.array(c, pa.int64()) for c in columns[:7]]
            if with_ids:
                names.append("ids")
                arrays.append(pa.array(columns[7], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            bounds = offsets.tolist()
            for doc_id, low, high in zip(batch.column(0).to_pylist(), bounds[:-1], bounds[1:], strict=True):
                packer.add(doc_id, words.encode(data[low:high].tobytes()) + end)
                if len(packer.done) >= (256 if with_ids else 8192):
                    yield rows()
        packer.pour(last=True)
        yield rows()

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(packed, schema + (", ids array<int>" if with_ids else ""))
