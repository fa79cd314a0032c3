"""Conversations whose turns break the order of roles, mended by the cheapest edits.

A repaired conversation has role initials `(s?(ua)+)?`.  Edits of a row: keep
(0), change its role to user or assistant (3), delete (4; the only one for blank
and repeated rows); an empty user or assistant row can be inserted anywhere (3);
a truncated row that stays adds 3.  Of all cheapest edits the ones are taken
whose initials in order are least (D < I < K < R).

Method: the least cost of mending the rest of a conversation, per state of the
role pattern, is a backward pass of (min, +) steps, one per row.  Conversations
are cut into chunks that are solved side by side: every chunk but the last of a
conversation starts from a guessed cost vector; then fix-up passes compare the
vector a chunk started from with the one its right neighbour arrived at, and run
those chunks again, from their end, until the new and the old vector differ only
by a constant - from there on the old result holds, shifted.  Passes end when no
chunk's start differs by more than a constant; what is added to the constants is
summed up over the chunks.  The tracing of edits also runs chunk by chunk: a
chunk maps each state it may be entered in to the state it is left in, the maps
are composed per conversation (one small row per chunk), and every chunk then
writes its edits.

Rows are ordered by ranges of (conversation, turn, ...), so a conversation with a
third of all rows lies in many partitions, in bounded chunks; nothing but one
row per chunk and the finished audit of a conversation is ever gathered.

Defined cases: nulls of role and text are one space; turns sort nulls first,
rows of one turn by role, then text; rows that repeat a role and text of an
earlier row of the conversation are duplicates; a null conversation id is a
conversation; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterforge.session import durable, ship_package

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
# A row as five bits: initial (0 other, 1 s, 2 u, 3 a), blank, truncated, duplicate.
BLANK, CUT, AGAIN = 4, 8, 16
INITIALS = {"s": 1, "u": 2, "a": 3}
BLANKS = " \t\n\v\f\r"
# States: nothing yet, after s, after u, after a; nothing yet and after a are complete.
NEXT = (2, 2, 3, 2)  # by an inserted or changed row
DONE = (0, 2 * INSERT, INSERT, 0)  # what completing costs at the end
ROLE_OF = {2: "user", 3: "assistant"}
#: at most 4096, the room for a row in a position
CHUNK_ROWS = 4096
CHUNK_CHARS = 4 << 20
_NONE = 1 << 40

Vector = tuple[int, int, int, int]


def damage(conversations: DataFrame) -> DataFrame:
    """The damage that the query mends: by a checksum of conversation and turn, rows dropped, emptied, cut, repeated or renamed."""
    blank = F.lit(" ")
    conv, turn = F.col("conv_id").cast("string"), F.col("turn").cast("string")
    kind = F.crc32(F.concat(F.coalesce(conv, blank), F.lit(":"), F.coalesce(turn, blank)).cast("binary")) % 20
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), kind.alias("_kind")
    ).where("_kind <> 0")
    times = F.when(F.col("_kind") == 3, F.sequence(F.lit(1), F.lit(2))).otherwise(F.sequence(F.lit(1), F.lit(1)))
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("_kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("_kind") == 1, F.lit("")).when(F.col("_kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(times).alias("_time"),
    ).drop("_time")


def steps(state: int, code: int) -> list[tuple[str, int, int]]:
    """Letter, cost and next state of every edit of a row, in the order of letters."""
    found = [("D", DELETE, state)]
    if not code & (BLANK | AGAIN):
        more = TRUNCATED if code & CUT else 0
        initial = code & 3
        if initial == NEXT[state] or (initial == 1 and state == 0):
            found.append(("K", KEEP + more, initial))
        found.append(("R", REROLE + more, NEXT[state]))
    return found


@lru_cache(maxsize=1 << 16)
def backward(after: Vector, code: int) -> tuple[Vector, int]:
    """The cost vector before a row from the one behind it, its least value taken out."""
    cost = [min(c + after[to] for _, c, to in steps(s, code)) for s in range(4)]
    u, a = min(cost[2], INSERT + cost[3]), min(cost[3], INSERT + cost[2])
    cost = [min(cost[0], INSERT + u), min(cost[1], INSERT + u), u, a]
    least = min(cost)
    return (cost[0] - least, cost[1] - least, cost[2] - least, cost[3] - least), least


def solve(codes: bytes, after: Vector) -> tuple[list[Vector], int]:
    """Vectors before every row and after the last, each less its least value, and the sum taken out."""
    vectors, total = [after], 0
    for code in reversed(codes):
        after, least = backward(after, code)
        vectors.append(after)
        total += least
    vectors.reverse()
    return vectors, total


def fix_up(codes: bytes, old: Vector, new: Vector, left: Vector, total: int) -> tuple[Vector, int]:
    """What `solve` gives from `new`, given what it gave from `old`: run both until they differ by a constant only."""
    shift = 0
    for code in reversed(codes):
        if old == new:
            return left, total + shift
        old, less = backward(old, code)
        new, more = backward(new, code)
        shift += more - less
    return new, total + shift


def trace(codes: bytes, vectors: list[Vector], state: int, last: bool) -> tuple[list[tuple[str, int]], int]:
    """The edits from this state on, as letters with the row's new state, and the state at the end."""
    edits: list[tuple[str, int]] = []
    for i, code in enumerate(codes):
        after = vectors[i + 1]
        while True:
            # cost of the rest is compared without constants: the row's edits and an insertion before it
            options = [(letter, cost + after[to], to) for letter, cost, to in steps(state, code)]
            inserted = _after_inserts(NEXT[state], code, after) + INSERT
            options.insert(1, ("I", inserted, NEXT[state]))
            best = min(cost for _, cost, _ in options)
            letter, to = next((letter, to) for letter, cost, to in options if cost == best)
            edits.append((letter, to))
            state = to
            if letter != "I":
                break
    if last:
        while DONE[state]:
            state = NEXT[state]
            edits.append(("I", state))
    return edits, state


@lru_cache(maxsize=1 << 16)
def _after_inserts(state: int, code: int, after: Vector) -> int:
    """Least cost from here with or without further insertions before the row."""
    vector, least = backward(after, code)
    return vector[state] + least


PLACED = (
    "chunk long, conv_id long, n int, codes binary, first_role string, last_role string, first_turn long, last_turn long, "
    "n_turns long, roles array<string>, texts array<string>"
)


def chunks(rows: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Rows in order, as runs of at most `chunk_rows` rows of one conversation; chunk numbers rise in that order."""
    ship_package(rows.sparkSession)
    if not 0 < chunk_rows <= 4096:
        raise ValueError("a chunk has 1 to 4096 rows")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 28
        names = [c.split()[0] for c in PLACED.split(", ")]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        types += [pa.list_(pa.string())] * 2
        made, conv, size, held = [], None, 0, ([], [], [])

        def closed() -> None:
            nonlocal number, size, held
            turns, roles, texts = held
            known = [t for t in turns if t is not None]
            codes = bytes(code_of(r, t) for r, t in zip(roles, texts, strict=True))
            low, high = (known[0], known[-1]) if known else (None, None)
            made.append((number, conv, len(roles), codes, roles[0], roles[-1], low, high, len(set(known)), roles, texts))
            number, size, held = number + 1, 0, ([], [], [])

        def sent() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)]
            made.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        waiting = 0
        for batch in batches:
            for own, turn, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held[0] and (own != conv or len(held[0]) >= chunk_rows or size + len(text) > CHUNK_CHARS):
                    waiting += size
                    closed()
                    if len(made) >= 2000 or waiting > CHUNK_CHARS:
                        yield sent()
                        waiting = 0
                conv = own
                size += len(text)
                for column, value in zip(held, (turn, role, text), strict=True):
                    column.append(value)
        if held[0]:
            closed()
        if made:
            yield sent()

    blank = F.lit(" ")
    narrow = rows.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", blank).alias("role"),
        F.coalesce("text", blank).alias("text"), F.monotonically_increasing_id().alias("_tie"),
    )
    # the beginning of the text and a digest stand for it, so that range bounds stay small
    order = [F.col("conv_id"), F.col("turn"), F.col("role"), F.substring("text", 1, 64), F.xxhash64("text"), F.col("_tie")]
    placed = narrow.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text")
    return durable(placed.mapInArrow(cut, PLACED), "turn-chunks")


def code_of(role: str, text: str) -> int:
    worth = text.rstrip(BLANKS)
    fault = BLANK if not worth else 0 if worth[-1] in ".!?" else CUT
    return INITIALS.get(role[:1], 0) | fault


def _positions_of_repeats(placed: DataFrame) -> DataFrame:
    """`chunk, again`: places of the rows that repeat an earlier role and text of their conversation."""
    own = placed.select("conv_id", "chunk", F.posexplode(F.arrays_zip("roles", "texts")).alias("i", "row"))
    position = (F.col("chunk") * 4096 + F.col("i")).alias("pos")
    keyed = own.select(
        F.coalesce("conv_id", F.lit(0)).alias("c"), F.col("conv_id").isNull().alias("no_c"),
        F.xxhash64("row.roles", "row.texts").alias("h1"), F.xxhash64(F.lit(1), "row.texts", "row.roles").alias("h2"), position,
    )
    first = keyed.groupBy("c", "no_c", "h1", "h2").agg(F.min("pos").alias("pos")).select("pos")
    every = placed.select("chunk", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i")).select(position)
    again = every.join(first, "pos", "left_anti").select(F.expr("pos DIV 4096").alias("chunk"), (F.col("pos") % 4096).alias("i"))
    return again.groupBy("chunk").agg(F.collect_list("i").alias("again"))


CODED = "chunk long, conv_id long, codes binary"


def _marked(placed: DataFrame) -> DataFrame:
    """Codes of every chunk with its repeats, and whether it begins or ends its conversation."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = []
            for code, again in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                own = bytearray(code)
                for i in again or ():
                    own[i] |= AGAIN
                codes.append(bytes(own))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes, pa.binary())], ["chunk", "conv_id", "codes"])

    found = placed.select("chunk", "conv_id", "codes").join(_positions_of_repeats(placed), "chunk", "left")
    coded = found.select("chunk", "conv_id", "codes", "again").mapInArrow(mark, CODED)
    # one row per chunk of the conversation
    own = Window.partitionBy("conv_id").orderBy("chunk")
    return durable(
        coded.select("*", F.lag("chunk").over(own).isNull().alias("first"), F.lead("chunk").over(own).alias("follower")), "turn-codes"
    )


VECTORS = "chunk long, follower long, start array<int>, arrived array<int>, total long"


def _vectors(batch: pa.RecordBatch, at: int) -> list[Vector | None]:
    return [None if v is None else tuple(v) for v in batch.column(at).to_pylist()]


def _solved(marked: DataFrame) -> DataFrame:
    """`chunk, start`: for every chunk the exact cost vector (less its least value) at its end."""

    def guess(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [solve(code, DONE) for code in batch.column(2).to_pylist()]
            yield _vector_rows(batch.column(0), batch.column(1), [DONE] * len(found), [(v[0], t) for v, t in found])

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts = _vectors(batch, 5)
            given = zip(batch.column(2).to_pylist(), _vectors(batch, 3), starts, _vectors(batch, 4), batch.column(6).to_pylist(), strict=True)
            yield _vector_rows(batch.column(0), batch.column(1), starts, [fix_up(*g) for g in given])

    # only conversations of several chunks need their neighbours
    several = marked.where("NOT first OR follower IS NOT NULL")
    state = durable(several.select("chunk", "follower", "codes").mapInArrow(guess, VECTORS), "turn-vectors")
    while True:
        told = state.select(F.col("chunk").alias("follower"), F.col("arrived").alias("wanted"))
        off = state.join(told, "follower").where("start <> wanted")
        off = durable(off.select("chunk", "follower", "start", "arrived", "wanted", "total"), "turn-off")
        if off.isEmpty():
            return state.select("chunk", "start")
        again = marked.select("chunk", "codes").join(off, "chunk")
        mended = again.select("chunk", "follower", "codes", "start", "arrived", "wanted", "total").mapInArrow(mend, VECTORS)
        # every pass makes at least one more chunk of each conversation exact, from its end on
        state = durable(state.join(off.select("chunk"), "chunk", "left_anti").select(*state.columns).union(mended), "turn-vectors")


def _vector_rows(chunk: pa.Array, follower: pa.Array, starts: list[Vector], found: list[tuple[Vector, int]]) -> pa.RecordBatch:
    ints = pa.list_(pa.int32())
    return pa.RecordBatch.from_arrays(
        [chunk, follower, pa.array(starts, ints), pa.array([v for v, _ in found], ints), pa.array([t for _, t in found], pa.int64())],
        ["chunk", "follower", "start", "arrived", "total"],
    )


def _entered(marked: DataFrame, solved: DataFrame) -> DataFrame:
    """`chunk, state`: the state in which every chunk of a conversation of several is entered."""

    def ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for code, start in zip(batch.column(2).to_pylist(), _vectors(batch, 3), strict=True):
                vectors, _ = solve(code, start)
                out.append([trace(code, vectors, state, False)[1] for state in range(4)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int32()))], ["chunk", "conv_id", "ways"])

    def composed(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("chunk")
        state, states = 0, []
        for way in own["ways"]:
            states.append(state)
            state = int(way[state])
        return pd.DataFrame({"chunk": own["chunk"].to_numpy(), "state": np.array(states, np.int32)})

    several = marked.join(solved, "chunk").select("chunk", "conv_id", "codes", "start")
    maps = several.mapInArrow(ways, "chunk long, conv_id long, ways array<int>")
    return maps.groupBy("conv_id").applyInPandas(composed, "chunk long, state int")


EDITED = (
    "chunk long, conv_id long, alone boolean, blank long, duplicate long, truncated long, illegal long, cost long, "
    "gained long, audit string, roles array<string>, texts array<string>, digest string"
)


def edited(rows: DataFrame, chunk_rows: int = CHUNK_ROWS, with_turns: bool = True) -> DataFrame:
    """Per chunk its faults, edits and repaired turns; chunk numbers order a conversation.

    `cost` is the cost from the beginning of a conversation, less what all its
    chunks `gained`.  Without `with_turns`, a conversation of a single chunk has
    its digest in place of its turns.
    """
    placed = chunks(rows, chunk_rows)
    marked = _marked(placed)
    solved = _solved(marked)
    several = solved.join(_entered(marked, solved), "chunk")
    plan = marked.drop("conv_id", "codes").join(several, "chunk", "left").join(marked.select("chunk", F.col("codes").alias("marks")), "chunk")
    ready = placed.join(plan, "chunk").select(
        "chunk", "conv_id", "marks", "roles", "texts", "first", F.col("follower").isNull().alias("last"), "start", "state"
    )

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in EDITED.split(", ")]
        types = [pa.int64(), pa.int64(), pa.bool_(), *[pa.int64()] * 6, pa.string(), *[pa.list_(pa.string())] * 2, pa.string()]
        for batch in batches:
            made, size = [], 0
            for row in batch.to_pylist():
                made.append(_repaired(row, with_turns))
                size += sum(map(len, made[-1][11]))
                if size > CHUNK_CHARS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)], names)
                    made, size = [], 0
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)], names)

    return ready.mapInArrow(repair, EDITED).join(
        placed.select("chunk", "first_role", "last_role", "first_turn", "last_turn", "n_turns"), "chunk"
    )


def _repaired(row: dict, with_turns: bool) -> tuple:
    codes, roles, texts = row["marks"], row["roles"], row["texts"]
    vectors, gained = solve(codes, tuple(row["start"] or DONE))
    edits, _ = trace(codes, vectors, row["state"] or 0, row["last"])
    new_roles, new_texts, i = [], [], 0
    for letter, state in edits:
        if letter == "I":
            new_roles.append(ROLE_OF[state])
            new_texts.append("")
            continue
        if letter != "D":
            new_roles.append(roles[i] if letter == "K" else ROLE_OF[state])
            new_texts.append(texts[i])
        i += 1
    blank = sum(1 for c in codes if c & BLANK)
    again = sum(1 for c in codes if c & AGAIN and not c & BLANK)
    cut = sum(1 for c in codes if c & CUT and not c & AGAIN)
    illegal = sum(not follows(a, b) for a, b in zip(roles[:-1], roles[1:], strict=True))
    alone = row["first"] and row["last"]
    digest = None
    if alone and not with_turns:
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in zip(new_roles, new_texts, strict=True)).encode()).hexdigest()
        new_roles, new_texts = [], []
    audit = "".join(letter for letter, _ in edits)
    cost = vectors[0][0] if row["first"] else 0
    return row["chunk"], row["conv_id"], alone, blank, again, cut, illegal, cost, gained, audit, new_roles, new_texts, digest


def follows(before: str, after: str) -> bool:
    return before[:1] + after[:1] in ("su", "ua", "au")


REPORT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)


def report(rows: DataFrame, conversations: DataFrame | None = None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row per conversation: its faults, the least cost, the edits and a digest of the repaired turns.

    `conversations` (column conv_id) names conversations to report even if no row of theirs is left.
    """
    found = edited(rows, chunk_rows, with_turns=False)
    columns = [
        "conv_id", "chunk", "blank", "duplicate", "truncated", "illegal", "cost", "gained", "audit", "roles", "texts", "digest",
        "first_role", "last_role", "first_turn", "last_turn", "n_turns",
    ]

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in REPORT.split(", ")]
        types = [*[pa.int64()] * 7, pa.string(), pa.string()]
        whole: _Whole | None = None
        made: list[tuple] = []

        def sent() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)], names)
            made.clear()
            return out

        for batch in batches:
            for row in batch.to_pylist():
                if whole is None or whole.conv_id != row["conv_id"]:
                    if whole is not None:
                        made.append(whole.row())
                    whole = _Whole(row["conv_id"])
                whole.add(row)
                if len(made) >= 5000:
                    yield sent()
        if whole is not None:
            made.append(whole.row())
        if made:
            yield sent()

    ordered = found.select(*columns).repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    result = ordered.mapInArrow(joined, REPORT)
    if conversations is None:
        return result
    ids = conversations.select(F.col("conv_id").cast("long").alias("_id")).distinct()
    nothing = hashlib.sha256(b"").hexdigest()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return ids.join(result, F.col("_id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("_id").alias("conv_id"), *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )


class _Whole:
    """A conversation put together chunk by chunk; its text passes through, only its audit is held."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.counts, self.cost, self.audit = conv_id, [0, 0, 0, 0], 0, []
        self.text, self.digest, self.begun = hashlib.sha256(), None, False
        self.low, self.high, self.turns, self.role = None, None, 0, None

    def add(self, row: dict) -> None:
        for i, name in enumerate(("blank", "duplicate", "truncated", "illegal")):
            self.counts[i] += row[name]
        if self.role is not None and not follows(self.role, row["first_role"]):
            self.counts[3] += 1
        self.role = row["last_role"]
        if row["first_turn"] is not None:
            self.low = row["first_turn"] if self.low is None else self.low
            self.turns += row["n_turns"] - (self.high == row["first_turn"])
            self.high = row["last_turn"]
        self.cost += row["cost"] + row["gained"]
        self.audit.append(row["audit"])
        self.digest = row["digest"]
        if row["roles"]:
            lines = "\n".join(f"{r}:{t}" for r, t in zip(row["roles"], row["texts"], strict=True))
            self.text.update((("\n" if self.begun else "") + lines).encode())
            self.begun = True

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return self.conv_id, gaps, *self.counts, self.cost, "".join(self.audit), self.digest or self.text.hexdigest()
