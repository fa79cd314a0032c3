"""Byte strings that repeat anywhere in the corpus, as maximal groups with all their occurrences, and texts without them.

Every string of `min_bytes` bytes that starts at two places, in one document or
in two, is found; matches never cross documents.  Each byte it covers, at every
one of its places, can be removed.

Method: an enhanced suffix array, built in shards, whose common-prefix interval
tree is walked with a stack.  Two suffixes that share `min_bytes` bytes share
the least hash of all `K`-grams in those bytes (leftmost where equal), so a
suffix belongs to the shard of that anchor, and a shard needs no more text than
the anchors' contexts: from the first to the last start that picked the anchor,
and `min_bytes` on.  Equal contexts are one, with a count.

  1. One scan lists the anchors with a digest of their context.  Anchors seen
     once are gone; where all contexts of an anchor are equal, everything in it
     repeats and the context itself is the group.
  2. Of the other anchors one context of each kind goes to the anchor's shard.
     There the suffixes are ordered by what lies left of the anchor, then by
     the rank of what lies right of it: two short sorts give order and common
     prefixes of all suffixes.  A stack scan yields the intervals; an interval
     whose suffixes differ in the byte to the left (a document's beginning
     differs from everything), or that begins where the context begins, is a
     group with all its occurrences.
  3. A shard with more than `most_contexts` kinds is not gathered: its starts
     are split into blocks, which meet by the digest of the bytes that all
     strings of a block hold; blocks that still differ meet string by string.
     These are aggregates over digests, so a passage in a third of all
     documents costs rows, not a task's memory.

Groups are followed to the end of the anchor's context; a longer repeat goes on
in the group of the next anchor, and their union covers it.

Defined cases: null text is empty; texts below `min_bytes` bytes hold nothing; a
repeated row repeats every string of its text; a null doc_id stays null; other
columns are not read; an empty table gives an empty result.  A text is held
whole in its task, its hashes piece by piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.llm.arrow_text import _BYTE, _powers, column_bytes, mix, slices
from rosterforge.session import durable, durable_path, ship_package

MIN_BYTES = 400
MOST_CONTEXTS = 256
BLOCK = 24
STEP = 1 << 20
START, MANY = -1, 256  # the byte to the left: none at a document's beginning; several among equal contexts


def gram(min_bytes: int) -> int:
    """Length of the hashed grams: long enough that only repeated text has equal ones."""
    return min(64, (min_bytes + 1) // 2)


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of the k bytes from every place on."""
    up, down = _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up, out=sums[1:])
    return mix((sums[k:] - sums[:-k]) * down[: len(data) - k + 1])


def anchors(data: np.ndarray, offsets: np.ndarray, min_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last start that pick an anchor, the anchor's place, and its hash; starts are those of whole strings."""
    k = gram(min_bytes)
    width = min_bytes - k + 1
    bits = np.uint64((width - 1).bit_length())
    low = np.uint64((1 << int(bits)) - 1)
    found: list[tuple[np.ndarray, ...]] = []
    for begin in range(0, len(data), STEP):
        piece = data[begin : begin + STEP + width + k - 2]
        if len(piece) < min_bytes:
            break
        hashes = gram_hashes(piece, k)
        n = len(hashes) - width + 1
        blocks = -(-len(hashes) // width)
        keyed = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
        keyed[: len(hashes)] = hashes & ~low
        keyed = keyed.reshape(blocks, width)
        keyed |= np.arange(width, dtype=np.uint64)
        # least of a window: of the rest of its first block and of the beginning of its second
        first = np.minimum.accumulate(keyed[:, ::-1], axis=1)[:, ::-1].ravel()[:n]
        second = np.minimum.accumulate(keyed, axis=1).ravel()[width - 1 : width - 1 + n]
        at = np.arange(n)
        place = np.where(
            (first >> bits) <= (second >> bits),
            at // width * width + (first & low).astype(np.int64),
            (at + width - 1) // width * width + (second & low).astype(np.int64),
        )
        whole = np.ones(n, bool)
        for end in offsets[np.searchsorted(offsets, begin) : np.searchsorted(offsets, begin + n + min_bytes)].tolist():
            whole[max(end - min_bytes + 1 - begin, 0) : max(end - begin, 0)] = False
        kept = np.flatnonzero(whole)
        if len(kept) == 0:
            continue
        ends = np.flatnonzero((np.diff(place[kept]) != 0) | (np.diff(kept) != 1))
        lo, hi = kept[np.concatenate([[0], ends + 1])], kept[np.concatenate([ends, [len(kept) - 1]])]
        found.append((lo + begin, hi + begin, place[lo] + begin, hashes[place[lo]]))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    lo, hi, place, hashes = (np.concatenate(x) for x in zip(*found, strict=True))
    # an anchor picked on both sides of a piece's end
    new = np.concatenate([[True], (place[1:] != place[:-1]) | (lo[1:] != hi[:-1] + 1)])
    return lo[new], hi[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(hi) - 1]])], place[new], hashes[new]


KEY = ["doc", "text_hash"]
ANCHORS = "doc long, text_hash long, lo int, span int, rel int, left int, h long, c long"


def _keyed(docs: DataFrame, *more: str) -> DataFrame:
    """Rows by id and text; rows equal in both are told apart by nothing, and need not be."""
    return docs.select(
        *more, F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc"),
        F.xxhash64(F.col("text"), F.col("doc_id").isNull()).alias("text_hash"), F.coalesce("text", F.lit("")).alias("text"),
    )


def _anchors(docs: DataFrame, min_bytes: int) -> DataFrame:
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column(2))
            for a, b in slices(offsets, STEP):
                own, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                lo, hi, place, hashes = anchors(own, at, min_bytes)
                doc = np.searchsorted(at, lo, side="right") - 1
                left = own[np.maximum(lo - 1, 0)].astype(np.int32)
                left[lo == at[doc]] = START
                text, rel = own.tobytes(), place - lo
                digests = [
                    int.from_bytes(hashlib.blake2b(text[x : y + min_bytes], digest_size=8, salt=z.to_bytes(8, "little")).digest(), "little", signed=True)
                    for x, y, z in zip(lo.tolist(), hi.tolist(), rel.tolist(), strict=True)
                ]
                rows = pa.array(doc + a)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows), batch.column(1).take(rows), pa.array((lo - at[doc]).astype(np.int32)),
                        pa.array((hi - lo).astype(np.int32)), pa.array(rel.astype(np.int32)), pa.array(left),
                        pa.array(hashes.view(np.int64)), pa.array(digests, pa.int64()),
                    ],
                    ["doc", "text_hash", "lo", "span", "rel", "left", "h", "c"],
                )

    path = durable_path(docs.sparkSession, "repeat-anchors")
    long_enough = _keyed(docs).where(F.octet_length("text") >= min_bytes)
    long_enough.mapInArrow(listed, ANCHORS).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(ANCHORS).parquet(path)


def _repeated(docs: DataFrame, min_bytes: int) -> DataFrame:
    """Anchors seen twice or more; `n`: places with this context, `mixed`: the anchor has other contexts too, `sent`: the place that stands for its context."""
    every = _anchors(docs, min_bytes)
    seen = every.groupBy("h").agg(F.count("*").alias("_n"), F.min("c").alias("_low"), F.max("c").alias("_high")).where("_n > 1")
    # written, so that each join reads both sides from shuffles of their own, which Spark can split at a hot key
    seen = durable(seen.selectExpr("h", "_low <> _high AS mixed"), "repeat-seen")
    rows = durable(every.join(seen, "h"), "repeat-places")
    who = F.xxhash64("doc", "text_hash", "lo")
    kinds = rows.groupBy("h", "c").agg(
        F.count("*").alias("n"), F.min(who).alias("_who"), F.min("left").alias("_low"), F.max("left").alias("_high")
    )
    # two documents' beginnings differ
    side = F.when((F.col("n") > 1) & ((F.col("_low") < F.col("_high")) | (F.col("_low") == START)), MANY).otherwise(F.col("_low"))
    kinds = durable(kinds.select("h", "c", "n", "_who", side.alias("_side")), "repeat-kinds")
    return rows.join(kinds, ["h", "c"]).select(
        *KEY, "lo", "span", "rel", F.col("_side").alias("left"), "h", "c", "n", "mixed",
        (F.col("mixed") & (who == F.col("_who"))).alias("sent"),
    )


SHARED = (
    "kind int, doc_id long, doc long, text_hash long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
    "text binary, spans array<long>, lo int, span int, rel int, left int, h long, c long, n long"
)


def merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of [begin, end)."""
    if len(begin) == 0:
        return begin, end
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], begin[1:] > reach[:-1]])
    return begin[new], reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(reach) - 1]])]


def _without(text: bytes, begin: np.ndarray, end: np.ndarray) -> bytes:
    if len(begin) == 0:
        return text
    bounds = np.concatenate([[0], np.column_stack([begin, end]).ravel(), [len(text)]]).tolist()
    return b"".join(text[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True))


def _shared(docs: DataFrame, repeated: DataFrame, min_bytes: int) -> DataFrame:
    """Texts meet their anchors once: 0 documents that are settled, 1 documents that wait for shards, 2 contexts for the shards."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        size = 0
        for batch in batches:
            data, offsets = column_bytes(batch.column(3))
            ids, docs_, hashes, at = (*(batch.column(i).to_pylist() for i in range(3)), offsets.tolist())
            for i in range(len(batch)):
                text = data[at[i] : at[i + 1]].tobytes()
                places = batch.column(4)[i].as_py() or []
                known = [(p["lo"], p["lo"] + p["span"] + min_bytes) for p in places if p["n"] > 1]
                begin, end = merged(*(np.array([k[j] for k in known], np.int64) for j in (0, 1)))
                nothing = (None,) * 7
                if any(p["mixed"] and p["n"] == 1 for p in places):
                    spans = np.column_stack([begin, end]).ravel().tolist()
                    made.append((1, ids[i], docs_[i], hashes[i], None, None, None, None, text, spans, *nothing))
                    size += len(text)
                else:
                    left = _without(text, begin, end)
                    made.append((
                        0, ids[i], None, None, len(text), len(text) - len(left), len(begin), hashlib.sha256(left).hexdigest(),
                        None, None, *nothing,
                    ))
                for p in places:
                    if p["sent"]:
                        context = text[p["lo"] : p["lo"] + p["span"] + min_bytes]
                        made.append((
                            2, ids[i], docs_[i], hashes[i], None, None, None, None, context, None,
                            *(p[x] for x in ("lo", "span", "rel", "left", "h", "c", "n")),
                        ))
                        size += len(context)
                if size > 4 << 20 or len(made) > 5000:
                    yield from _rows(made, SHARED)
                    made, size = [], 0
        yield from _rows(made, SHARED)

    place = F.struct("lo", "span", "rel", "left", "h", "c", "n", "mixed", "sent")
    lists = durable(repeated.groupBy(*KEY).agg(F.collect_list(place).alias("places")), "repeat-lists")
    met = _keyed(docs, "doc_id").join(lists, KEY, "left").select(F.col("doc_id").cast("long"), *KEY, "text", "places")
    path = durable_path(docs.sparkSession, "repeat-texts")
    met.mapInArrow(split, SHARED).write.option("compression", "zstd").partitionBy("kind").parquet(path)
    return docs.sparkSession.read.schema(SHARED).parquet(path)


def _common(parts: list[bytes], order: list[int]) -> np.ndarray:
    """Length of the common beginning of each part and the one before it in this order."""
    sizes = np.array([len(parts[i]) for i in order])
    width = int(sizes.max()) + 1
    table = np.frombuffer(b"".join(parts[i].ljust(width, b"\0") for i in order), np.uint8).reshape(len(order), width)
    out = np.zeros(len(order), np.int64)
    differ = table[1:] != table[:-1]
    differ[:, -1] = True
    out[1:] = np.minimum(differ.argmax(axis=1), np.minimum(sizes[1:], sizes[:-1]))
    return out


class Suffixes:
    """The suffixes of a shard's contexts in order, with common prefixes: those of at least `min_bytes` bytes only."""

    def __init__(self, texts: list[bytes], rel: list[int], span: list[int], left: list[int], counts: list[int], min_bytes: int) -> None:
        m = len(texts)
        behind = [t[r:] for t, r in zip(texts, rel, strict=True)]
        ahead = [t[:r][::-1] for t, r in zip(texts, rel, strict=True)]
        by_right = sorted(range(m), key=behind.__getitem__)
        by_left = sorted(range(m), key=ahead.__getitem__)
        right, before = _common(behind, by_right), _common(ahead, by_left)
        rank = np.empty(m, np.int64)
        rank[by_right] = np.arange(m)
        rel_, span_ = np.array(rel), np.array(span)
        # every start, by its distance to the anchor
        owner = np.repeat(np.arange(m), span_ + 1)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(span_ + 1) - span_ - 1, span_ + 1)
        depth = rel_[owner] - at
        # contexts that are equal over this distance to the left of the anchor are one class
        classes = np.empty((m, int(depth.max()) + 1), np.int64)
        classes[by_left] = np.cumsum(before[:, None] < np.arange(classes.shape[1])[None, :], axis=0)
        order = np.lexsort((rank[owner], classes[owner, depth], depth))
        owner, at, depth = owner[order], at[order], depth[order]
        kind, ranks = classes[owner, depth], rank[owner]
        same = np.concatenate([[False], (depth[1:] == depth[:-1]) & (kind[1:] == kind[:-1])])
        prefix = np.zeros(len(owner), np.int64)
        if same.any():
            low, high = ranks[np.flatnonzero(same) - 1] + 1, ranks[same] + 1
            prefix[same] = depth[same] + _least(right, low, high)
        prefix[prefix < min_bytes] = 0
        sides = np.array(left)[owner]
        inner = at > 0
        texts_at = np.cumsum([0] + [len(t) for t in texts])
        joined = np.frombuffer(b"".join(texts), np.uint8)
        sides[inner] = joined[texts_at[owner[inner]] + at[inner] - 1]
        self.owner, self.at, self.prefix, self.sides = owner, at, prefix, sides
        # how often the byte to the left changes, or is of a kind that differs from all, up to each suffix
        odd = (sides == START) | (sides == MANY)
        self.odd = np.concatenate([[0], np.cumsum(odd)])
        self.changes = np.concatenate([[0], np.cumsum(np.concatenate([[False], sides[1:] != sides[:-1]]))])

    def diverse(self, low: int, high: int) -> bool:
        """The suffixes low..high are preceded by different bytes, or begin where their context does."""
        return (
            self.odd[high + 1] > self.odd[low] or self.changes[high + 1] > self.changes[low + 1] or bool((self.at[low : high + 1] == 0).any())
        )

    def groups(self) -> Iterator[tuple[int, int, int]]:
        """Length, first and last suffix of every maximal group: a stack scan of the common-prefix intervals."""
        prefix = self.prefix
        ends = np.flatnonzero(prefix == 0).tolist() + [len(prefix)]
        for first, end in zip(ends[:-1], ends[1:], strict=True):
            # an interval within one that is not diverse is not diverse either
            if end - first < 2 or not self.diverse(first, end - 1):
                continue
            stack: list[tuple[int, int]] = []
            for i in [*range(first + 1, end), end]:
                length, begin = (int(prefix[i]) if i < end else 0), i - 1
                while stack and stack[-1][0] > length:
                    known, begin = stack.pop()
                    if self.diverse(begin, i - 1):
                        yield known, begin, i - 1
                if length and (not stack or stack[-1][0] < length):
                    stack.append((length, begin))


def _least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least of values[low:high] for many ranges, none empty."""
    table = [values]
    while 2 << (len(table) - 1) <= len(values):
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    out = np.empty(len(low), values.dtype)
    level = np.frexp((high - low).astype(np.float64))[1] - 1
    for k in np.unique(level).tolist():
        own = level == k
        out[own] = np.minimum(table[k][low[own]], table[k][high[own] - (1 << k)])
    return out


MEMBERS = "grp string, n_bytes int, h long, c long, n long, doc long, text_hash long, lo int, at int"


def _members(contexts: DataFrame, min_bytes: int, most_contexts: int, spans_only: bool) -> DataFrame:
    """Groups of the mixed anchors as rows, one per context in a group.

    With `spans_only` the groups of a context that stands for one place are
    united, and contexts of several places, which repeat anyway, are left out.
    """
    sizes = contexts.groupBy("h").count()
    hot = durable(sizes.where(F.col("count") > most_contexts).select("h"), "repeat-hot")

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        shard: dict[int, dict] = {}
        anchor = None

        def walk() -> None:
            own = list(shard.values())
            if not own:
                return
            found = Suffixes(*([x[f] for x in own] for f in ("text", "rel", "span", "left", "n")), min_bytes)
            spans: dict[int, list[tuple[int, int]]] = {}
            # a context of several places is a group by itself, unless others hold all of it too
            alone = {i for i, x in enumerate(own) if x["n"] > 1}
            for number, (length, low, high) in enumerate(found.groups()):
                for owner, at in zip(found.owner[low : high + 1].tolist(), found.at[low : high + 1].tolist(), strict=True):
                    if spans_only:
                        spans.setdefault(owner, []).append((at, at + length))
                    else:
                        rows.append(_member(f"{anchor:x}-{number}", length, own[owner], at))
                        if length == len(own[owner]["text"]):
                            alone.discard(owner)
            if not spans_only:
                rows.extend(_member(f"{anchor:x}-c{i}", len(own[i]["text"]), own[i], 0) for i in sorted(alone))
            for owner, some in spans.items():
                if own[owner]["n"] == 1:
                    for a, b in zip(*(x.tolist() for x in merged(*np.array(some, np.int64).T)), strict=True):
                        rows.append(_member("", b - a, own[owner], a))

        for batch in batches:
            for row in batch.to_pylist():
                if row["h"] != anchor:
                    walk()
                    shard, anchor = {}, row["h"]
                    if len(rows) > 5000:
                        yield from _rows(rows, MEMBERS)
                        rows.clear()
                shard[row["c"]] = row
        walk()
        yield from _rows(rows, MEMBERS)

    columns = ["h", "c", "n", "left", "rel", "span", "text", *KEY, "lo"]
    small = contexts.select(*columns).join(hot, "h", "left_anti")
    cold = small.repartition("h").sortWithinPartitions("h").mapInArrow(walked, MEMBERS)
    return cold.unionByName(_hot_members(contexts.select(*columns).join(hot, "h", "left_semi"), min_bytes))


def _member(grp: str, length: int, context: dict, at: int) -> tuple:
    return (grp, length, *(context[f] for f in ("h", "c", "n", "doc", "text_hash", "lo")), at)


BLOCKS = "h long, c long, n long, doc long, text_hash long, lo int, at int, wide int, core binary, whole long"
STRINGS = "h long, c long, n long, doc long, text_hash long, lo int, at int, string binary"


def _hot_members(contexts: DataFrame, min_bytes: int) -> DataFrame:
    """The same for anchors with very many contexts: groups of blocks that are equal throughout, and of single strings."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x in batch.to_pylist():
                text, rel = x["text"], x["rel"]
                # starts by their distance to the anchor, in blocks that lie alike in all contexts
                low, high = rel - x["span"], rel
                for number in range(low // BLOCK, high // BLOCK + 1):
                    # what every string of the block holds, whether or not this context has all its starts
                    core = text[rel - number * BLOCK : rel - number * BLOCK - BLOCK + 1 + min_bytes]
                    near, far = max(low, number * BLOCK), min(high, number * BLOCK + BLOCK - 1)
                    own = text[rel - far : rel - near + min_bytes]
                    key = hashlib.blake2b(core, digest_size=16, salt=_salt(x["h"], number)).digest()
                    whole = int.from_bytes(hashlib.blake2b(own, digest_size=8, salt=_salt(near, far)).digest(), "little", signed=True)
                    rows.append((*(x[f] for f in ("h", "c", "n", "doc", "text_hash", "lo")), rel - far, far - near, key, whole))
            yield from _rows(rows, BLOCKS)

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x in batch.to_pylist():
                for part in x["parts"]:
                    for at in range(part["at"], part["at"] + part["wide"] + 1):
                        string = hashlib.blake2b(x["text"][at : at + min_bytes], digest_size=16).digest()
                        rows.append((*(x[f] for f in ("h", "c", "n", "doc", "text_hash", "lo")), at, string))
            yield from _rows(rows, STRINGS)

    blocks = durable(contexts.mapInArrow(cut, BLOCKS), "repeat-blocks")
    met = blocks.groupBy("core").agg(F.sum("n").alias("_n"), F.min("whole").alias("_low"), F.max("whole").alias("_high"))
    found = blocks.join(durable(met.where("_n > 1").selectExpr("core", "_low = _high AS alike"), "repeat-cores"), "core")
    parts = found.where("NOT alike").groupBy("h", "c").agg(F.collect_list(F.struct("at", "wide")).alias("parts"))
    single = durable(contexts.join(parts, ["h", "c"]).mapInArrow(strings, STRINGS), "repeat-strings")
    often = durable(single.groupBy("string").agg(F.sum("n").alias("_n")).where("_n > 1").select("string"), "repeat-often")
    names = ["h", "c", "n", "doc", "text_hash", "lo", "at"]
    whole = found.where("alike").select(F.hex("core").alias("grp"), (F.col("wide") + min_bytes).alias("n_bytes"), *names)
    alone = single.join(often, "string").select(F.hex("string").alias("grp"), F.lit(min_bytes).alias("n_bytes"), *names)
    return whole.unionByName(alone)


def _salt(a: int, b: int) -> bytes:
    return a.to_bytes(8, "little", signed=True) + b.to_bytes(8, "little", signed=True)


def _rows(rows: list[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}
    fields = [f.split() for f in schema.split(", ")]
    for a in range(0, len(rows), 5000):
        columns = zip(*rows[a : a + 5000], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def removed(docs: DataFrame, min_bytes: int = MIN_BYTES, most_contexts: int = MOST_CONTEXTS) -> DataFrame:
    """Per document what is left without the bytes of repeated strings, as a digest.

    `doc_id, n_bytes, n_removed, n_spans` (maximal removed runs) and `kept_sha256`.
    """
    ship_package(docs.sparkSession)
    shared = _shared(docs, _repeated(docs, min_bytes), min_bytes)
    contexts = shared.where("kind = 2").drop("kind")
    members = _members(contexts, min_bytes, most_contexts, spans_only=True).where("n = 1")
    spans = members.groupBy(*KEY).agg(F.collect_list(F.struct((F.col("lo") + F.col("at")).alias("begin"), "n_bytes")).alias("found"))

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i in range(len(batch)):
                doc_id, text, known, found = (batch.column(j)[i].as_py() for j in range(4))
                known = np.array(known, np.int64).reshape(-1, 2)
                more = np.array([(f["begin"], f["begin"] + f["n_bytes"]) for f in found or ()], np.int64).reshape(-1, 2)
                begin, end = merged(*np.concatenate([known, more]).T)
                left = _without(text, begin, end)
                rows.append((doc_id, len(text), len(text) - len(left), len(begin), hashlib.sha256(left).hexdigest()))
            yield from _rows(rows, DIGESTS)

    waiting = shared.where("kind = 1").select("doc_id", *KEY, "text", "spans").join(spans, KEY, "left")
    settled = shared.where("kind = 0").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return settled.unionByName(waiting.select("doc_id", "text", "spans", "found").mapInArrow(finished, DIGESTS))


DIGESTS = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def groups(docs: DataFrame, min_bytes: int = MIN_BYTES, most_contexts: int = MOST_CONTEXTS) -> DataFrame:
    """Every group with all its occurrences: `grp, n_bytes, doc_id, start`; `grp` names a string, `start` counts bytes."""
    ship_package(docs.sparkSession)
    places = durable(_repeated(docs, min_bytes), "repeat-kinds")
    contexts = _shared(docs, places, min_bytes).where("kind = 2").drop("kind")
    # the only context of its anchor
    whole = places.where("NOT mixed").select(
        F.concat_ws("-", F.hex("h"), F.hex("c")).alias("grp"), (F.col("span") + min_bytes).alias("n_bytes"), *KEY, F.col("lo").alias("start")
    )
    members = _members(contexts, min_bytes, most_contexts, spans_only=False).select("grp", "n_bytes", "h", "c", "at")
    parts = members.join(places.select(*KEY, "lo", "h", "c"), ["h", "c"]).select(
        "grp", "n_bytes", *KEY, (F.col("lo") + F.col("at")).alias("start")
    )
    names = _keyed(docs, "doc_id").select("doc_id", *KEY).distinct()
    return whole.unionByName(parts).join(names, KEY).select("grp", "n_bytes", "doc_id", "start")
