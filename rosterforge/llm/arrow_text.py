"""Texts of Arrow batches as bytes, and words hashed without a Python loop."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Whitespace between words: tab, line feed, vertical tab, form feed, carriage return, space.
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_ODD = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix): every output bit depends on every input bit."""
    x = x + _ODD
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def unit(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


# One random 64-bit value per byte, so that a word's polynomial has no weak low bits.
_BYTE = mix(np.arange(256, dtype=np.uint64) + np.uint64(1 << 20))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64 and of its inverse, for n positions."""
    known = _POWERS.get("up")
    if known is None or len(known) < n:
        size = max(n, 1 << 16)
        base = 0xD1342543DE82EF95
        for name, factor in (("up", base), ("down", pow(base, -1, 1 << 64))):
            steps = np.full(size, factor, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and where each text begins and ends; null is empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    buffers = column.buffers()
    if len(column) == 0 or buffers[1] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(buffers[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of about `most` bytes; a longer text is a run of its own."""
    n, at = len(offsets) - 1, 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end
        at = end


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word, and how many words each text has; no word crosses a text's end."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets) - 1, np.int64)
    word = ~SPACE[data]
    first = np.zeros(n + 1, dtype=bool)
    first[offsets] = True
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = word[:-1]
    begin = np.flatnonzero(word & (~before | first[:n]))
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = word[1:]
    end = np.flatnonzero(word & (~after | first[1:])) + 1
    return begin, end, np.diff(np.searchsorted(begin, offsets))


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes with A-Z lower-cased."""
    if len(begin) == 0:
        return np.zeros(0, np.uint64)
    out = np.empty(len(begin), np.uint64)
    step, at = 1 << 20, 0
    while at < len(begin):
        # whole words of about one MB at a time keep the working set in the cache
        to = max(at + 1, int(np.searchsorted(begin, begin[at] + step)))
        low, high = int(begin[at]), int(end[to - 1])
        up, down = _powers(high - low)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_BYTE[LOWER[data[low:high]]] * up, out=sums[1:])
        b, e = begin[at:to] - low, end[at:to] - low
        out[at:to] = mix((sums[e] - sums[b]) * down[b] + (e - b).astype(np.uint64))
        at = to
    return out
