"""Words and hashes of many texts at once, as numpy arrays over Arrow buffers.

A word is `[^\\x20\\x09-\\x0D]+`. Hashes are polynomial over 64 bits with a final mix; the window of any
length is one difference of prefix sums, so its cost does not depend on the length.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

#: Texts are taken in slices of about so many bytes; one longer text is a slice of its own.
SLICE_BYTES = 1 << 21
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


@cache
def _byte_values() -> np.ndarray:
    return np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, SLICE_BYTES + (SLICE_BYTES >> 2))
        for name, base in (("up", BASE), ("down", INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps)
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finish of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    up, _ = _powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = _powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


def window_hashes(values: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of `length` consecutive values."""
    n = len(values) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = prefix_sums(values)
    _, down = _powers(len(sums))
    return mix((sums[length:] - sums[:n]) * down[:n])


class Texts:
    """Bytes of a slice of texts, end to end; `offsets` has one entry more than there are texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end byte of each word, and the text it is in."""
        n = len(self.data)
        inside = ~((self.data == 32) | ((self.data >= 9) & (self.data <= 13)))
        edge = np.zeros(n + 1, bool)
        edge[self.offsets] = True
        first = inside.copy()
        first[1:] &= ~inside[:-1] | edge[1:n]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | edge[1:n]
        starts = np.flatnonzero(first)
        return starts, np.flatnonzero(last) + 1, np.searchsorted(self.offsets, starts, "right") - 1

    def word_hashes(self, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
        data = self.data
        if lower:
            data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
        return range_hashes(prefix_sums(_byte_values()[data]), starts, ends)

    def byte_values(self) -> np.ndarray:
        return _byte_values()[self.data]

    def text_bytes(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


def texts_of(array: pa.Array) -> Texts:
    """Bytes and offsets of a string or binary array; null is empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null("" if pa.types.is_string(array.type) or pa.types.is_large_string(array.type) else b"")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, ends, data = array.buffers()
    kind = np.int64 if wide else np.int32
    if len(array) == 0 or ends is None:
        return Texts(np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64))
    offsets = np.frombuffer(ends, kind)[array.offset: array.offset + len(array) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(raw[offsets[0]:offsets[-1]], offsets - offsets[0])


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Record batches cut so that each has about `limit` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = texts_of(batch.column(column))
        cuts = sizes.offsets
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(cuts, cuts[at] + limit, "right")) - 1)
            part = batch.slice(at, to - at)
            yield part, texts_of(part.column(column))
            at = to


def sliding_minimum(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` consecutive keys, by doubling."""
    if len(keys) < width:
        return keys[:0]
    size = 1
    while size * 2 <= width:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    rest = width - size
    return np.minimum(keys[: len(keys) - rest], keys[rest:]) if rest else keys
