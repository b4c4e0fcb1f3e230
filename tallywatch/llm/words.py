"""Words of whole Arrow text columns as numpy arrays, without a Python string per word.

A word is a run of bytes that are not ASCII white space (`[^\\x20\\x09-\\x0D]+` of the text). Texts are taken in runs of
rows of some megabytes (one longer text is a run of its own), so the arrays stay small whatever the batch holds; word
hashes are made from byte blocks cut at white space.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

RUN_BYTES = 2 << 20
BLOCK_BYTES = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
NO_TERM = np.ones(256, dtype=bool)  # all but ASCII digits and letters and the bytes of other characters
NO_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finalising step of the SplitMix generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = _powers(_BASE, BLOCK_BYTES + 1)
_DOWN = _powers(_INVERSE, BLOCK_BYTES + 1)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end) of `data`; spans are in order and do not overlap."""
    out = np.empty(len(start), dtype=np.uint64)
    done = 0
    while done < len(start):
        low = start[done]
        if end[done] - low > BLOCK_BYTES:  # a span longer than a block: hashed piece by piece
            value = np.uint64(0)
            for at in range(low, end[done], BLOCK_BYTES):
                part = data[at : min(at + BLOCK_BYTES, end[done])].astype(np.uint64) + np.uint64(1)
                value = mix(np.array([value]))[0] + (part * _UP[: len(part)]).sum(dtype=np.uint64)
            out[done] = value
            done += 1
            continue
        stop = int(np.searchsorted(end, low + BLOCK_BYTES, "right"))
        block = data[low : end[stop - 1]].astype(np.uint64)
        block += np.uint64(1)
        block *= _UP[: len(block)]
        sums = np.zeros(len(block) + 1, dtype=np.uint64)
        np.cumsum(block, out=sums[1:])
        first, last = start[done:stop] - low, end[done:stop] - low
        out[done:stop] = (sums[last] - sums[first]) * _DOWN[first]
        done = stop
    return mix(out)


@dataclass
class Run:
    """Some rows of a text column: their bytes, and where each row begins and ends in them."""

    rows: slice
    data: np.ndarray
    offsets: np.ndarray  # one more than there are rows

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def words(self, data: np.ndarray | None = None, outside: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte positions where words (runs of bytes not in `outside`) begin and end, and the row each belongs to, in order."""
        data = self.data if data is None else data
        if not len(data):
            none = np.zeros(0, dtype=np.int64)
            return none, none, none
        inside = ~outside[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[self.offsets] = True
        before = np.zeros(len(data), dtype=bool)
        before[1:] = inside[:-1]
        begins = inside & (~before | edge[:-1])
        after = np.zeros(len(data), dtype=bool)
        after[:-1] = inside[1:]
        ends = inside & (~after | edge[1:])
        start = np.flatnonzero(begins)
        return start, np.flatnonzero(ends) + 1, np.searchsorted(self.offsets, start, "right") - 1

    def terms(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the lower-cased runs of ASCII letters, digits and other characters, and the row of each, in order."""
        data = LOWER[self.data]
        start, end, row = self.words(data, NO_TERM)
        return span_hashes(data, start, end), row

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """Number of set flags among the bytes of each row."""
        sums = np.zeros(len(flags) + 1, dtype=np.int64)
        np.cumsum(flags, out=sums[1:])
        return np.diff(sums[self.offsets])


def runs(column: pa.Array | pa.ChunkedArray, run_bytes: int = RUN_BYTES) -> Iterator[Run]:
    """The rows of a string column in order; NULL counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < len(column):
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + run_bytes, "right")) - 1)
        stop = min(stop, len(column))
        yield Run(slice(at, stop), data[offsets[at] : offsets[stop]], offsets[at : stop + 1] - offsets[at])
        at = stop
    pa.default_memory_pool().release_unused()  # a reused worker would keep what its largest batch took


def windows(values: np.ndarray, row: np.ndarray, width: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every `width` neighbouring values of the same row, and the position each window begins at."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    at = np.flatnonzero(row[:n] == row[width - 1 :])
    out = np.full(n, np.uint64(seed), dtype=np.uint64)
    for k in range(width):
        out = mix(out * np.uint64(3) + values[k : k + n])
    return out[at], at
