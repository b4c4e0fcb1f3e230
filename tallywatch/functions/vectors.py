"""Sparse vectors of whole Arrow columns as numpy arrays, without a Python value per text or term."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

RUN_BYTES = 4 << 20
RUN_VALUES = 1 << 19
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_FACTOR = np.uint64(0x9E3779B1)


def text_runs(column: pa.Array, run_bytes: int = RUN_BYTES) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Some rows of a string column at a time: which, their bytes, and where each begins and ends; NULL is an empty text.

    A run has about `run_bytes` bytes; one longer text is a run of its own.
    """
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < len(column):
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + run_bytes, "right")) - 1)
        yield slice(at, stop), data[offsets[at] : offsets[stop]], offsets[at : stop + 1] - offsets[at]
        at = stop


def list_runs(batches: Iterator[pa.RecordBatch], column: str, values: int = RUN_VALUES) -> Iterator[pa.RecordBatch]:
    """The batches' rows, some at a time: with about so many values in a list column; one longer list is a run of its own."""
    for batch in batches:
        ends = np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(batch.column(column)), 0)).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + values, "right")))
            yield batch.slice(at, stop - at)
            at = stop
        pa.default_memory_pool().release_unused()  # a reused worker would keep what its largest batch took


def counted(row: np.ndarray, place: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, place) in order and how often each occurs."""
    keys, counts = np.unique(row * size + place, return_counts=True)
    return keys // size, keys % size, counts


def gram_counts(data: np.ndarray, offsets: np.ndarray, gram: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, count) of the hashed byte n-grams of texts, A-Z lower-cased; none reaches over a text's end."""
    n = len(data) - gram + 1
    if n <= 0:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    low = _LOWER[data]
    code = np.zeros(n, dtype=np.uint64)
    for k in range(gram):
        code = (code ^ low[k : k + n]) * _FACTOR
        code ^= code >> np.uint64(29)
    row = np.searchsorted(offsets, np.arange(len(data)), "right") - 1
    whole = row[:n] == row[gram - 1 :]
    return counted(row[:n][whole], (code[whole] % np.uint64(buckets)).astype(np.int64), buckets)


def term_counts(terms: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place in the vocabulary, count) of a list column of terms; terms that are not in the vocabulary are left out."""
    sizes = np.asarray(pc.fill_null(pc.list_value_length(terms), 0)).astype(np.int64)
    place = pc.index_in(terms.flatten(), value_set=vocabulary)
    known = np.asarray(place.is_valid())
    row = np.repeat(np.arange(len(sizes)), sizes)[known]
    return counted(row, np.asarray(place.fill_null(0))[known].astype(np.int64), max(len(vocabulary), 1))


def lower_cased(texts: pa.Array) -> pa.Array:
    """Texts in lower case as Spark has them; bytes that are no UTF-8 are replaced as it does, NULL is an empty text."""
    given = pc.fill_null(texts, "").cast(pa.large_binary())
    return pa.array([text.decode("utf-8", "replace").lower() for text in given.to_pylist()], pa.large_string())


def characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the characters beyond ASCII begin in UTF-8 bytes, and their code points."""
    at = np.flatnonzero(data >= 0xC0)
    b = [data[np.minimum(at + k, len(data) - 1)].astype(np.int32) & 0x3F for k in range(4)]
    two = ((b[0] & 0x1F) << 6) | b[1]
    three = ((b[0] & 0x0F) << 12) | (b[1] << 6) | b[2]
    four = ((b[0] & 0x07) << 18) | (b[1] << 12) | (b[2] << 6) | b[3]
    lead = data[at]
    return at, np.minimum(np.where(lead < 0xE0, two, np.where(lead < 0xF0, three, four)), 0x10FFFF)


def of_kind(data: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 texts belong to characters that `kind` marks by code point."""
    ascii_kind = np.zeros(256, dtype=bool)
    ascii_kind[:128] = kind[:128]
    found = ascii_kind[data]
    at, point = characters(data)
    at = at[kind[point]]
    for k in range(4):  # a character's first byte and those that continue it
        found[at] = True
        at = at[at + 1 < len(data)] + 1
        at = at[(data[at] & 0xC0) == 0x80]
    return found


def runs_of(marked: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Beginnings and ends of the runs of marked bytes; none reaches over a text's end."""
    first = np.ones(len(marked) + 1, dtype=bool)
    first[1:-1] = ~marked[:-1]
    first[offsets] = True
    last = np.ones(len(marked) + 1, dtype=bool)
    last[1:-1] = ~marked[1:]
    last[offsets] = True
    return np.flatnonzero(marked & first[:-1]), np.flatnonzero(marked & last[1:]) + 1


def long_runs(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray, least: int) -> tuple[pa.Array, np.ndarray]:
    """Runs of at least so many characters that `kind` marks, with the number of the text each is in."""
    marked = of_kind(data, kind)
    begin, end = runs_of(marked, offsets)
    size = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    kept = size[end] - size[begin] >= least
    begin, end = begin[kept], end[kept]
    edge = np.zeros(len(data) + 1, dtype=np.int8)
    edge[begin] += 1
    edge[end] -= 1
    inside = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    starts = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(starts), pa.py_buffer(np.ascontiguousarray(data[inside])))
    return words, np.searchsorted(offsets, begin, "right") - 1


def unit_length(row: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Values scaled so that those of each of `n` rows have length 1."""
    norm = np.sqrt(np.bincount(row, values * values, minlength=n))
    return values / norm[row]


def lists(row: np.ndarray, values: np.ndarray, n: int) -> pa.Array:
    """Values in row order as one list per row."""
    offsets = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of all values of a list column."""
    sizes = np.asarray(pc.list_value_length(column)).astype(np.int64)
    return np.repeat(np.arange(len(sizes)), sizes), np.asarray(column.flatten())
