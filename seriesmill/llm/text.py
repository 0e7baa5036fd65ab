"""Texts as byte arrays: blocks of Arrow batches, words, lines and their hashes.

Everything works on one bounded block of rows at a time.  A block holds at
most ``limit`` bytes of text, or one row where that row alone is longer.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 512 << 10
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all rows, n + 1 offsets); a null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows again, cut into batches of at most ``limit`` bytes of text.

    At the end, what has been freed goes back to the system: a worker stays for the
    next task, which may belong to another step.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        start, before = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start, before = stop, int(ends[stop - 1])
    pa.default_memory_pool().release_unused()
    trim()


def trim() -> None:
    """Let the C library give back free memory, where it can."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=4)
def _powers(size: int, base: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(length: int, base: int = _BASE) -> np.ndarray:
    size = 1 << max(16, int(length - 1).bit_length())
    return _powers(size, base)[:length]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every ``data[start:end]``, equal for equal bytes wherever they lie."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data)), out=total[1:])
    back = powers(len(data) + 1, pow(_BASE, -1, 1 << 64))
    lengths = (ends - starts).astype(np.uint64)
    return mixed((total[ends] - total[starts]) * back[starts] + lengths * np.uint64(0xD6E8FEB86659FD93))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word ``[^\\x20\\x09-\\x0D]+``; words never cross rows."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = inside & np.concatenate([[True], ~inside[:-1]])
    first |= inside & edge[:-1]
    last = inside & np.concatenate([~inside[1:], [True]])
    last |= inside & edge[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every ``\\n``-split line, empty ones too."""
    breaks = np.flatnonzero(data == 10)
    starts = np.concatenate([offsets[:-1], breaks + 1])
    ends = np.concatenate([breaks, offsets[1:]])
    rows = np.concatenate(
        [np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, "right") - 1]
    )
    order = np.lexsort((starts, rows))
    starts, rows = starts[order], rows[order]
    return starts, ends[np.lexsort((ends, np.concatenate(
        [np.searchsorted(offsets, breaks, "right") - 1, np.arange(len(offsets) - 1)])))], rows


def lowered(data: np.ndarray) -> np.ndarray:
    """ASCII capitals as small letters."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values[offsets[i]:offsets[i + 1]]`` for every i."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64 if values.dtype.kind == "f" else np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]
