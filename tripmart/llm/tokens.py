"""Words of Arrow text columns as 64-bit hashes, worked out for many texts at once in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

# Texts are taken together up to this many bytes; a longer one is taken alone.
TOGETHER = 2 << 20
MULTIPLIER = 0x9E3779B97F4A7C15 | 1
SEPARATOR = 0


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


@cache
def byte_values() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(MULTIPLIER))


_powers = {"size": 0}


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2^64."""
    if _powers["size"] < size:
        room = max(size, TOGETHER + 1)
        up, down = np.full(room, MULTIPLIER, np.uint64), np.full(room, pow(MULTIPLIER, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _powers.update(size=room, up=np.cumprod(up, dtype=np.uint64), down=np.cumprod(down, dtype=np.uint64))
    return _powers["up"][:size], _powers["down"][:size]


def word_bytes() -> np.ndarray:
    """A to Z lower-cased; digits, letters and all bytes from 128 make up words; anything else separates them."""
    table = np.zeros(256, np.uint8)
    for low, high in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        table[low:high + 1] = np.arange(low, high + 1)
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    return table


def spaced_bytes() -> np.ndarray:
    """A to Z lower-cased; words are whatever ASCII white space separates."""
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    table[[0x20, *range(0x09, 0x0E)]] = SEPARATOR
    return table


def text_parts(column: pa.Array, together: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets into them) for runs of texts; null counts as empty."""
    together = TOGETHER if together is None else together
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + together, "right")) - 1)
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def word_hashes(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in order, and where the words of each text begin among them (one more at the end)."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    chars = table[data]
    inside = chars != SEPARATOR
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    up, down = powers(len(data))
    sums = np.cumsum(byte_values()[chars] * up, dtype=np.uint64)
    before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
    hashes = mixed((sums[ends] - before) * down[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, offsets)


def as_long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))
