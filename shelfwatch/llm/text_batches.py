"""Numpy views of text columns inside tasks: bytes, words, rolling hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that a task works on at once; a longer text is worked on alone.
SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column in one array, and where each text begins and ends in it; NULL is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if len(offsets) == 0 or buffers[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows with about ``limit`` bytes of text, or one row with more."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers 0 to n of the hash base and of its inverse, modulo 2**64."""
    if len(_powers.get("up", ())) <= n:
        for name, factor in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(n + 1, factor, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"][: n + 1], _powers["down"][: n + 1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit hash over all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Sums over the first 0 to n values, each times its power of the base."""
    up, _ = powers(len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of values[start:end], equal for equal stretches wherever they lie."""
    _, down = powers(len(sums) - 1)
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and how many words lie before each text.

    ``classes`` maps a byte to 0 where it is no part of a word. Words end with their text.
    """
    inside = classes[data] != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)
