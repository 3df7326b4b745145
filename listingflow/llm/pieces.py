"""Whole texts of an Arrow batch cut into byte runs with numpy, no Python object for each run."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on together; a longer text is worked on alone. Bounds the memory of a task.
SLICE = 4 << 20


def text_slices(column: pa.Array, most: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, UTF-8 bytes, bounds by text) of up to ``most`` bytes together; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1 + column.offset)[column.offset:]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + most, "right")) - 1)
        yield first, data[bounds[first]:bounds[last]], bounds[first:last + 1] - bounds[first]
        first = last


def runs(data: np.ndarray, inside: np.ndarray, cuts: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The runs of bytes that are ``inside``, broken at ``cuts`` and between texts, and the number of runs before each bound.

    ``cuts`` says for each byte whether a run may not go on from the byte before it.
    """
    edge = np.zeros(len(data) + 1, bool)
    edge[1:-1] = cuts[1:] | (inside[1:] != inside[:-1])
    edge[bounds] = True
    edge[0] = edge[-1] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    if len(data):
        full = inside[starts]
        starts, ends = starts[full], ends[full]
    else:
        starts, ends = starts[:0], ends[:0]
    offsets = np.concatenate(([0], np.cumsum(ends - starts)))
    dense = data[inside] if len(data) else data
    found = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(dense.tobytes())])
    return found, np.searchsorted(starts, bounds)


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, … for each (start, size), one after the other."""
    total = int(sizes.sum())
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(total)
