"""Texts of a batch as arrays of code points, for operators that work in numpy inside tasks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np

#: Characters worked on together; a longer text is worked on alone. Bounds the memory of a task.
CHUNK = 1 << 19
BLANK, LETTER, DIGIT, SIGN = 0, 1, 2, 3


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: its class, and its lower-case form (one code point)."""
    kind = np.full(0x110000, SIGN, np.uint8)
    low = np.arange(0x110000, dtype=np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            kind[i] = LETTER
            if len(x := c.lower()) == 1:
                low[i] = ord(x)
        elif c.isdigit():
            kind[i] = DIGIT
        elif c.isspace() or i < 32:
            kind[i] = BLANK
    return kind, low


def chunks(texts: Sequence[str | None]) -> Iterator[tuple[int, list[str]]]:
    """(number of the first text, texts) of up to CHUNK characters together; null counts as empty."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        text = text or ""
        if held and size + len(text) > CHUNK:
            yield first, held
            first, held, size = i, [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        yield first, held


def joined(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, each after a NUL and one NUL at the end, and where these NULs stand."""
    points = np.frombuffer(("\0" + "\0".join(texts) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    return points, np.concatenate(([0], np.cumsum(sizes)))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values between neighbouring bounds, in an order that other texts don't change."""
    out = np.zeros((len(bounds) - 1, *values.shape[1:]))
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, bounds[full], axis=0, dtype=np.float64)
    return out
