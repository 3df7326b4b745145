"""A static range asymmetric numeral system over token ids, in numpy: tables, blocks, checkpoints.

A table gives each id a share of 2^bits slots. A block deals its ids to LANES
interleaved coders, id i to lane i mod LANES; a coder's state is 64 bits wide
and sheds or takes 32 bits at a time. Blocks are independent, and every STEP
rounds of the lanes a checkpoint keeps the states and the place in the words,
so parts of a block can be decoded side by side. Any number of blocks is coded
at once, one row of a matrix each.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

LANES, STEP = 32, 256
#: Lower bound of a state between two ids.
LOW = np.uint64(1 << 31)
MAGIC = b"RANS"
# Fixed layout, little-endian: magic, version, bits, lanes, ids, words, checkpoints, table CRC, CRC of what follows.
HEADER = struct.Struct("<4sBBHQQIII")


@dataclass(frozen=True)
class Table:
    """Ids in rising order with their share of 2^bits slots."""

    ids: np.ndarray
    share: np.ndarray
    bits: int

    @property
    def crc(self) -> int:
        return zlib.crc32(self.ids.astype("<u4").tobytes() + self.share.astype("<u4").tobytes())

    def first(self) -> np.ndarray:
        return np.cumsum(self.share) - self.share

    def slots(self) -> np.ndarray:
        """The place in ``ids`` of each slot."""
        return np.repeat(np.arange(len(self.ids), dtype=np.int32), self.share)


def table_of(ids: np.ndarray, counts: np.ndarray) -> Table:
    """Shares near the counts, one slot at least for each id; what rounding leaves goes to or comes from the most frequent."""
    order = np.argsort(ids)
    ids, counts = np.asarray(ids, np.int64)[order], np.asarray(counts, np.int64)[order]
    bits = min(24, max(12, int(len(ids)).bit_length() + 4))
    if not len(ids):
        return Table(ids, counts, bits)
    total = int(counts.sum())
    share = np.array([max(1, (int(c) << bits) // total) for c in counts.tolist()], np.int64)
    left = (1 << bits) - int(share.sum())
    for i in np.argsort(-counts, kind="stable").tolist():
        if left >= 0:
            share[i] += left
            break
        took = min(-left, int(share[i]) // 2)
        share[i] -= took
        left += took
    return Table(ids, share, bits)


def encode(blocks: Sequence[np.ndarray], table: Table) -> list[bytes]:
    """Each block of ids as bytes that can be decoded alone."""
    if not blocks:
        return []
    share, first = table.share.astype(np.uint64), table.first().astype(np.uint64)
    bits, wide = np.uint64(table.bits), np.uint64(32)
    sizes = np.array([len(b) for b in blocks], np.int64)
    steps = -(-sizes // LANES)
    grid = np.full((len(blocks), int(steps.max()) * LANES), -1, np.int32)
    place = np.zeros(int(table.ids[-1]) + 1 if len(table.ids) else 0, np.int32)
    place[table.ids] = np.arange(len(table.ids))
    for row, ids in zip(grid, blocks, strict=True):
        row[:len(ids)] = place[ids]
    grid = grid.reshape(len(blocks), -1, LANES)
    state = np.full((len(blocks), LANES), LOW, np.uint64)
    words: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    shed = np.zeros(len(blocks), np.int64)
    marks: list[list[tuple[int, np.ndarray]]] = [[] for _ in blocks]
    for s in range(grid.shape[1] - 1, -1, -1):
        rows = np.flatnonzero(steps > s)
        symbol = grid[rows, s]
        some = symbol >= 0
        symbol = np.maximum(symbol, 0)
        x, f = state[rows], share[symbol]
        full = some & (x >= (f << (np.uint64(63) - bits)))
        which, _ = np.nonzero(full)
        words.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
        owners.append(rows[which])
        shed[rows] += full.sum(axis=1)
        x = np.where(full, x >> wide, x)
        q = x // f
        state[rows] = np.where(some, (q << bits) + (x - q * f) + first[symbol], x)
        if s % STEP == 0:
            for r in rows.tolist():
                marks[r].append((int(shed[r]), state[r].copy()))
    none = np.zeros(0, np.int64)
    flat, owner = np.concatenate([*words[::-1], none.astype("<u4")]), np.concatenate([*owners[::-1], none])
    flat = flat[np.argsort(owner, kind="stable")]
    ends = np.cumsum(shed)
    crc, out = table.crc, []
    for r, ids in enumerate(blocks):
        own = flat[ends[r] - shed[r]:ends[r]]
        points = marks[r][::-1]
        places = np.array([shed[r] - at for at, _ in points], "<u8")  # words taken before the checkpoint
        states = np.array([x for _, x in points], "<u8").reshape(-1)
        sums = np.array([zlib.crc32(ids[i:i + STEP * LANES].astype("<u4").tobytes()) for i in range(0, len(ids), STEP * LANES)], "<u4")
        body = places.tobytes() + states.tobytes() + sums.tobytes() + own.tobytes()
        out.append(HEADER.pack(MAGIC, 1, table.bits, LANES, len(ids), len(own), len(points), crc, zlib.crc32(body)) + body)
    return out


class Damaged(ValueError):
    """Bytes that are no block, belong to another table, or fail a checksum."""


def decode(coded: Sequence[bytes], table: Table) -> list[np.ndarray]:
    """The ids of each block; all parts between checkpoints are decoded side by side."""
    share, first, slots = table.share.astype(np.uint64), table.first().astype(np.uint64), table.slots()
    bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    crc, sizes, parts, states, places, words, sums, taken = table.crc, [], [], [], [], [], [], 0
    for raw in coded:
        if len(raw) < HEADER.size:
            raise Damaged("shorter than a header")
        magic, version, own_bits, lanes, n, count, points, own_crc, body_crc = HEADER.unpack_from(raw)
        if (magic, version, lanes) != (MAGIC, 1, LANES):
            raise Damaged("not a block of this format")
        if (own_crc, own_bits) != (crc, table.bits):
            raise Damaged("coded with another table")
        if zlib.crc32(raw[HEADER.size:]) != body_crc:
            raise Damaged("checksum of the block")
        at = HEADER.size
        places.append(np.frombuffer(raw, "<u8", points, at).astype(np.int64) + taken)
        at += 8 * points
        states.append(np.frombuffer(raw, "<u8", points * LANES, at).reshape(points, LANES))
        at += 8 * points * LANES
        sums.append(np.frombuffer(raw, "<u4", points, at))
        at += 4 * points
        words.append(np.frombuffer(raw, "<u4", count, at))
        taken += count
        sizes.append(n)
        parts.append(np.minimum(STEP * LANES, n - STEP * LANES * np.arange(points)))
    if not coded:
        return []
    part, state, place = np.concatenate(parts).astype(np.int64), np.concatenate(states).astype(np.uint64), np.concatenate(places)
    flat = np.concatenate([*words, np.zeros(LANES, "<u4")]).astype(np.uint64)
    out = np.zeros((len(part), STEP * LANES), np.int32)
    lane = np.arange(LANES)
    for s in range(int(-(-part.max() // LANES)) if len(part) else 0):
        rows = np.flatnonzero(part > s * LANES)
        some = lane < (part[rows] - s * LANES)[:, None]
        x = state[rows]
        symbol = slots[(x & mask).astype(np.int64)]
        out[rows, s * LANES:(s + 1) * LANES] = symbol
        y = share[symbol] * (x >> bits) + (x & mask) - first[symbol]
        low = some & (y < LOW)
        took = place[rows][:, None] + np.cumsum(low, axis=1) - low
        y = np.where(low, (y << np.uint64(32)) | flat[np.where(low, took, 0)], y)
        state[rows] = np.where(some, y, x)
        place[rows] += low.sum(axis=1)
    ids, at, result = table.ids[out] if len(table.ids) else out.astype(np.int64), 0, []
    for n, own in zip(sizes, sums, strict=True):
        pieces = []
        for k in range(len(own)):
            piece = ids[at, :min(STEP * LANES, n - k * STEP * LANES)]
            if zlib.crc32(piece.astype("<u4").tobytes()) != int(own[k]):
                raise Damaged(f"checksum of part {k}")
            pieces.append(piece)
            at += 1
        result.append(np.concatenate(pieces) if pieces else np.zeros(0, np.int64))
    return result
