"""Compressed bitmaps of numbers below 65,536 as binary values: two bytes a number while that is
shorter, a plain bit vector beyond. Many bitmaps are packed, counted and unpacked at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SLOT_BITS = 16
SLOTS = 1 << SLOT_BITS
VECTOR_BYTES = SLOTS // 8  # so many bytes are a bit vector; a list of numbers is always shorter
LONGEST_LIST = VECTOR_BYTES // 2 - 1


def pack(keys: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(owners, their bitmaps) of sorted distinct ``keys``: owner << SLOT_BITS | number."""
    owners = keys >> SLOT_BITS
    starts = np.flatnonzero(np.append(True, owners[1:] != owners[:-1])) if len(keys) else np.zeros(0, np.int64)
    limits = np.append(starts, len(keys))
    n = np.diff(limits)
    slots = (keys & (SLOTS - 1)).astype("<u2")
    offsets = np.concatenate(([0], np.cumsum(np.where(n > LONGEST_LIST, VECTOR_BYTES, 2 * n))))
    body, last = [], 0
    for k in np.flatnonzero(n > LONGEST_LIST).tolist():
        vector = np.zeros(SLOTS, bool)
        vector[slots[limits[k]:limits[k + 1]]] = True
        body += [slots[last:limits[k]].tobytes(), np.packbits(vector, bitorder="little").tobytes()]
        last = limits[k + 1]
    body = b"".join([*body, slots[last:].tobytes()])
    return owners[starts], pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(body)])


def _parts(bitmaps: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    bitmaps = bitmaps.cast(pa.large_binary())
    offsets = np.frombuffer(bitmaps.buffers()[1], np.int64)[bitmaps.offset:bitmaps.offset + len(bitmaps) + 1]
    data = bitmaps.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def popcount(bitmaps: pa.Array) -> np.ndarray:
    """How many numbers each bitmap holds."""
    if not len(bitmaps):
        return np.zeros(0, np.int64)
    data, offsets = _parts(bitmaps)
    n = np.diff(offsets) // 2
    for k in np.flatnonzero(n > LONGEST_LIST).tolist():
        n[k] = int(np.bitwise_count(data[offsets[k]:offsets[k + 1]]).sum())
    return n


def unpack(bitmaps: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bitmap, number) for all numbers of all bitmaps; lists first, then bit vectors."""
    if not len(bitmaps):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    data, offsets = _parts(bitmaps)
    size = np.diff(offsets)
    vectors = np.flatnonzero(size == VECTOR_BYTES)
    held = np.where(size == VECTOR_BYTES, 0, size)
    of = np.repeat(np.arange(len(size)), held // 2)
    if len(vectors):
        body = data[offsets[0]:offsets[-1]][np.repeat(size != VECTOR_BYTES, size)]
    else:
        body = data[offsets[0]:offsets[-1]]
    rows, slots = [of], [np.frombuffer(body.tobytes(), "<u2").astype(np.int64)]
    for k in vectors.tolist():
        found = np.flatnonzero(np.unpackbits(data[offsets[k]:offsets[k + 1]], bitorder="little"))
        rows.append(np.full(len(found), k))
        slots.append(found)
    return np.concatenate(rows), np.concatenate(slots)


def either(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The OR of bitmaps given as keys in any order: (sorted distinct keys, the sum of their counts)."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[starts], np.add.reduceat(counts[order], starts)


def planes(keys: np.ndarray, counts: np.ndarray):
    """(plane, keys) of the bit-sliced ``counts``: plane 0 is all keys, and plane k > 0 those
    whose count less one has bit k - 1, so that a number counts the sum of its planes' ``weight``."""
    yield 0, keys
    more, plane = counts - 1, 1
    while len(keys):
        keys, more = keys[more > 0], more[more > 0]
        if len(keys):
            yield plane, keys[more & 1 > 0]
        more, plane = more >> 1, plane + 1


def weight(plane: np.ndarray) -> np.ndarray:
    return np.left_shift(np.int64(1), np.maximum(plane.astype(np.int64) - 1, 0))
