"""Numbers as few bytes."""

from __future__ import annotations

import zlib

import numpy as np


def packed_counts(counts: np.ndarray) -> bytes:
    """Counts, a byte each; those of 255 or more follow in full. Compressed, as most are small."""
    large = counts >= 255
    return zlib.compress(np.where(large, 255, counts).astype(np.uint8).tobytes() + counts[large].astype("<i8").tobytes(), 1)


def counts_of(packed: bytes, n: int) -> np.ndarray:
    packed = zlib.decompress(packed)
    counts = np.frombuffer(packed, np.uint8, n).astype(np.int64)
    large = counts == 255
    counts[large] = np.frombuffer(packed, "<i8", offset=n)
    return counts


def planes(values: np.ndarray, plain: int) -> bytes:
    """Numbers byte by byte: the lower ``plain`` bytes of all as they are, the others compressed."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    columns = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    plain = min(plain, width)
    head = np.array([len(values), width, plain], "<u4").tobytes()
    return head + columns[:plain].tobytes() + zlib.compress(columns[plain:].tobytes(), 1)


def from_planes(packed: bytes) -> np.ndarray:
    n, width, plain = np.frombuffer(packed, "<u4", 3).tolist()
    at = 12 + n * plain
    columns = np.zeros((8, n), np.uint8)
    columns[:plain] = np.frombuffer(packed, np.uint8, n * plain, 12).reshape(plain, n)
    columns[plain:width] = np.frombuffer(zlib.decompress(packed[at:]), np.uint8).reshape(width - plain, n)
    return np.ascontiguousarray(columns.T).reshape(-1).view("<u8")


def ascending(values: np.ndarray) -> bytes:
    """The first value and the steps, of which all but the highest byte are noise."""
    if not len(values):
        return b""
    steps = np.diff(values, prepend=np.uint64(0))
    width = max(1, (int(steps[1:].max(initial=0)).bit_length() + 7) // 8)
    return steps[:1].astype("<u8").tobytes() + planes(steps[1:], width - 1)


def from_ascending(packed: bytes) -> np.ndarray:
    if not packed:
        return np.empty(0, "<u8")
    return np.cumsum(np.r_[np.frombuffer(packed, "<u8", 1), from_planes(packed[8:])], dtype=np.uint64)
