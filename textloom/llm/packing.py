"""Sorted numbers as small byte strings: differences, split into byte planes, zstandard."""

from __future__ import annotations

import numpy as np
import zstandard


def to_planes(values: np.ndarray) -> bytes:
    """Unsigned numbers as byte planes, lowest bytes first."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize)
    return np.ascontiguousarray(raw.T).tobytes()


def from_planes(data: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def pack(values: np.ndarray) -> bytes:
    """Any unsigned numbers."""
    return zstandard.ZstdCompressor(level=1).compress(to_planes(values))


def unpack(data: bytes, dtype) -> np.ndarray:
    return from_planes(zstandard.ZstdDecompressor().decompress(data), dtype) if data else np.empty(0, dtype)


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned numbers."""
    return pack(np.diff(values, prepend=values.dtype.type(0)))


def unpack_sorted(data: bytes, dtype) -> np.ndarray:
    return np.cumsum(unpack(data, dtype), dtype=dtype)
