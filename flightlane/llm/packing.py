"""Number arrays as compressed bytes: what blocks of documents send through a shuffle."""

from __future__ import annotations

import numpy as np
import zstandard

KEY_SPACE = 1 << 64


def pack(numbers: np.ndarray) -> bytes:
    """An array of numbers byte plane by byte plane, compressed; the first byte names its type."""
    numbers = np.ascontiguousarray(numbers)
    planes = numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T
    return numbers.dtype.char.encode() + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes) -> np.ndarray:
    kind = np.dtype(data[:1].decode())
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8)
    return np.ascontiguousarray(raw.reshape(kind.itemsize, -1).T).view(kind).reshape(-1)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending unsigned keys as differences."""
    return pack(np.diff(keys, prepend=keys.dtype.type(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    steps = unpack(data)
    return np.cumsum(steps, dtype=steps.dtype)


def bucket_cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where ascending 64-bit keys are cut so that each bucket gets an equal range of all keys."""
    edges = np.array([KEY_SPACE * b // buckets for b in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]]).astype(np.int64)


def mixed(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    """One 64-bit hash of two columns of 64-bit hashes; the order of the two matters."""
    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) + np.asarray(b, np.uint64)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))
