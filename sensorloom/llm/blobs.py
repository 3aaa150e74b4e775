"""Integer arrays as short binary values, for shuffles of many small numbers in few rows."""

from __future__ import annotations

import numpy as np


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers with as many bytes each as the largest one needs."""
    values = np.ascontiguousarray(values, "<u8")
    width = (int(values.max()).bit_length() + 7) // 8 if len(values) else 0
    planes = values.view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + len(values).to_bytes(8, "little") + planes.T.tobytes()


def unpack(blob: bytes) -> np.ndarray:
    width, count = blob[0], int.from_bytes(blob[1:9], "little")
    planes = np.zeros((count, 8), np.uint8)
    planes[:, :width] = np.frombuffer(blob, np.uint8, offset=9).reshape(width, count).T
    return planes.view("<u8").ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """The same for a sorted array, by its steps."""
    return pack(np.diff(values, prepend=values.dtype.type(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob), dtype=np.uint64)


def bucket(hashes: np.ndarray, count: int, bits: int = 64) -> np.ndarray:
    """Which of ``count`` equal ranges of hash values each one falls into."""
    return ((hashes >> np.uint64(bits - 32)) * np.uint64(count)) >> np.uint64(32)
