"""Arrays of whole numbers as compressed bytes."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(x: np.ndarray, rising: bool = False) -> bytes:
    """Whole numbers, compressed; ``rising`` if sorted."""
    x = np.asarray(x).astype(np.uint64)
    x = np.diff(x, prepend=np.uint64(0)) if rising else x
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, rising: bool = False) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    x = np.ascontiguousarray(planes.reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(x, dtype=np.uint64) if rising else x
