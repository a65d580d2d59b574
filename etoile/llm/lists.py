"""Sorted lists of integers as compressed bytes, for what tasks send each other in bulk."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(*columns: np.ndarray) -> bytes:
    """Columns of integers of one length; the first is sorted and kept as differences. Bytes of equal weight stand together."""
    if len(columns[0]):
        first = columns[0].copy()
        first[1:] -= columns[0][:-1]
        columns = (first, *columns[1:])
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.itemsize).T.tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(blob: bytes, *kinds) -> list[np.ndarray]:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    n, at, out = len(data) // sum(np.dtype(k).itemsize for k in kinds), 0, []
    for k in kinds:
        size = n * np.dtype(k).itemsize
        out.append(np.ascontiguousarray(data[at:at + size].reshape(-1, n).T).view(k).reshape(n) if n else np.zeros(0, dtype=k))
        at += size
    if n:
        out[0] = np.cumsum(out[0], dtype=kinds[0])
    return out
