"""A bitmap of fixed size over 64-bit keys, to let a scan pass over rows that no later join can use.

It may pass keys that are not in it (an exact join follows), never hold back one that is. It is the
one thing broadcast, and its size is fixed by ``BITS``, whatever the number of keys.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etoile.llm.lists import pack, unpack
from etoile.llm.text import mix, release

BITS, SLICE_BITS = 27, 21          # 16 MB, in 64 slices


class Bitmap:
    """Bits that travel compressed: a broadcast is a file on the driver and on every executor, and few bits are set for a small input."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def __reduce__(self):
        return _bitmap, (zstandard.ZstdCompressor(level=1).compress(self.bits.tobytes()),)


def _bitmap(blob: bytes) -> Bitmap:
    return Bitmap(np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8))


def _cells(keys: np.ndarray, seed: int = 0) -> np.ndarray:
    salt = mix(np.array([seed], dtype=np.uint64))          # 0 for 0
    return (mix(keys.astype(np.int64).view(np.uint64) ^ salt) >> np.uint64(64 - BITS)).astype(np.uint32)


def _twice(cells: np.ndarray) -> np.ndarray:
    """Sorted cells, each at most twice."""
    return cells[np.concatenate([np.ones(min(2, len(cells)), dtype=bool), cells[2:] != cells[:-2]])]


def _partial(twice: bool, seed: int):
    def run(batches):
        parts, held = [np.zeros(0, dtype=np.uint32)], 0
        for batch in batches:
            parts.append(_cells(batch.column(0).to_numpy(zero_copy_only=False), seed))
            held += len(parts[-1])
            if held > 4_000_000:
                parts, held = [merged(parts)], 0
        cells = merged(parts)
        bounds = np.searchsorted(cells >> np.uint32(SLICE_BITS), np.arange((1 << (BITS - SLICE_BITS)) + 1))
        blobs = [(s, pack(cells[a:b] & np.uint32((1 << SLICE_BITS) - 1)))
                 for s, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])) if a < b]
        yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in blobs], pa.int32()), pa.array([b for _, b in blobs], pa.binary())],
                                         ["slice", "cells"])

    def merged(parts):
        cells = np.concatenate(parts)
        return _twice(np.sort(cells)) if twice else np.unique(cells)
    return run


def _merged(twice: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros(1 << SLICE_BITS, dtype=np.uint8)
        for blob in pdf["cells"]:
            cells, n = np.unique(unpack(blob, np.uint32)[0], return_counts=True)
            counts[cells] = np.minimum(counts[cells] + n, 2)
        bits = np.packbits(counts >= (2 if twice else 1), bitorder="little")
        return pd.DataFrame({"slice": [int(pdf["slice"].iloc[0])], "bits": [bits.tobytes()]})
    return run


def sieve(keys: DataFrame, twice: bool = False, seed: int = 0):
    """Broadcast bitmap of the one long column of ``keys`` (no nulls). ``twice``: of the keys that are there more than once.

    Sieves of different ``seed`` let different keys through by chance.
    """
    rows = (keys.mapInArrow(_partial(twice, seed), "slice int, cells binary").groupBy("slice")
            .applyInPandas(_merged(twice), "slice int, bits binary").collect())          # 64 rows at most
    bitmap = np.zeros(1 << (BITS - 3), dtype=np.uint8)
    for r in rows:
        size = 1 << (SLICE_BITS - 3)
        bitmap[r.slice * size:(r.slice + 1) * size] = np.frombuffer(r.bits, dtype=np.uint8)
    return keys.sparkSession.sparkContext.broadcast(Bitmap(bitmap))


def passes(bitmap: Bitmap, keys: np.ndarray, seed: int = 0) -> np.ndarray:
    """Which keys the bitmap lets through."""
    cells = _cells(keys, seed)
    return (bitmap.bits[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1 == 1


def _split(column: str, shared, kept: bool):
    def run(batches):
        for batch in batches:
            keys = batch.column(column)
            some = passes(shared.value, keys.fill_null(0).to_numpy(zero_copy_only=False)) & keys.is_valid().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(some == kept))
        release()
    return run


def split(rows: DataFrame, column: str, shared) -> tuple[DataFrame, DataFrame]:
    """The rows whose ``column`` (a long) the sieve ``shared`` holds back, or is null, and those it lets through."""
    held, through = (rows.mapInArrow(_split(column, shared, kept), rows.schema) for kept in (False, True))
    return held, through


def without(rows: DataFrame, column: str, gone: DataFrame) -> DataFrame:
    """Rows whose ``column`` (a long) is not in ``gone`` (one long column, no nulls). Nulls stay.

    Only rows that the sieve lets through are shuffled for the anti-join.
    """
    sure, maybe = split(rows, column, sieve(gone))
    return sure.union(maybe.join(gone.toDF("gone_key"), F.col(column) == F.col("gone_key"), "left_anti"))
