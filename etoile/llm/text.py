"""Words, word hashes and windows of many texts at once, as numpy over one byte buffer.

A *word* is a run of bytes other than 0x20 and 0x09-0x0D. Inside an Arrow task a few
megabytes of whole texts are laid end to end; all per-word work is vectorised over them.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BATCH_ROWS, BATCH_BYTES = 1000, 1 << 22
CHUNK_BYTES = 1 << 20      # texts handled together; a longer text is a chunk of its own

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LANE = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_S32, _S29 = np.uint64(32), np.uint64(29)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (multiply and xor-shift)."""
    h = (h ^ (h >> _S32)) * _A
    h = (h ^ (h >> _S29)) * _B
    return h ^ (h >> _S32)


def utf8(column: pa.ChunkedArray | pa.Array, lower: bool = False) -> list[bytes]:
    """The texts of an Arrow string column as UTF-8 (null: empty), A-Z lower-cased if asked."""
    out = [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]
    return [b.lower() for b in out] if lower else out


def small_batches(spark) -> None:
    """Arrow batches of at most BATCH_ROWS rows and about BATCH_BYTES in this session: Spark's own bounds let every task hold tens of MB of texts on both sides."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def small(batches, limit: int = 4 * CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut where their texts pass ``limit`` bytes (one row at least): a whole batch may be far larger than what a task should copy at once."""
    for batch in batches:
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0), dtype=np.int64)
        ends, i = np.cumsum(size), 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + limit, side="right")))
            yield batch.slice(i, j - i)
            i = j
    release()


def release() -> None:
    """Give a task's freed memory back to the system at its end: reused Python workers would else keep their peak through the stages that follow."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
    if trim:
        trim(0)


def chunked(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges ``[i, j)`` of ``texts`` of about ``limit`` bytes, each at least one text."""
    i, size = 0, 0
    for j, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield i, j
            i, size = j, 0
        size += len(t)
    if i < len(texts):
        yield i, len(texts)


class Words:
    """The words of a run of texts.

    ``start``, ``size``: byte range of each word in the joined buffer; ``first``: index of each
    text's first word, with the total at the end; ``text``: index of the text of each word.
    ``solid_bytes``: the bytes that words are made of (never the line end).
    """

    def __init__(self, texts: list[bytes], solid_bytes: np.ndarray = ~_SPACE):
        joined = b"\n".join(texts)
        self.buffer = np.frombuffer(joined + b"\0" * 8, dtype=np.uint8)
        n = len(joined)
        solid = np.zeros(n + 2, dtype=np.int8)
        solid[1:-1] = solid_bytes[self.buffer[:n]]
        edge = np.diff(solid)
        self.start = np.flatnonzero(edge == 1)
        self.size = np.flatnonzero(edge == -1) - self.start
        begin = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=begin[1:])
        self.first = np.searchsorted(self.start, begin)
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """64-bit hash of every word, eight bytes a step."""
        lanes = np.ndarray((len(self.buffer) - 7,), dtype="<u8", buffer=self.buffer, strides=(1,))
        h = mix(self.size.astype(np.uint64) + mix(np.array([seed + 1], dtype=np.uint64)))
        at, left, todo = self.start, self.size, None
        while len(at):
            lane = lanes[at] & _LANE[np.minimum(left, 8)]
            if todo is None:
                h = mix(h ^ lane)
            else:
                h[todo] = mix(h[todo] ^ lane)
            more = np.flatnonzero(left > 8)
            todo = more if todo is None else todo[more]
            at, left = at[more] + 8, left[more] - 8
        return h


def window_hashes(h: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of every run of ``k`` consecutive word hashes, by the index of its first word."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    by = mix(np.array([seed * 2 + 11], dtype=np.uint64)) | np.uint64(1)
    out = h[:n].copy()
    for j in range(1, k):
        out = out * by + h[j:j + n]
    return mix(out)


def inside(words: Words, k: int) -> np.ndarray:
    """Indices of the words that start a run of ``k`` words of one text."""
    if len(words) < k:
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(words.text[:len(words) - k + 1] == words.text[k - 1:])
