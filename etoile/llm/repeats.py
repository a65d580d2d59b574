"""Operator 6, substring dedup: repeated windows of words, found through a count-min sketch.

A window is ``k`` consecutive words of one document. A word goes if a window over it also starts, with the same words, in
a document with a smaller ``doc_id``. Windows are judged on the input.

Plan, three scans of the texts and no shuffle of windows that occur once:

1. *Sketch.* Each task hashes its windows into ``ROWS`` rows of ``2^SKETCH_BITS`` counters and sends the counters it touched
   as compressed sorted lists, cut into slices of the counter space. A slice's lists are added up in one task
   (2^SLICE_BITS counters): a merged count is never under the true one. What is kept is one bit per counter, "two or more".
   The sketch has a fixed size (2 x 64 MB of bits as a broadcast, whatever the corpus); more windows than
   counters make it pass more windows, never fewer, so that results stay exact and the next step's work is at
   most all windows, about 12 bytes each.
2. *Exact grouping* of the windows whose every counter is two or more, by 128-bit keys (two independent 64-bit hashes of the words).
   Within a block of a task, only the smallest document of a key has anything to ask; the larger ones are repeats
   already (so a passage that a third of the documents hold is one entry per block, not one per document). Entries go
   compressed, as sorted lists, to the task of their range of keys, which finds the smallest document of each key and answers
   with the repeated windows' first words by document.
3. The answers join the documents and the covered words are removed.

Rules. Null text counts as no words. A null ``doc_id`` is larger than every id and equal to other nulls: such documents
lose to any other and not to each other. Rows with the same id never count against each other; repeated rows (same id and text) get
the same result. Texts of fewer than ``k`` words lose nothing. Other columns may have any name. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etoile.llm.lists import pack, unpack
from etoile.llm.text import Words, chunked, inside, small, utf8, window_hashes
from etoile.session import materialize

WINDOW = 13
SKETCH_BITS, SLICE_BITS, ROWS = 29, 21, 2     # counters per row, counters per merging task, rows
RANGES = 64                                    # ranges of keys at least; more with the number of tasks
BLOCK_WINDOWS = 2_000_000                      # windows of a block (a longer text is a block of its own)
_LAST = np.iinfo(np.int64).max


def _ids(batch) -> np.ndarray:
    return batch.column("doc_id").fill_null(_LAST).to_numpy(zero_copy_only=False).astype(np.int64)


def _counters(h: np.ndarray) -> list[np.ndarray]:
    """A window's counter in each row of the sketch: two disjoint parts of its hash."""
    mask = np.uint64((1 << SKETCH_BITS) - 1)
    return [(h >> np.uint64(64 - SKETCH_BITS)).astype(np.uint32), (h & mask).astype(np.uint32)]


def _partial_sketch(k: int):
    """(slice, cells): the counters that a block of windows touched; those touched twice or more are sent twice."""
    def sliced(hashes):
        h = np.concatenate(hashes)
        names, blobs = [], []
        for row, cells in enumerate(_counters(h)):
            cells = np.sort(cells)
            # the first and the second of equal neighbours: a count of two says as much as any larger one
            cells = cells[np.concatenate([np.ones(min(2, len(cells)), dtype=bool), cells[2:] != cells[:-2]])]
            bounds = np.searchsorted(cells >> np.uint32(SLICE_BITS), np.arange((1 << (SKETCH_BITS - SLICE_BITS)) + 1))
            for s in range(len(bounds) - 1):
                if bounds[s] < bounds[s + 1]:
                    names.append((row << (SKETCH_BITS - SLICE_BITS)) + s)
                    blobs.append(pack(cells[bounds[s]:bounds[s + 1]] & np.uint32((1 << SLICE_BITS) - 1)))
        return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], ["slice", "cells"])

    def run(batches):
        hashes, held = [], 0
        for batch in small(batches):
            texts = utf8(batch.column("text"))
            for i, j in chunked(texts):
                words = Words(texts[i:j])
                hashes.append(window_hashes(words.hashes(), k)[inside(words, k)])
                held += len(hashes[-1])
                if held >= BLOCK_WINDOWS:
                    yield sliced(hashes)
                    hashes, held = [], 0
        if held:
            yield sliced(hashes)
    return run


def _merge_slice(pdf: pd.DataFrame) -> pd.DataFrame:
    counts = np.zeros(1 << SLICE_BITS, dtype=np.uint8)
    for blob in pdf["cells"]:
        cells, = unpack(blob, np.uint32)
        once, n = np.unique(cells, return_counts=True)
        counts[once] = np.minimum(counts[once] + n, 2)
    often = np.flatnonzero(counts >= 2).astype(np.uint32)
    return pd.DataFrame({"slice": [int(pdf["slice"].iloc[0])], "often": [pack(often)]})


def sketch(docs: DataFrame, k: int) -> dict[int, bytes]:
    """Slice of the sketch -> its counters of two or more, compressed."""
    rows = (docs.mapInArrow(_partial_sketch(k), "slice int, cells binary").groupBy("slice")
            .applyInPandas(_merge_slice, "slice int, often binary").toLocalIterator())       # ROWS x 2^(29-21) rows
    return {r.slice: bytes(r.often) for r in rows}


def _bitmaps(slices: dict[int, bytes]) -> list[np.ndarray]:
    per_row = 1 << (SKETCH_BITS - SLICE_BITS)
    out = []
    for row in range(ROWS):
        bits = np.zeros(1 << (SKETCH_BITS - 3), dtype=np.uint8)
        for s in range(per_row):
            if row * per_row + s in slices:
                cells, = unpack(slices[row * per_row + s], np.uint32)
                part = np.zeros(1 << SLICE_BITS, dtype=bool)
                part[cells] = True
                bits[s << (SLICE_BITS - 3):(s + 1) << (SLICE_BITS - 3)] = np.packbits(part, bitorder="little")
        out.append(bits)
    return out


def _starts_by_doc(doc: np.ndarray, mark: np.ndarray, start: np.ndarray):
    """Per document: its id, digest and the sorted, packed starts."""
    order = np.lexsort((start, mark, doc))
    doc, mark, start = doc[order], mark[order], start[order]
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1])])) if len(doc) else np.zeros(0, int)
    ends = np.append(new[1:], len(doc))
    return doc[new], mark[new], [start[a:b].astype(np.int32).tobytes() for a, b in zip(new, ends)]


def _rows(ranges, answer: bool, doc, mark, data) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ranges, pa.int32()), pa.array([answer] * len(data), pa.bool_()), pa.array(doc, pa.int64()),
                                       pa.array(mark, pa.int64()), pa.array(data, pa.binary())], ["range", "answer", "doc_id", "mark", "data"])


def _candidates(k: int, shared, ranges: int):
    """(range, answer, doc_id, mark, data): packed entries of a range of keys; or, as an answer, a document's repeated windows."""
    def block(parts):
        h1, h2, doc, mark, start = map(np.concatenate, zip(*parts))
        order = np.lexsort((doc, h2, h1))
        h1, h2, doc, mark, start = (x[order] for x in (h1, h2, doc, mark, start))
        new = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
        least = doc[np.flatnonzero(new)][np.cumsum(new) - 1]
        ask = doc == least                                    # the others repeat a smaller document of this block
        d, m, blobs = _starts_by_doc(doc[~ask], mark[~ask], start[~ask])
        yield _rows(d % ranges, True, d, m, blobs)
        h1, h2, doc, mark, start = (x[ask] for x in (h1, h2, doc, mark, start))
        at = ((h1 >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
        bounds = np.searchsorted(at, np.arange(ranges + 1))
        names, blobs = [], []
        for r in range(ranges):
            a, b = bounds[r], bounds[r + 1]
            if a < b:
                own, who = np.unique(np.stack([doc[a:b], mark[a:b]]), axis=1, return_inverse=True)
                names.append(r)
                blobs.append(len(own[0]).to_bytes(4, "little") + own.tobytes()
                             + pack(h1[a:b], h2[a:b], who.reshape(-1).astype(np.uint32), start[a:b].astype(np.uint32)))
        yield _rows(names, False, [0] * len(names), [0] * len(names), blobs)

    def run(batches):
        bitmaps, parts, held, seen = _bitmaps(shared.value), [], 0, 0
        for batch in small(batches):
            texts, ids = utf8(batch.column("text")), _ids(batch)
            marks = batch.column("mark").to_numpy()
            for i, j in chunked(texts):
                words = Words(texts[i:j])
                hashes, at = words.hashes(), inside(words, k)
                h1 = window_hashes(hashes, k)[at]
                keep = np.ones(len(at), dtype=bool)
                for bits, cells in zip(bitmaps, _counters(h1)):
                    keep &= (bits[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1 == 1
                at, h1 = at[keep], h1[keep]
                if len(at):
                    h2 = window_hashes(words.hashes(seed=1), k, seed=1)[at]
                    of = words.text[at]
                    parts.append((h1, h2, ids[i:j][of], marks[i:j][of], at - words.first[of]))
                    held += len(at)
                seen += len(keep)
                if seen >= BLOCK_WINDOWS * 2 or held >= BLOCK_WINDOWS // 2:
                    if parts:
                        yield from block(parts)
                    parts, held, seen = [], 0, 0
        if parts:
            yield from block(parts)
    return run


def _resolve(pdf: pd.DataFrame) -> pd.DataFrame:
    """A range of keys: for each key its smallest document; (doc_id, mark, starts) of windows that repeat it."""
    docs, marks, blobs = [], [], []
    parts = []
    for answer, doc, mark, data in zip(pdf["answer"], pdf["doc_id"], pdf["mark"], pdf["data"]):
        if answer:
            docs.append(int(doc))
            marks.append(int(mark))
            blobs.append(data)
            continue
        n = int.from_bytes(data[:4], "little")
        own = np.frombuffer(data, dtype=np.int64, count=2 * n, offset=4).reshape(2, n)
        h1, h2, who, start = unpack(data[4 + 16 * n:], np.uint64, np.uint64, np.uint32, np.uint32)
        parts.append((h1, h2, own[0][who], own[1][who], start))
    if parts:
        h1, h2, doc, mark, start = map(np.concatenate, zip(*parts))
        order = np.lexsort((doc, h2, h1))
        h1, h2, doc, mark, start = (x[order] for x in (h1, h2, doc, mark, start))
        new = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
        again = doc != doc[np.flatnonzero(new)][np.cumsum(new) - 1]
        d, m, b = _starts_by_doc(doc[again], mark[again], start[again])
        docs, marks, blobs = [*docs, *d.tolist()], [*marks, *m.tolist()], [*blobs, *b]
    return pd.DataFrame({"doc_id": pd.array(docs, "int64"), "mark": pd.array(marks, "int64"), "starts": blobs})


def _cover(k: int, digests: bool):
    def run(batches):
        for batch in small(batches):
            texts = utf8(batch.column("text"))
            n_words, n_removed, out = [], [], []
            for text, blobs in zip(texts, batch.column("starts").to_pylist()):
                words = text.split()                      # bytes: splits at 0x20 and 0x09-0x0D, as Words does
                if blobs:
                    change = np.zeros(len(words) + 1, dtype=np.int64)
                    start = np.frombuffer(b"".join(blobs), dtype=np.int32)
                    np.add.at(change, start, 1)
                    np.add.at(change, start + k, -1)
                    gone = np.cumsum(change[:-1]) > 0
                    kept = [w for w, g in zip(words, gone.tolist()) if not g]
                else:
                    kept = words
                joined = b" ".join(kept)
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                out.append(hashlib.sha256(joined).hexdigest() if digests else joined.decode())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                                              pa.array(out, pa.string())], ["doc_id", "n_words", "n_removed", "kept"])
    return run


def repeated_starts(docs: DataFrame, k: int = WINDOW) -> DataFrame:
    """(doc_id, mark, starts): for documents that have repeated windows, lists of the first words of these."""
    context = docs.sparkSession.sparkContext
    slices = sketch(docs.select("text"), k)
    ranges = max(RANGES, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = (docs.mapInArrow(_candidates(k, context.broadcast(slices), ranges), "range int, answer boolean, doc_id long, mark long, data binary")
             .groupBy("range").applyInPandas(_resolve, "doc_id long, mark long, starts binary"))
    return found.groupBy("doc_id", "mark").agg(F.collect_list("starts").alias("starts"))      # one document's own windows


def remove_repeats(docs: DataFrame, k: int = WINDOW, digests: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and ``kept``: the kept words joined by a space, or that text's SHA-256."""
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    docs = docs.withColumn("mark", F.xxhash64(F.coalesce("text", F.lit(""))))
    starts = materialize(repeated_starts(docs, k), "starts").alias("s")
    keyed = docs.withColumn("id", F.coalesce("doc_id", F.lit(_LAST))).alias("d")
    joined = (keyed.join(starts, (F.col("d.id") == F.col("s.doc_id")) & (F.col("d.mark") == F.col("s.mark")), "left")
              .select("d.doc_id", "d.text", "s.starts"))
    return joined.mapInArrow(_cover(k, digests), "doc_id long, n_words long, n_removed long, kept string")
