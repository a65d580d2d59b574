"""Operator 11, exact top-k search: score everything, find each k-th score by refining histograms, then filter.

Scores are inner products of integer vectors (``floor(scale * x)`` of every component). For a block of queries:

1. every task scores all its vectors against the block and counts scores in ``BINS`` equal bins of each query's range, at first the range
   that the norms allow. A task sends only the bins from the top down to its own k-th score, at most k a query: the k-th score of all is never below that.
2. The merged histogram, summed from the top, tells the bin that holds the k-th score. That bin is the next range, in finer bins, until it
   holds at most k vectors or one single score.
3. A last pass keeps the vectors at or above that bound. Of equal scores a task sends the k smallest ids, so a vector that a third of all
   rows repeat costs k rows a task and query. The k best of each query are ranked by score, then id.

Plan. Vectors are written once and never shuffled. What is sent to tasks is one block of queries: at most ``BLOCK_QUERIES`` and about ``BLOCK_BYTES``. Blocks
follow one another, so memory does not grow with the number of queries; the passes do, as each query has to meet each vector. What a pass returns to the driver is one row
per query of the block.

Rules. Vectors that are null or hold a null or non-finite component take no part; zero and empty vectors do. Only vectors of one length can be multiplied: a query finds
vectors of its own length. Every row is an item: repeated ids and repeated rows are rows of their own, and a query leaves out only its own row. A null id is never a query;
as a candidate it comes after all other ids of its score. Components are exact whole numbers of any size, and so are scores; one that no 64-bit integer holds counts as the
nearest that is. With fewer than k candidates all are returned. An empty table gives an empty result. Other columns may have any name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from etoile.session import dematerialize, materialize

BINS = 1024
BLOCK_QUERIES, BLOCK_BYTES = 4096, 1 << 24
CHUNK_ROWS = 1024                     # vectors scored together: scores of a chunk take CHUNK_ROWS x BLOCK_QUERIES numbers
K = 5
_EXACT = float(1 << 53)               # sums of products below this are exact in double precision
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
OUT = "query_row long, query_id long, vec_id long, score long"


def _usable(scale: float):
    """(vec_id, dim, vector, norm) of the rows whose vectors take part; components as doubles, norms of the whole numbers."""
    def run(batches):
        for batch in batches:
            column = batch.column("embedding")
            offsets, size = column.offsets.to_numpy(), np.diff(column.offsets.to_numpy())
            # a null inside the values becomes NaN
            values = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False) if len(column.values) else np.zeros(0)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            good = np.flatnonzero(~column.is_null().to_numpy(zero_copy_only=False) & (bad[offsets[1:]] == bad[offsets[:-1]]))
            rows = [values[offsets[i]:offsets[i + 1]] for i in good]
            with np.errstate(over="ignore"):
                norms = [float(np.sqrt(np.square(np.floor(scale * v)).sum())) for v in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(good)), pa.array(size[good], pa.int32()), pa.array([v.tobytes() for v in rows], pa.binary()),
                 pa.array(norms, pa.float64())], ["vec_id", "dim", "vector", "norm"])
    return run


@dataclass
class Block:
    """Queries asked together, with what is known of their k-th scores: it is in ``low`` to ``last``, in bins of ``width``; ``above`` scores are beyond."""
    rows: np.ndarray
    ids: np.ndarray
    vectors: np.ndarray                                # (query, component)
    scale: float
    low: np.ndarray
    last: np.ndarray
    width: np.ndarray
    above: np.ndarray
    open: np.ndarray = field(default=None)             # not narrowed down yet

    def need(self, k: int) -> np.ndarray:
        return k - self.above


def _whole(values: np.ndarray, scale: float) -> np.ndarray:
    """``floor(scale * x)`` as Python's integers."""
    return np.array([[math.floor(Fraction(v) * Fraction(scale)) for v in row] for row in values.tolist()], dtype=object).reshape(values.shape)


def _scores(x: np.ndarray, q: np.ndarray, scale: float) -> np.ndarray:
    """(vector, query) inner products, exact. In doubles where these hold every sum exactly, else in Python's integers."""
    with np.errstate(over="ignore"):
        a, b = np.floor(scale * x), np.floor(scale * q)
    dim = max(1, x.shape[1])
    if np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0) * dim < _EXACT:
        return (a @ b.T).astype(np.int64)
    out = np.zeros((len(a), len(b)), dtype=np.int64)
    i, j = (np.flatnonzero(np.abs(m).max(axis=1) < math.sqrt(_EXACT / dim)) for m in (a, b))
    out[np.ix_(i, j)] = (a[i] @ b[j].T).astype(np.int64)
    wide_i, wide_j = np.setdiff1d(np.arange(len(a)), i), np.setdiff1d(np.arange(len(b)), j)
    for r, c in ((wide_i, np.arange(len(b))), (i, wide_j)):
        if len(r) and len(c):
            out[np.ix_(r, c)] = np.clip(_whole(x[r], scale) @ _whole(q[c], scale).T, _LEAST, _MOST).astype(np.int64)
    return out


def _chunks(batches, dim: int):
    """Vectors of the batches, CHUNK_ROWS at a time: (row, id, id is null, vectors)."""
    for batch in batches:
        for a in range(0, batch.num_rows, CHUNK_ROWS):
            part = batch.slice(a, CHUNK_ROWS)
            x = np.frombuffer(b"".join(part.column("vector").to_pylist()), dtype=np.float64).reshape(part.num_rows, dim)
            ids = part.column("vec_id")
            yield part.column("row").to_numpy(), ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), x


def _reach(x_rows: np.ndarray, scores: np.ndarray, block: Block, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vector, query) of the scores at or above each query's bound, the query's own row left out."""
    mask = scores >= bound
    order = np.argsort(block.rows)
    at = np.minimum(np.searchsorted(block.rows, x_rows, sorter=order), len(order) - 1)
    own = np.flatnonzero(block.rows[order[at]] == x_rows)
    mask[own, order[at[own]]] = False
    return np.nonzero(mask)


def _histogram(block: Block, dim: int, k: int):
    """(q, bin, n, need): a task's counts of the open queries, from the top bin down to its own k-th score."""
    def run(batches):
        rows, ids, vectors, low, last, width, above = (getattr(block, f)[block.open] for f in ("rows", "ids", "vectors", "low", "last", "width", "above"))
        part = Block(rows, ids, vectors, block.scale, low, last, width, above)
        number = np.flatnonzero(block.open)
        need, held = part.need(k), np.zeros((len(number), BINS), dtype=np.int64)
        bound = part.low.copy()
        for n, (rows, _, _, x) in enumerate(_chunks(batches, dim)):
            scores = _scores(x, part.vectors, part.scale)
            i, j = _reach(rows, scores, part, bound)
            inside = scores[i, j] <= part.last[j]             # beyond: counted above the range already
            i, j = i[inside], j[inside]
            # differences of 64-bit numbers need all 64 bits
            bins = ((scores[i, j] - part.low[j]).view(np.uint64) // part.width[j].astype(np.uint64)).astype(np.int64)
            held += np.bincount(j * BINS + bins, minlength=held.size).reshape(held.shape)
            if n & (n + 1) == 0:                              # now and then: scores below the task's own k-th do not matter
                bound = part.low + part.width * _kth_bin(held, need)
        keep = np.arange(BINS)[None, :] >= _kth_bin(held, need)[:, None]
        q, b = np.nonzero((held > 0) & keep)
        yield pa.RecordBatch.from_arrays([pa.array(number[q], pa.int32()), pa.array(b, pa.int32()), pa.array(held[q, b]), pa.array(need[q])],
                                         ["q", "bin", "n", "need"])
    return run


def _kth_bin(held: np.ndarray, need: np.ndarray) -> np.ndarray:
    """The bin of each query's need-th count from the top; 0 if there are fewer."""
    down = np.cumsum(held[:, ::-1], axis=1)
    return np.where(down[:, -1] >= need, held.shape[1] - 1 - (down < need[:, None]).sum(1), 0)


def _at_or_above(block: Block, dim: int, k: int):
    """A task's k best vectors of each query among those at or above its bound, by score, then id."""
    def run(batches):
        best = None
        for rows, ids, null, x in _chunks(batches, dim):
            scores = _scores(x, block.vectors, block.scale)
            i, j = _reach(rows, scores, block, block.low)
            new = (j, scores[i, j], null[i], ids[i])
            best = new if best is None else tuple(np.concatenate(c) for c in zip(best, new))
            order = np.lexsort((best[3], best[2], -best[1], best[0]))
            best = tuple(c[order] for c in best)
            first = np.searchsorted(best[0], best[0])
            best = tuple(c[np.arange(len(first)) - first < k] for c in best)
        if best is not None:
            q, score, null, ids = best
            yield pa.RecordBatch.from_arrays([pa.array(block.rows[q]), pa.array(block.ids[q]), pa.array(ids, mask=null), pa.array(score)],
                                             ["query_row", "query_id", "vec_id", "score"])
    return run


def _start(queries, dim: int, norm: float, scale: float) -> Block:
    """A block with the ranges that the norms allow: no score is beyond the product of the norms."""
    reach = [r.norm * norm * (1 + 1e-9) + 1 for r in queries]
    reach = [int(x) if x < float(_MOST) else None for x in reach]
    low, last = [_LEAST if x is None else -x for x in reach], [_MOST if x is None else x for x in reach]
    return Block(np.array([r.row for r in queries]), np.array([r.vec_id for r in queries]),
                 np.frombuffer(b"".join(r.vector for r in queries), dtype=np.float64).reshape(len(queries), dim), scale,
                 np.array(low, dtype=np.int64), np.array(last, dtype=np.int64),
                 np.array([-((a - b - 1) // BINS) for a, b in zip(low, last)], dtype=np.int64),
                 np.zeros(len(queries), dtype=np.int64), np.ones(len(queries), dtype=bool))


def _narrow(vectors: DataFrame, block: Block, dim: int, k: int) -> None:
    """One histogram pass: each open query's range becomes the bin that holds its k-th score."""
    held = (vectors.mapInArrow(_histogram(block, dim, k), "q int, bin int, n long, need long")
            .groupBy("q", "bin").agg(F.sum("n").alias("n"), F.max("need").alias("need")))
    down = held.withColumn("down", F.sum("n").over(W.partitionBy("q").orderBy(F.desc("bin"))))
    at = down.where((F.col("down") >= F.col("need")) & (F.col("down") - F.col("n") < F.col("need"))).collect()     # one row per query
    block.open[:] = False                              # not found: fewer than k candidates, all of them are kept
    for r in at:
        low = int(block.low[r.q]) + r.bin * int(block.width[r.q])
        last = min(int(block.last[r.q]), low + int(block.width[r.q]) - 1)
        block.low[r.q], block.last[r.q], block.width[r.q] = low, last, -((low - last - 1) // BINS)
        block.above[r.q] += r.down - r.n
        block.open[r.q] = r.n > k and last > low


def search(vectors: DataFrame, every: int = 50, k: int = K, scale: float = 256.0) -> DataFrame:
    """query_id, rank, vec_id, score: of every row whose id is divisible by ``every``, the k rows of highest inner product."""
    spark = vectors.sparkSession
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    whole = materialize(plain.mapInArrow(_usable(scale), "vec_id long, dim int, vector binary, norm double")
                        .withColumn("row", F.monotonically_increasing_id()), "topk-vectors")
    asked = F.pmod("vec_id", F.lit(every)) == 0
    sizes = whole.groupBy("dim").agg(F.max("norm").alias("norm"), F.count(F.when(asked, 1)).alias("queries")).where("queries > 0").collect()   # one row per length
    found = []
    for s in sizes:
        same = whole.where(F.col("dim") == s.dim)
        blocks = max(1, -(-s.queries // BLOCK_QUERIES), -(-s.queries * 8 * s.dim // BLOCK_BYTES))
        for b in range(blocks):
            queries = same.where(asked & (F.pmod(F.xxhash64("row"), F.lit(blocks)) == b)).collect()
            if not queries:
                continue
            block = _start(queries, s.dim, s.norm, scale)
            while block.open.any():
                _narrow(same, block, s.dim, k)
            found.append(materialize(same.mapInArrow(_at_or_above(block, s.dim, k), OUT), "topk-found"))
    dematerialize(whole)
    rows = reduce(DataFrame.unionAll, found) if found else spark.createDataFrame([], OUT)
    rank = F.row_number().over(W.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
