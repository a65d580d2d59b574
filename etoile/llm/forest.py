"""Operator 10, nearest neighbours: a forest of random-projection trees with one priority queue.

Fit: the trees' inner nodes split a bounded sample of vectors (``SAMPLE_ROWS``, by hash of the id) at the median of a random direction.
Index: every vector goes to one leaf of every tree. Search: a query's queue holds branches of all trees by how far the query is on the
other side of the splits above them; the nearest branch is followed to its leaf, until ``share`` of all leaves is found. Rerank: in each leaf
exact distances in double precision to the queries that found it, ten per query and leaf; then the ten of each query.

Plan. Splits are the only thing broadcast (``TREES`` x 2^depth directions, depth at most ``MAX_DEPTH``: 1.1 MB at 64 components). Vectors are shuffled once per tree by leaf. A leaf of more
than ``CELL_ROWS`` vectors (as when a third of all are alike) is cut into cells, and queries into blocks of ``QUERY_ROWS``: a task sees at most
one cell with one block. Of each cell only ten rows per query go on.

Recall. ``share`` = 0.34 is for vectors with hardly any structure, as in the test tables (nearest neighbour at 0.95, median at 1.41): measured recall there
is in the README and in the tests, over 0.9. Clustered vectors need much less.

Rules. Vectors that are null, zero, hold a null or a non-finite component, or are not of the commonest length take no part, as queries or candidates. A null
id takes no part. One id is one item: of repeated rows the nearest counts, and an id is never its own neighbour. A query id with several vectors
is asked by the first in binary order. Ties go to the smaller id. With fewer candidates than ``k``, all are found. An empty table gives an empty result. Other columns may have
any name.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TREES, MAX_DEPTH, LEAF_ROWS = 4, 9, 150
SAMPLE_ROWS = 20_000
SHARE = 0.34
CELL_ROWS, QUERY_ROWS = 8192, 8192
K = 10


@dataclass
class Forest:
    depth: int
    directions: np.ndarray    # (tree, node, component); node 1 is the root, 2n and 2n+1 its children
    cuts: np.ndarray          # (tree, node)

    @property
    def leaves(self) -> int:
        return 1 << self.depth

    def route(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees): the leaf of each vector in each tree."""
        out = np.zeros((len(x), len(self.cuts)), dtype=np.int64)
        for t in range(len(self.cuts)):
            node = np.ones(len(x), dtype=np.int64)
            for _ in range(self.depth):
                side = np.einsum("ij,ij->i", x, self.directions[t][node]) > self.cuts[t][node]
                node = 2 * node + side
            out[:, t] = node - self.leaves
        return out

    def search(self, q: np.ndarray, sizes: np.ndarray, wanted: int, least: int) -> list[tuple[int, int]]:
        """(tree, leaf) of the nearest leaves: ``wanted`` of them, and until one tree has found ``least`` vectors.

        ``sizes``: vectors of each (tree, leaf).
        """
        gaps = self.directions @ q - self.cuts
        queue = [(0.0, t, 1) for t in range(len(self.cuts))]
        found, held = [], np.zeros(len(self.cuts), dtype=np.int64)
        while queue and (len(found) < wanted or held.max() < least):
            far, t, node = heapq.heappop(queue)
            while node < self.leaves:
                right = gaps[t, node] > 0
                heapq.heappush(queue, (max(far, abs(gaps[t, node])), t, 2 * node + (not right)))
                node = 2 * node + right
            leaf = int(node - self.leaves)
            if sizes[t, leaf]:
                found.append((t, leaf))
                held[t] += sizes[t, leaf]
        return found


def plant(sample: np.ndarray, trees: int = TREES, seed: int = 0) -> Forest:
    """Trees over the sample; the median of a node's own sample is its cut."""
    depth = int(np.clip(np.floor(np.log2(max(len(sample), 1) / LEAF_ROWS)) + 1, 0, MAX_DEPTH)) if len(sample) > LEAF_ROWS else 0
    rng = np.random.default_rng(seed)
    directions = rng.normal(size=(trees, 1 << depth, sample.shape[1]))
    directions /= np.linalg.norm(directions, axis=2, keepdims=True)
    cuts = np.zeros((trees, 1 << depth))
    for t in range(trees):
        node = np.ones(len(sample), dtype=np.int64)
        for level in range(depth):
            at = np.einsum("ij,ij->i", sample, directions[t][node])
            order = np.lexsort((at, node))
            bounds = np.searchsorted(node[order], np.arange(1 << level, (1 << (level + 1)) + 1))
            for n, a, b in zip(range(1 << level, 1 << (level + 1)), bounds[:-1], bounds[1:]):
                cuts[t, n] = np.median(at[order[a:b]]) if b > a else 0.0
            node = 2 * node + (at > cuts[t][node])
    return Forest(depth, directions, cuts)


def _matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(indices, vectors) of the rows whose vectors take part."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy()
    size = np.diff(offsets)
    size[column.is_null().to_numpy(zero_copy_only=False)] = -1
    rows = np.flatnonzero(size == dim)
    if not len(rows) or not dim:
        return rows[:0], np.zeros((0, dim))
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)           # nulls become NaN
    x = values[offsets[rows][:, None] + np.arange(dim)]
    good = np.isfinite(x).all(1) & (x != 0).any(1)
    return rows[good], x[good]


def _usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where("vec_id is not null and embedding is not null")
    sizes = v.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    return v, sizes[0].d if sizes else 0


def _plain(dim: int):
    def run(batches):
        for batch in batches:
            rows, x = _matrix(batch.column("embedding"), dim)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(rows)), pa.array([v.tobytes() for v in x], pa.binary())],
                                             ["vec_id", "vector"])
    return run


def fit(vectors: DataFrame, dim: int, total: int, trees: int = TREES) -> Forest:
    """The forest of about SAMPLE_ROWS of the ``total`` vectors: all, if there are no more."""
    v = vectors
    if total > SAMPLE_ROWS:
        buckets = 1 << 20
        v = v.where(F.pmod(F.xxhash64("vec_id"), F.lit(buckets)) < max(1, buckets * SAMPLE_ROWS // total))
    picked = v.mapInArrow(_plain(dim), "vec_id long, vector binary").toPandas().sort_values(["vec_id", "vector"])
    sample = np.frombuffer(b"".join(picked["vector"]), dtype=np.float64).reshape(-1, dim) if len(picked) else np.zeros((0, dim))
    return plant(sample, trees)


def _leaf_sizes(shared, dim: int):
    def run(batches):
        forest = shared.value
        counts = np.zeros((len(forest.cuts), forest.leaves), dtype=np.int64)
        for batch in batches:
            _, x = _matrix(batch.column("embedding"), dim)
            for t, leaf in enumerate(forest.route(x).T):
                counts[t] += np.bincount(leaf, minlength=forest.leaves)
        t, leaf = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(t, pa.int32()), pa.array(leaf, pa.int32()), pa.array(counts[t, leaf])], ["tree", "leaf", "n"])
    return run


def _cells(n: np.ndarray) -> np.ndarray:
    return np.maximum(1, -(-n // CELL_ROWS))


def _members(shared, sizes: np.ndarray, dim: int, blocks: int):
    """(cell, vec_id, vector) of every vector, tree and block of queries."""
    parts = _cells(sizes)
    first = (np.cumsum(parts) - parts.reshape(-1)).reshape(parts.shape)        # number of each leaf's first cell

    def run(batches):
        for batch in batches:
            rows, x = _matrix(batch.column("embedding"), dim)
            ids = batch.column("vec_id").to_numpy()[rows]
            raw = pa.array([v.tobytes() for v in x], pa.binary())
            for t, leaf in enumerate(shared.value.route(x).T):
                cell = first[t, leaf] + (ids * 2654435761 >> 7) % parts[t, leaf]
                for b in range(blocks):
                    yield pa.RecordBatch.from_arrays([pa.array(cell * blocks + b, pa.int64()), pa.array(ids), raw], ["cell", "vec_id", "vector"])
    return run


def _asked(shared, sizes: np.ndarray, dim: int, blocks: int, share: float, k: int):
    """(cell, query_id, vector) of every query and cell that its search finds."""
    parts = _cells(sizes)
    first = (np.cumsum(parts) - parts.reshape(-1)).reshape(parts.shape)

    def run(batches):
        forest = shared.value
        wanted = int(np.ceil(share * len(forest.cuts) * forest.leaves))
        for batch in batches:
            for query, raw in zip(batch.column("vec_id").to_pylist(), batch.column("vector").to_pylist()):
                found = forest.search(np.frombuffer(raw), sizes, wanted, k + 1)
                cells = [int(first[t, leaf]) + c for t, leaf in found for c in range(int(parts[t, leaf]))]
                block = (query * 2654435761 >> 7) % blocks
                yield pa.RecordBatch.from_arrays([pa.array([c * blocks + block for c in cells], pa.int64()), pa.array([query] * len(cells), pa.int64()),
                                                  pa.array([raw] * len(cells), pa.binary())], ["cell", "query_id", "vector"])
    return run


def _rerank(dim: int, k: int):
    """Of a cell, the k nearest ids to each query that found it, with exact distances."""
    def run(members: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(members) and len(asked):
            x = np.frombuffer(b"".join(members["vector"]), dtype=np.float64).reshape(-1, dim)
            ids = members["vec_id"].to_numpy()
            norms = (x ** 2).sum(1)
            queries = np.frombuffer(b"".join(asked["vector"]), dtype=np.float64).reshape(-1, dim)
            for a in range(0, len(queries), 256):
                q = queries[a:a + 256]
                rough = norms - 2.0 * (q @ x.T)                              # squared distance less the query's norm
                for i, (query, row) in enumerate(zip(asked["query_id"].iloc[a:a + 256], rough)):
                    top = _nearest(q[i], int(query), x, ids, row, float((q[i] ** 2).sum()), k)
                    for name, v in zip(out, ([int(query)] * len(top[0]), *top)):
                        out[name].extend(v)
        return pd.DataFrame({"query_id": pd.array(out["query_id"], "int64"), "vec_id": pd.array(out["vec_id"], "int64"),
                             "score": np.array(out["score"], dtype=np.float64)})
    return run


def _nearest(q, query: int, x, ids, rough, size: float, k: int) -> tuple[list, list]:
    """Ids and distances of the k nearest ids: a rough cut by squared distances, then exact ones in order."""
    take = 2 * k
    while True:
        if take >= len(x):
            some = np.arange(len(x))
        else:
            edge = np.partition(rough, take - 1)[take - 1]
            some = np.flatnonzero(rough <= edge + 1e-9 * (1.0 + abs(edge) + size))
        some = some[ids[some] != query]
        d = np.sqrt(((x[some] - q) ** 2).sum(1))
        order = np.lexsort((ids[some], d))
        _, at = np.unique(ids[some][order], return_index=True)
        order = order[np.sort(at)][:k]
        if len(order) == k or take >= len(x):
            return ids[some][order].tolist(), d[order].tolist()
        take *= 4


def neighbours(vectors: DataFrame, every: int = 100, k: int = K, trees: int = TREES, share: float = SHARE) -> DataFrame:
    """query_id, rank, vec_id, score: of every vector whose id is divisible by ``every``, the k nearest found."""
    spark = vectors.sparkSession
    v, dim = _usable(vectors)
    total = v.count()
    forest = fit(v, dim, total, trees)
    shared = spark.sparkContext.broadcast(forest)
    sizes = np.zeros((trees, forest.leaves), dtype=np.int64)
    for r in (v.mapInArrow(_leaf_sizes(shared, dim), "tree int, leaf int, n long").groupBy("tree", "leaf").agg(F.sum("n").alias("n")).collect()):
        sizes[r.tree, r.leaf] = r.n                                              # trees x leaves rows at most
    queries = (v.where(F.pmod("vec_id", F.lit(every)) == 0).mapInArrow(_plain(dim), "vec_id long, vector binary")
               .groupBy("vec_id").agg(F.min("vector").alias("vector")))
    blocks = max(1, -(-total // every // QUERY_ROWS))
    members = v.mapInArrow(_members(shared, sizes, dim, blocks), "cell long, vec_id long, vector binary")
    asked = queries.mapInArrow(_asked(shared, sizes, dim, blocks, share, k), "cell long, query_id long, vector binary")
    found = members.groupBy("cell").cogroup(asked.groupBy("cell")).applyInPandas(_rerank(dim, k), "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))       # k rows per tree and cell that a query found
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
