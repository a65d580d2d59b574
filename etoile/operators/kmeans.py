"""Many K-Means fits advanced together: one pass over the data per Lloyd iteration.

The source fits 7 values of k x 10 restarts for its elbow curve, then 10 restarts for the
final clustering. Fitted one at a time, that is one pass over the data per iteration per
fit (about 70 x 40 passes). Here every fit advances in the same pass:

* each iteration is one Spark job: per partition, ``mapInPandas`` assigns every point to
  its nearest center under *every* model (numpy on Arrow batches) and emits per
  ``(model, cluster)`` partial sums, counts and costs — at most sum(k) rows per partition;
* ``groupBy(model, cluster)`` merges the partials, combined per partition and spread over the
  reducers; the driver receives only the new centers (sum of k over all models: a few hundred rows)
  and ships them with the next pass;
* a model stops once the summed squared shift of its centers is at most ``tol`` times the
  mean feature variance (the source's rule); the loop ends when all have converged or after
  ``max_iter`` passes; a last pass computes each model's cost.

Initialisation, for all models in shared passes: a few rounds draw points with probability proportional to their squared distance from the points drawn
so far (one uniform draw, then ``ROUNDS`` times ``OVERSAMPLE * k`` of them), one more pass weighs each drawn point by the points nearest to it, and the
k centers are chosen among these weighted candidates on the driver (at most 1 + ROUNDS x OVERSAMPLE x k a model) by the source's default, greedy k-means++: at each step several candidates are drawn and the
one that leaves the smallest weighted potential is taken; Lloyd steps over the candidates follow. That is ROUNDS + 2 passes whatever k is. A draw: a
point's key is ``-ln(u) / d2``, with ``u`` a hash of the point's id, the model's seed and the round, and ``d2`` its squared distance to the points drawn; the smallest keys are
drawn. A partition sends that many points per model.

An empty cluster moves, as the source's do, to the point farthest from its center (several to as many farthest points; equal distances by the
id's hash), which then no longer counts where it was. Only models with an empty cluster ask for these points: a top-k per model, in a pass of its own.
If every point is on a center, an empty cluster keeps its place.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROUNDS, OVERSAMPLE = 2, 4             # rounds of draws, and points drawn in each, per center


@dataclass
class KMeansFit:
    k: int
    seed: int
    centers: np.ndarray      # (k, d)
    cost: float = float("nan")
    iterations: int = 0
    converged: bool = False


def uniform(h: np.ndarray, seed: int, step: int) -> np.ndarray:
    """A number in (0, 1) for every 64-bit hash, seed and step."""
    with np.errstate(over="ignore"):
        x = h.astype(np.int64).view(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + step * 0xD1B54A32D192ED03) % 2 ** 64)
        for shift in (30, 27):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53


def draw_keys(x: np.ndarray, h: np.ndarray, seed: int, drawn: np.ndarray, step: int) -> np.ndarray:
    """Keys of the points for the draw of round ``step`` after ``drawn`` (rows); the smallest are drawn. Points on a drawn one: never, unless nothing else is left."""
    race = -np.log(uniform(h, seed, step))
    if not len(drawn):
        return race
    d2 = _square_distances(x, drawn).min(1)
    with np.errstate(divide="ignore"):
        return np.where(d2 > 0, race / d2, np.inf)


def _square_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """(points, centers); summed over the coordinates in turn, so that equal points have distance 0."""
    out = np.zeros((len(x), len(c)))
    for i in range(x.shape[1]):
        out += (x[:, i, None] - c[None, :, i]) ** 2
    return out


def _drawn(cols: list[str], fits: list[KMeansFit], wanted: list[int], step: int):
    """mapInPandas function: per model, the partition's points of smallest keys (infinite keys by hash)."""
    models = [(m, f.seed, f.centers, n) for m, (f, n) in enumerate(zip(fits, wanted))]

    def fn(batches):
        best: dict[int, list] = {}
        for pdf in batches:
            if not len(pdf):
                continue
            x, h = pdf[cols].to_numpy(dtype=float), pdf["_h"].to_numpy()
            for m, seed, drawn, n in models:
                key = draw_keys(x, h, seed, drawn, step)
                some = np.lexsort((h, key))[:n] if n >= len(key) else np.flatnonzero(key <= np.partition(key, n - 1)[n - 1])
                best[m] = sorted(best.get(m, []) + [(float(key[i]), int(h[i]), *x[i].tolist()) for i in some])[:n]
        yield pd.DataFrame([(m, *p) for m, points in sorted(best.items()) for p in points], columns=["model", "key", "h", *cols])
    return fn


def _weighed(cols: list[str], fits: list[KMeansFit]):
    """mapInPandas function: per model and drawn point, how many points of the partition are nearest to it (ties: the first)."""
    models = [f.centers for f in fits]

    def fn(batches):
        counts = [np.zeros(len(c), dtype=np.int64) for c in models]
        for pdf in batches:
            x = pdf[cols].to_numpy(dtype=float)
            for n, c in zip(counts, models):
                if len(x):
                    n += np.bincount(_square_distances(x, c).argmin(1), minlength=len(c))
        yield pd.DataFrame([(m, i, int(v)) for m, n in enumerate(counts) for i, v in enumerate(n) if v], columns=["model", "point", "n"])
    return fn


def greedy_centers(points: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Greedy k-means++ over weighted points: 2 + ln k candidates a step, the one that leaves the smallest potential is taken."""
    rng, trials = np.random.default_rng(seed), 2 + int(np.log(k))
    d2 = _square_distances(points, points)
    chosen = [int(rng.choice(len(points), p=weights / weights.sum()))]
    left = d2[chosen[0]]
    while len(chosen) < k:
        mass = left * weights
        if mass.sum() > 0:
            tried = rng.choice(len(points), size=trials, p=mass / mass.sum())
        else:
            tried = np.arange(1)                                    # every point is on a center
        after = np.minimum(left[None, :], d2[tried])
        best = int(np.argmin((after * weights).sum(1)))
        chosen.append(int(tried[best]))
        left = after[best]
    return points[chosen]


def _settled(points: np.ndarray, weights: np.ndarray, centers: np.ndarray, steps: int = 100) -> np.ndarray:
    """Lloyd steps over weighted points, until nothing moves."""
    for _ in range(steps):
        near = _square_distances(points, centers).argmin(1)
        mass = np.bincount(near, weights=weights, minlength=len(centers))
        sums = np.stack([np.bincount(near, weights=weights * points[:, i], minlength=len(centers)) for i in range(points.shape[1])], axis=1)
        new = np.where(mass[:, None] > 0, sums / np.maximum(mass, 1)[:, None], centers)
        if np.array_equal(new, centers):
            break
        centers = new
    return centers


def candidates(data: DataFrame, cols: list[str], fits: list[KMeansFit]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each model's drawn points and their weights, in ROUNDS + 2 passes over ``data`` (columns ``_h`` and ``cols``)."""
    schema = "model int, key double, h long, " + ", ".join(f"`{c}` double" for c in cols)
    drawn = [KMeansFit(f.k, f.seed, np.zeros((0, len(cols)))) for f in fits]
    for step in range(ROUNDS + 1):
        wanted = [OVERSAMPLE * f.k if step else 1 for f in drawn]
        limit = reduce(lambda e, m: e.when(F.col("model") == m, wanted[m]), range(1, len(fits)), F.when(F.col("model") == 0, wanted[0]))
        rank = F.row_number().over(Window.partitionBy("model").orderBy("key", "h"))
        rows = (data.select("_h", *cols).mapInPandas(_drawn(cols, drawn, wanted, step), schema).withColumn("_rank", rank).where(F.col("_rank") <= limit).collect())
        fresh: dict[int, list] = {}                                                      # OVERSAMPLE * k rows per model
        for r in sorted(rows, key=lambda r: (r.model, r["_rank"])):
            if r.key < np.inf:
                fresh.setdefault(r.model, []).append([r[c] for c in cols])
        for m, points in fresh.items():
            drawn[m].centers = np.vstack([drawn[m].centers, points])
    rows = (data.select(*cols).mapInPandas(_weighed(cols, drawn), "model int, point int, n long").groupBy("model", "point").agg(F.sum("n").alias("n")).collect())
    weights = [np.zeros(len(f.centers)) for f in drawn]
    for r in rows:
        weights[r.model][r.point] = r.n
    return [(f.centers, w) for f, w in zip(drawn, weights)]


def seed_centers(data: DataFrame, cols: list[str], fits: list[KMeansFit]) -> None:
    """Starting centers of every fit: greedy k-means++ among its weighted candidates, settled over them."""
    for f, (points, weights) in zip(fits, candidates(data, cols, fits)):
        f.centers = _settled(points, weights, greedy_centers(points, weights, f.k, f.seed))


def _groups(layout: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Runs of consecutive models with the same k: ``(first center index, k, number of models)``."""
    out: list[list[int]] = []
    for start, k in layout:
        if out and out[-1][1] == k and out[-1][0] + out[-1][1] * out[-1][2] == start:
            out[-1][2] += 1
        else:
            out.append([start, k, 1])
    return [tuple(g) for g in out]


def _partials(cols: list[str], layout: list[tuple[int, int]], centers: np.ndarray):
    """mapInPandas function: per-(model, cluster) count, cost and coordinate sums of a partition.

    The centers (sum of k over the models x d numbers) travel with the task closure. Models
    with the same k are assigned together (one argmin over a (rows, models, k) block), and
    counts, costs and sums of every model are single ``bincount`` calls.
    """
    groups = _groups(layout)

    def fn(batches):
        c = centers                             # (sum k, d)
        c2 = (c ** 2).sum(1)
        total, d = c.shape
        n = np.zeros(total, dtype=np.int64)
        cost = np.zeros(total)
        s = np.zeros((total, d))
        for pdf in batches:
            x = pdf[cols].to_numpy(dtype=float)
            if not len(x):
                continue
            dist = (x ** 2).sum(1)[:, None] - 2.0 * x @ c.T + c2[None, :]
            nearest = np.concatenate(
                [dist[:, g0:g0 + k * m].reshape(len(x), m, k).argmin(2) + (g0 + k * np.arange(m))[None, :]
                 for g0, k, m in groups], axis=1)          # (rows, models): global center index
            flat = nearest.ravel()
            models = nearest.shape[1]
            n += np.bincount(flat, minlength=total)
            cost += np.bincount(flat, weights=((x[:, None, :] - c[nearest]) ** 2).sum(2).ravel(), minlength=total)
            for dim in range(d):
                s[:, dim] += np.bincount(flat, weights=np.repeat(x[:, dim], models), minlength=total)
        model = np.concatenate([[m] * k for m, (_start, k) in enumerate(layout)])
        cluster = np.concatenate([np.arange(k) for _start, k in layout])
        out = {"model": model.astype("int32"), "cluster": cluster.astype("int32"), "n": n, "cost": cost}
        out.update({f"s_{i}": s[:, i] for i in range(d)})
        yield pd.DataFrame(out)
    return fn


def _pass(data: DataFrame, cols: list[str], fits: list[KMeansFit]):
    layout, start = [], 0
    for f in fits:
        layout.append((start, f.k))
        start += f.k
    centers = np.vstack([f.centers for f in fits])                   # sum(k) x d: bounded
    schema = "model int, cluster int, n long, cost double, " + ", ".join(f"s_{i} double" for i in range(len(cols)))
    return (data.select(*cols).mapInPandas(_partials(cols, layout, centers), schema)
            .groupBy("model", "cluster")
            .agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"),
                 *[F.sum(f"s_{i}").alias(f"s_{i}") for i in range(len(cols))])
            .collect())                                             # sum(k) rows


def _far(cols: list[str], fits: list[KMeansFit], wanted: list[int]):
    """mapInPandas function: per model, the partition's points farthest from their centers."""
    models = [(m, f.centers, n) for m, (f, n) in enumerate(zip(fits, wanted))]

    def fn(batches):
        best: dict[int, list] = {}
        for pdf in batches:
            if not len(pdf):
                continue
            x, h = pdf[cols].to_numpy(dtype=float), pdf["_h"].to_numpy()
            for m, centers, n in models:
                d2 = _square_distances(x, centers)
                near, least = d2.argmin(1), d2.min(1)
                some = np.lexsort((h, -least))[:n]
                best[m] = sorted(best.get(m, []) + [(-float(least[i]), int(h[i]), int(near[i]), *x[i].tolist()) for i in some])[:n]
        yield pd.DataFrame([(m, *p) for m, points in sorted(best.items()) for p in points], columns=["model", "worse", "h", "cluster", *cols])
    return fn


def _farthest(data: DataFrame, cols: list[str], fits: list[KMeansFit], wanted: list[int]) -> dict[int, list]:
    """Per model, the ``wanted`` points farthest from their centers: (cluster, coordinates). ``data`` has ``_h``."""
    schema = "model int, worse double, h long, cluster int, " + ", ".join(f"`{c}` double" for c in cols)
    rank = F.row_number().over(Window.partitionBy("model").orderBy("worse", "h"))
    rows = (data.select("_h", *cols).mapInPandas(_far(cols, fits, wanted), schema).withColumn("_rank", rank)
            .where(F.col("_rank") <= max(wanted)).collect())                                           # k rows per model at most
    out: dict[int, list] = {}
    for r in sorted(rows, key=lambda r: (r.model, r["_rank"])):
        if r.worse < 0:
            out.setdefault(r.model, []).append((r.cluster, np.array([r[c] for c in cols])))
    return {m: points[:wanted[m]] for m, points in out.items()}


def _step(data: DataFrame, cols: list[str], fits: list[KMeansFit]) -> list[float]:
    """One Lloyd step of every fit; the squared shift of each one's centers."""
    counts = [np.zeros(f.k) for f in fits]
    sums = [np.zeros((f.k, len(cols))) for f in fits]
    for r in _pass(data, cols, fits):
        counts[r.model][r.cluster] = r.n
        sums[r.model][r.cluster] = [r[f"s_{i}"] for i in range(len(cols))]
    lacking = [m for m, n in enumerate(counts) if (n == 0).any()]
    if lacking:
        empty = [np.flatnonzero(counts[m] == 0) for m in lacking]
        for i, points in _farthest(data, cols, [fits[m] for m in lacking], [len(e) for e in empty]).items():
            for to, (cluster, x) in zip(empty[i], points):
                m = lacking[i]
                counts[m][cluster] -= 1
                sums[m][cluster] -= x
                counts[m][to], sums[m][to] = 1, x
    new = [np.where(n[:, None] > 0, s / np.maximum(n, 1)[:, None], f.centers) for n, s, f in zip(counts, sums, fits)]
    shifts = [float(((n - f.centers) ** 2).sum()) for n, f in zip(new, fits)]
    for n, f in zip(new, fits):
        f.centers = n
    return shifts


def fit_many(data: DataFrame, cols: list[str], models: list[tuple[int, int]], max_iter: int = 300,
             tol: float = 1e-4, id_col: str = "client_id") -> list[KMeansFit]:
    """Fit one K-Means model per ``(k, seed)`` in ``models``; all advance in the same passes.

    ``data`` should be a written table (every pass reads it). Fewer points than the largest k is an error.
    """
    data = data.select(F.xxhash64(id_col).alias("_h"), *cols)
    # the source's rule: stop when the summed squared center shift <= tol * mean feature variance
    stats = data.agg(F.count(F.lit(1)).alias("n"), *[F.var_pop(c).alias(c) for c in cols]).first()
    most = max(k for k, _ in models)
    if stats.n < most:
        raise ValueError(f"{stats.n} points are fewer than {most} clusters")
    tol_abs = tol * float(np.mean([stats[c] or 0.0 for c in cols]))
    fits = [KMeansFit(k, seed, np.zeros((0, len(cols)))) for k, seed in models]
    seed_centers(data, cols, fits)
    for it in range(1, max_iter + 1):
        active = [f for f in fits if not f.converged]
        if not active:
            break
        for f, shift in zip(active, _step(data, cols, active)):
            f.iterations = it
            f.converged = bool(shift <= tol_abs)
    for r in _pass(data, cols, fits):
        fits[r.model].cost = (0.0 if np.isnan(fits[r.model].cost) else fits[r.model].cost) + r.cost
    return fits


def best_per_k(fits: list[KMeansFit]) -> dict[int, KMeansFit]:
    """Lowest cost per k; ties go to the lowest seed."""
    best: dict[int, KMeansFit] = {}
    for f in sorted(fits, key=lambda f: (f.k, f.cost, f.seed)):
        best.setdefault(f.k, f)
    return best


def _distances(cols: list[str], centers: np.ndarray) -> Column:
    """Squared distances to the centers (literals: k x d, bounded), as an array."""
    return F.array(*[sum(((F.col(c) - F.lit(float(v))) ** 2 for c, v in zip(cols, row)), F.lit(0.0)) for row in centers])


def assign(df: DataFrame, cols: list[str], centers: np.ndarray, out: str = "segment") -> DataFrame:
    """Nearest-center index as a built-in expression."""
    arr = _distances(cols, centers)
    return df.withColumn(out, (F.array_position(arr, F.array_min(arr)) - 1).cast("int"))


def inertia(df: DataFrame, cols: list[str], centers: np.ndarray) -> DataFrame:
    """``(inertie)``: summed squared distance to the nearest center."""
    return df.agg(F.sum(F.array_min(_distances(cols, centers))).alias("inertie"))


def lloyd(df: DataFrame, cols: list[str], centers: np.ndarray, steps: int, id_col: str = "client_id") -> np.ndarray:
    """The centers after so many steps from given ones."""
    fits = [KMeansFit(len(centers), 0, np.asarray(centers, dtype=float))]
    data = df.select(F.xxhash64(id_col).alias("_h"), *cols)
    for _ in range(steps):
        _step(data, cols, fits)
    return fits[0].centers
