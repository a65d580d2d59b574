from __future__ import annotations

import numpy as np
import pytest

from etoile.llm import forest


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, cell long, vector string, n int")


def brute(rows, every, k):
    x = {i: np.array(v) for i, v in rows}
    out = {}
    for q in x:
        if q % every == 0:
            d = sorted((float(np.sqrt(((x[q] - x[i]) ** 2).sum())), i) for i in x if i != q)
            out[q] = d[:k]
    return out


def test_small_sets_are_exact_with_ties_and_unusable_vectors(spark):
    rnd = np.random.default_rng(1)
    good = [(i, rnd.normal(size=4).tolist()) for i in range(60)]
    good += [(100 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(40)]                 # equal vectors: ties
    bad = [(500, None), (600, [0.0] * 4), (700, [1.0, None, 2.0, 3.0]), (800, [float("nan"), 1.0, 1.0, 1.0]), (900, [1.0, 2.0]),
           (1000, [float("inf"), 0.0, 0.0, 1.0]), (None, [1.0, 2.0, 3.0, 4.0])]
    df = vectors(spark, [(i, v, 1, "x", 1) for i, v in good + bad])
    want = brute(good, 10, 10)
    got = {}
    for r in forest.neighbours(df, every=10).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.score, r.vec_id)
    assert {q: [v[i] for i in range(1, 11)] for q, v in got.items()} == want


def test_few_candidates_and_empty_table(spark):
    df = vectors(spark, [(0, [1.0, 0.0], 1, "x", 1), (1, [0.0, 1.0], 1, "x", 1), (1, [0.5, 1.0], 1, "x", 1), (200, [3.0, 3.0], 1, "x", 1)])
    out = sorted((r.query_id, r.rank, r.vec_id, round(r.score, 6)) for r in forest.neighbours(df).collect())
    assert out == [(0, 1, 1, round(1.25 ** 0.5, 6)), (0, 2, 200, round(13 ** 0.5, 6)), (200, 1, 1, round(10.25 ** 0.5, 6)), (200, 2, 0, round(13 ** 0.5, 6))]
    assert forest.neighbours(vectors(spark, [])).collect() == []


def test_cells_and_blocks_do_not_change_the_result(spark, monkeypatch):
    rnd = np.random.default_rng(2)
    rows = [(i, [1.0, 1.0] if i % 3 == 0 else rnd.normal(size=2).tolist()) for i in range(900)]     # a third alike
    df = vectors(spark, [(i, v, 1, "x", 1) for i, v in rows])
    plain = sorted(tuple(r) for r in forest.neighbours(df, every=10, share=0.5).collect())
    monkeypatch.setattr(forest, "CELL_ROWS", 50)
    monkeypatch.setattr(forest, "QUERY_ROWS", 20)
    assert plain == sorted(tuple(r) for r in forest.neighbours(df, every=10, share=0.5).collect())


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_on_the_given_vectors(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    x = df.select("vec_id", "embedding").toPandas().sort_values("vec_id")
    ids, m = x["vec_id"].to_numpy(), np.stack(x["embedding"]).astype(np.float64)
    hits = total = 0
    got = {}
    for r in forest.neighbours(df, every=10).collect():                 # more queries than the contract's, for a steadier figure
        got.setdefault(r.query_id, set()).add(r.vec_id)
    for i in np.flatnonzero(ids % 10 == 0):
        d = np.sqrt(((m - m[i]) ** 2).sum(1))
        d[i] = np.inf
        best = set(ids[np.lexsort((ids, d))[:10]].tolist())
        hits, total = hits + len(best & got[ids[i]]), total + 10
    print("recall", hits / total)
    assert hits / total >= 0.9
