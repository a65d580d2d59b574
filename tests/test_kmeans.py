"""K-Means: seeding over all points, few points, stated centers, one fit for all reports of a job."""

from __future__ import annotations

import numpy as np
import pytest
from helpers import SF_SMALL

from etoile.operators import kmeans
from etoile.plans import reports
from etoile.plans.registry import star_tables
from etoile.plans.reports import REPORTS

N = 12_000


def points(spark, n=N):
    return spark.range(n).selectExpr("id as client_id", "pmod(xxhash64(id), 1000) / 100.0D as a", "pmod(xxhash64(id, 1), 777) / 50.0D as b")


def test_candidates_cover_all_points_and_equal_brute_force(spark):
    df = points(spark)
    data = df.selectExpr("xxhash64(client_id) as _h", "a", "b")
    fits = [kmeans.KMeansFit(k, seed, np.zeros((0, 2))) for k in (2, 5) for seed in (42, 43)]
    got = kmeans.candidates(data.repartition(7), ["a", "b"], fits)
    pdf = data.toPandas()
    x, h = pdf[["a", "b"]].to_numpy(), pdf["_h"].to_numpy()
    for f, (drawn, weights) in zip(fits, got):
        want = np.zeros((0, 2))
        for step in range(kmeans.ROUNDS + 1):
            u = kmeans.uniform(h, f.seed, step)
            d2 = np.ones(len(x)) if not step else ((x[:, None] - want[None]) ** 2).sum(2).min(1)
            with np.errstate(divide="ignore"):
                want = np.vstack([want, x[np.argsort(-np.log(u) / d2)[:kmeans.OVERSAMPLE * f.k if step else 1]]])
        assert np.allclose(drawn, want)
        near = ((x[:, None] - want[None]) ** 2).sum(2).argmin(1)
        assert np.array_equal(weights, np.bincount(near, minlength=len(want))) and weights.sum() == N


def test_draws_follow_the_squared_distances():
    rnd = np.random.default_rng(0)
    x = np.array([[0.0], [1.0], [2.0]])
    hits = np.zeros(3)
    for _ in range(4000):
        h = rnd.integers(-2 ** 62, 2 ** 62, 3)
        hits[np.argmin(kmeans.draw_keys(x, h, 1, np.array([[0.0]]), 1))] += 1
    assert hits[0] == 0 and abs(hits[2] / hits.sum() - 0.8) < 0.03


def test_greedy_choice_takes_the_candidate_that_leaves_least():
    rnd = np.random.default_rng(5)
    x, w = rnd.normal(size=(40, 3)), rnd.integers(1, 50, 40).astype(float)
    for k, seed in ((2, 1), (4, 2), (8, 3)):
        rng, chosen = np.random.default_rng(seed), []
        chosen.append(int(rng.choice(len(x), p=w / w.sum())))
        while len(chosen) < k:
            left = [min(sum((a - b) ** 2 for a, b in zip(p, x[c])) for c in chosen) for p in x]
            mass = np.array(left) * w
            tried = rng.choice(len(x), size=2 + int(np.log(k)), p=mass / mass.sum())
            potential = [sum(wi * min(li, sum((a - b) ** 2 for a, b in zip(p, x[t]))) for p, wi, li in zip(x, w, left)) for t in tried]
            chosen.append(int(tried[int(np.argmin(potential))]))
        assert np.array_equal(kmeans.greedy_centers(x, w, k, seed), x[chosen])


def test_empty_clusters_move_to_the_farthest_points(spark):
    rows = [(i, float(i % 4), 0.0) for i in range(40)] + [(100, 50.0, 0.0), (101, 0.0, 30.0), (102, 0.0, 30.0)]
    df = spark.createDataFrame(rows, "client_id long, a double, b double").repartition(4)
    start = np.array([[1.5, 0.0], [900.0, 900.0], [-800.0, 0.0]])           # two start empty
    x = np.array([r[1:] for r in rows])
    got = kmeans.lloyd(df, ["a", "b"], start, 1)
    assert got[1].tolist() == [50.0, 0.0] and got[2].tolist() == [0.0, 30.0]
    rest = np.delete(x, [40, 41], axis=0)                                     # the moved points no longer count where they were
    assert np.allclose(got[0], rest.mean(0))
    cost = [kmeans.inertia(df, ["a", "b"], kmeans.lloyd(df, ["a", "b"], start, n)).first().inertie for n in (0, 1, 2, 3)]
    assert cost == sorted(cost, reverse=True) and cost[1] < cost[0] / 5
    same = spark.range(6).selectExpr("id as client_id", "1.0D as a", "2.0D as b")
    assert np.array_equal(kmeans.lloyd(same, ["a", "b"], np.array([[1.0, 2.0], [9.0, 9.0]]), 2), [[1.0, 2.0], [9.0, 9.0]])    # nowhere to go


def test_fewer_points_than_clusters_is_a_clear_error(spark):
    for n in (0, 3):
        with pytest.raises(ValueError, match=f"{n} points are fewer than 4 clusters"):
            kmeans.fit_many(points(spark, n), ["a", "b"], [(4, 42)])


def test_equal_points_can_be_seeded(spark):
    df = spark.range(20).selectExpr("id as client_id", "1.0D as a", "2.0D as b")
    fit, = kmeans.fit_many(df, ["a", "b"], [(3, 42)])
    assert np.allclose(fit.centers, [[1.0, 2.0]] * 3) and fit.cost == 0.0


def test_reports_of_one_job_share_one_fit(spark, monkeypatch):
    from etoile.operators import classify
    calls = {"kmeans": 0, "tree": 0}
    fit_many, fit_tree = kmeans.fit_many, classify.fit_tree
    monkeypatch.setattr(kmeans, "fit_many", lambda *a, **k: (calls.__setitem__("kmeans", calls["kmeans"] + 1), fit_many(*a, **k))[1])
    monkeypatch.setattr(classify, "fit_tree", lambda *a, **k: (calls.__setitem__("tree", calls["tree"] + 1), fit_tree(*a, **k))[1])
    t = star_tables(spark, SF_SMALL)
    for name in reports.MINING:
        if name != "elbow_curve":
            REPORTS[name](t)
    assert calls == {"kmeans": 1, "tree": 1}
