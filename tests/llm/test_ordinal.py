from __future__ import annotations

import random

import numpy as np

from etoile.llm import ordinal
from llm_helpers import documents

INSULTS = ["plonker", "numpty", "wazzock", "pillock"]


def corpus(n, seed=0):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    rows, grades = [], []
    for i in range(n):
        w = [rnd.choice(words) for _ in range(rnd.randint(20, 80))]
        g = rnd.choice([0, 1, 2, 2])
        if g == 0:
            w = [x.upper() + "!!" for x in w]
        if g == 1:
            for x in rnd.sample(INSULTS, 2):
                w.insert(rnd.randrange(len(w)), x)
        rows.append((seed * 100_000 + i, " ".join(w)))
        grades.append((seed * 100_000 + i, g))
    return rows, grades


def test_held_out_grades(spark):
    rows, grades = corpus(900)
    new, truth = corpus(300, seed=1)
    labels = spark.createDataFrame(grades, "doc_id long, grade int")
    out = {r.doc_id: r for r in ordinal.grade(documents(spark, rows + new), labels).collect()}
    assert len(out) == 1200
    right = sum(out[i].selected == (g == 2) for i, g in truth)
    assert right >= 0.97 * len(truth)
    mean = [np.mean([out[i].expected_grade for i, g in truth if g == k]) for k in range(3)]
    assert mean[0] < mean[1] < mean[2] and all(0 <= out[i].tail <= out[i].expected_grade <= 2 for i, _ in truth)


def loss(p, x, text, column, columns, grade):
    """Penalised negative log likelihood per row, from the definition: weights, share weights, then the thresholds."""
    w, u, theta = p[:columns], p[columns:columns + x.shape[1]], p[columns + x.shape[1]:]
    score = np.bincount(text, weights=w[column], minlength=len(grade)) + x @ u
    above = np.concatenate([np.ones((len(grade), 1)), 1 / (1 + np.exp(theta - score[:, None])), np.zeros((len(grade), 1))], axis=1)
    prob = above[np.arange(len(grade)), grade] - above[np.arange(len(grade)), grade + 1]
    return -np.log(prob).mean() + 0.5 * ordinal.RIDGE * ((w ** 2).sum() + (u ** 2).sum())


def test_fit_is_no_worse_than_small_moves_of_its_parameters():
    """By finite differences of the likelihood in every parameter."""
    rnd = np.random.default_rng(0)
    buckets = [np.unique(rnd.integers(0, 30, 8)) for _ in range(400)]
    text, column = np.repeat(np.arange(400), [len(b) for b in buckets]), np.concatenate(buckets)
    grade = np.digitize(np.array([(b < 6).sum() - (b > 24).sum() for b in buckets]) + rnd.normal(size=400), [-0.5, 1.0])
    x = rnd.normal(size=(400, 3))
    p = np.concatenate(ordinal._fit(x, text, column, 30, grade))
    least = loss(p, x, text, column, 30, grade)
    for i in range(len(p)):
        for move in (-0.05, 0.05):
            moved = p.copy()
            moved[i] += move
            assert loss(moved, x, text, column, 30, grade) > least - 1e-6
    assert p[:6].min() > 0.3 and p[25:30].max() < -0.3


def test_screened_buckets_and_ordered_thresholds(monkeypatch):
    monkeypatch.setattr(ordinal, "SCREEN", 0.0)
    rnd = np.random.default_rng(0)
    buckets = [np.unique(rnd.integers(0, 30, 8)).astype(np.int32) for _ in range(400)]
    score = np.array([(b < 6).sum() - (b > 24).sum() for b in buckets]) + rnd.normal(size=400)
    grade = np.digitize(score, [-0.5, 1.0])
    model = ordinal._optimise(buckets, rnd.normal(size=(400, len(ordinal.SHARES))), grade)
    assert (np.diff(model.thresholds) > 0).all()
    assert model.buckets.tolist() == list(range(30))                # nothing is screened off
    low, high = (model.weights[np.isin(model.buckets, r)].mean() for r in (range(6), range(25, 30)))
    assert low > 0.3 and high < -0.3


def test_sample_is_bounded_and_result_covers_all(spark):
    rows, grades = corpus(300)
    labels = spark.createDataFrame(grades, "doc_id long, grade int")
    assert ordinal.grade(documents(spark, rows), labels, sample_rows=100).count() == 300


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "a b"), (3, "x" * 200_000), (4, "a b c")]
    none = spark.createDataFrame([], "doc_id long, grade int")
    out = ordinal.grade(documents(spark, rows), none).collect()
    assert len(out) == 6 and all(r.selected for r in out) and len({round(r.tail, 9) for r in out}) == 1
    some = spark.createDataFrame([(1, 0), (4, 2), (4, None), (None, 1), (99, 1), (2, 2)], "doc_id long, grade int")
    assert ordinal.grade(documents(spark, rows), some).count() == 6
    assert ordinal.grade(documents(spark, []), some).count() == 0
    labels = spark.createDataFrame([(1, 0, 0), (2, 1, 1), (3, 1, 0), (4, None, 0), (5, 1, None)], "doc_id long, quality int, toxic int")
    assert [r.grade for r in ordinal.graded(labels).orderBy("doc_id").collect()] == [0, 1, 2, None, None]


def test_given_labels_are_learned(spark):
    d = "/root/testdata/sf0.1"
    labels = ordinal.graded(spark.read.parquet(f"{d}/labels.parquet")).where("grade is not null")
    fold = labels.selectExpr("*", "pmod(xxhash64(doc_id), 5) = 0 as held")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    out = ordinal.grade(docs, fold.where("not held")).join(fold.where("held"), "doc_id").select("selected", "grade").collect()
    good = [r.selected for r in out if r.grade == 2]
    bad = [r.selected for r in out if r.grade < 2]
    print("kept of good", np.mean(good), "kept of bad", np.mean(bad), len(good), len(bad))
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.15
