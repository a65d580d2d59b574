from __future__ import annotations

import math
import random

import pytest

from etoile.llm import topk


def vectors(spark, rows):
    """Rows with other columns of names that the operator uses inside."""
    return spark.createDataFrame([(i, v, 1, "x", 7) for i, v in rows], "vec_id long, embedding array<double>, row int, vector string, n int")


def brute(rows, every, k, scale=256):
    """Every query against every other row, in Python's integers."""
    whole = [(n, i, [math.floor(scale * x) for x in v]) for n, (i, v) in enumerate(rows)
             if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, v in whole:
        if i is not None and i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), j is None, j or 0) for m, j, w in whole if m != n and len(w) == len(v))[:k]
            out += [(i, r, None if null else j, -s) for r, (s, null, j) in enumerate(scored, 1)]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


BAD = [(500, None), (600, [1.0, None]), (700, [float("nan"), 1.0]), (800, [1.0, float("inf")])]


def test_equals_brute_force_with_ties_nulls_and_repeated_rows(spark):
    rnd = random.Random(1)
    rows = [(i, [rnd.uniform(-2, 2) for _ in range(2)]) for i in range(80)]
    rows += [(100 + i, [1.0, 0.5]) for i in range(60)] + [(100, [1.0, 0.5]), (None, [1.0, 0.5]), (200, [0.0, 0.0]), (210, []), (220, []), (230, [1.0])]
    df = vectors(spark, rows + BAD).repartition(7)
    assert found(topk.search(df, every=10)) == brute(rows + BAD, 10, 5)


def test_few_candidates_and_empty_table(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (50, [0.25, -1.0])]
    assert found(topk.search(vectors(spark, rows))) == brute(rows, 50, 5)
    assert topk.search(vectors(spark, [])).collect() == []
    assert topk.search(vectors(spark, BAD)).collect() == []


def test_scores_beyond_double_precision_are_exact(spark):
    rnd = random.Random(2)
    rows = [(i, [rnd.uniform(-2, 2) * 2.0 ** 20 for _ in range(3)]) for i in range(60)]
    assert found(topk.search(vectors(spark, rows), every=10)) == brute(rows, 10, 5)
    rows = [(0, [1e300, 1.0]), (1, [1e300, -1.0]), (2, [-1e300, 0.0])]
    assert [tuple(r)[:3] for r in topk.search(vectors(spark, rows)).orderBy("rank").collect()] == [(0, 1, 1), (0, 2, 2)]


@pytest.mark.parametrize("bins, queries, chunk", [(2, 3, 5), (7, 1000, 16)])
def test_bins_blocks_and_chunks_do_not_change_the_result(spark, monkeypatch, bins, queries, chunk):
    rnd = random.Random(3)
    rows = [(i, [1.0, 1.0, 0.0] if i % 3 == 0 else [rnd.uniform(-1, 1) for _ in range(3)]) for i in range(300)]      # a third alike
    for name, value in (("BINS", bins), ("BLOCK_QUERIES", queries), ("CHUNK_ROWS", chunk)):
        monkeypatch.setattr(topk, name, value)
    assert found(topk.search(vectors(spark, rows).repartition(5), every=30)) == brute(rows, 30, 5)


def test_close_scores_of_many_rows_give_whole_answers(spark):
    rnd = random.Random(5)
    rows = [(i, [1.0 + rnd.random() / 8 for _ in range(16)]) for i in range(3000)]
    assert found(topk.search(vectors(spark, rows).repartition(3), every=500)) == brute(rows, 500, 5)


def test_scores_of_the_whole_64_bit_range_and_huge_components_are_exact(spark):
    rows = [(50, [2.0 ** 23]), (1, [2.0 ** 24 - 1]), (2, [2.0 ** 23 + 0.5]), (3, [-2.0 ** 24]), (4, [0.0]), (5, [1.0])]
    want = brute(rows, 50, 5)
    assert 2 ** 62 < max(r[3] for r in want) < 2 ** 63 and min(r[3] for r in want) == -2 ** 63
    assert found(topk.search(vectors(spark, rows))) == want
    rows = [(50, [2.0, -1.0, 0.25]), (1, [1e300, 2e300, 7.0]), (2, [3e300, 6e300, 9.5]), (3, [0.5, 0.25, 0.0]), (4, [1.7e308 / 2, 1.7e308, -3.0])]
    want = [(50, 1, 2, 64 * 2432), (50, 2, 1, 64 * 1792), (50, 3, 3, 512 * 128 - 256 * 64), (50, 4, 4, -64 * 768)]
    assert found(topk.search(vectors(spark, rows))) == sorted(want, key=str)
