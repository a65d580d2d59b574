"""The exact decision tree against a search of every threshold in plain Python."""

from __future__ import annotations

import random

import pytest

from etoile.operators import tree

NUMERIC, CATEGORICAL = ["a", "b"], ["kind", "zone"]
LOW = float("-inf")


def number(v):
    return LOW if v is None or v != v else v


def brute(rows, weights, firsts, depth):
    """{node: (variable, level, threshold, counts)} from the definition."""
    out = {}

    def counts(part):
        return tuple(sum(r[0] == c for r in part) for c in weights)

    def side(n):
        w = [c * x for c, x in zip(n, weights.values())]
        total = 0.0
        for x in w:
            total += x * x
        return total / sum(w)

    def grow(node, part, level):
        best = None
        if level < depth and sum(c > 0 for c in counts(part)) > 1:
            cuts = []
            for f in (1, 2):
                values = sorted({number(r[f]) for r in part})
                cuts += [(f - 1, None, (x + y) / 2, [number(r[f]) <= (x + y) / 2 for r in part]) for x, y in zip(values, values[1:])]
            for f in (3, 4):
                for name in sorted({r[f] for r in part if r[f] is not None and r[f] != firsts[f - 3]}):
                    cuts.append((f - 1, name, 0.5, [r[f] != name for r in part]))
            cuts = [c for c in cuts if 0 < sum(c[3]) < len(part)]
            scored = [(-(side(counts([r for r, go in zip(part, c[3]) if go])) + side(counts([r for r, go in zip(part, c[3]) if not go]))), c[0], c[1] or "", c[2], i)
                      for i, c in enumerate(cuts)]
            best = cuts[min(scored)[4]] if scored else None
        out[node] = ((NUMERIC + CATEGORICAL)[best[0]] if best else None, best[1] if best else None, best[2] if best else None, counts(part))
        if best:
            grow(2 * node, [r for r, go in zip(part, best[3]) if go], level + 1)
            grow(2 * node + 1, [r for r, go in zip(part, best[3]) if not go], level + 1)
    if rows:
        grow(1, rows, 0)
    return out


def walk(nodes, row):
    n = 1
    while nodes[n][0] is not None:
        variable, name, cut, _ = nodes[n]
        v = row[1 + (NUMERIC + CATEGORICAL).index(variable)]
        n = 2 * n + ((number(v) if name is None else float(v == name)) > cut)
    return n


def some_rows(n, seed):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        a = rnd.choice([1.0, 1.0, rnd.randint(0, 40) / 4, None, float("nan")])                      # one value holds much
        b, kind, zone = rnd.randint(0, 1000) / 8, rnd.choice(["x", "y", "z", None]), rnd.choice(["n", "s"])
        out.append((int((a or 0) + b / 60 + (kind == "y") > rnd.uniform(2, 5)), a, b, kind, zone))
    return out


@pytest.mark.parametrize("n, slices", [(400, 2), (400, 9), (60, 3)])
def test_every_node_equals_brute_force(spark, n, slices):
    rows = some_rows(n, n)
    weights = {0: 0.75, 1: 1.5}
    df = spark.createDataFrame(rows, "y int, a double, b double, kind string, zone string").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(slices))
    try:
        g = tree.Grower("y", weights, NUMERIC, {"kind": "x", "zone": "n"})
        nodes = g.grow(df, 4)
        got = {r.node: (r.variable, r.niveau, r.seuil, (r.n_0, r.n_1)) for r in nodes.collect()}
        want = brute(rows, weights, ("x", "n"), 4)
        assert got == want
        leaf = {r.node: r.prediction for r in nodes.collect()}
        predicted = sorted((str(r[:5]), r.prediction) for r in g.predict(df, nodes, 4).collect())
        assert predicted == sorted((str(tuple(r)), leaf[walk(want, r)]) for r in map(tuple, df.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_pure_constant_and_empty_training_sets(spark):
    g = tree.Grower("y", {0: 1.0, 1: 1.0}, NUMERIC, {"kind": "x", "zone": "n"})
    schema = "y int, a double, b double, kind string, zone string"
    assert g.grow(spark.createDataFrame([], schema), 3).collect() == []
    pure = g.grow(spark.createDataFrame([(1, float(i), 0.0, "y", "n") for i in range(5)], schema), 3).collect()
    assert [(r.node, r.feuille, r.prediction) for r in pure] == [(1, True, 1)]
    same = g.grow(spark.createDataFrame([(i % 2, 1.0, 2.0, None, "n") for i in range(6)], schema), 3).collect()
    assert [(r.node, r.feuille, r.prediction, r.gini) for r in same] == [(1, True, 0, 0.5)]


def test_importances_are_shares_of_the_impurity_taken_away(spark):
    nodes = spark.createDataFrame([(1, 0, "a", None, 1.0, False, 10.0, 0.5), (2, 1, None, None, None, True, 4.0, 0.0), (3, 1, "kind", "y", 0.5, False, 6.0, 0.4),
                                   (6, 2, None, None, None, True, 3.0, 0.2), (7, 2, None, None, None, True, 3.0, 0.0)],
                                  "node int, depth int, variable string, niveau string, seuil double, feuille boolean, poids double, gini double")
    names = spark.createDataFrame([("a",), ("b",), ("kind_y",)], "variable string")
    got = {r.variable: round(r.importance, 9) for r in tree.importances(nodes, names).collect()}
    a, kind = 10 * 0.5 - 6 * 0.4, 6 * 0.4 - 3 * 0.2
    assert got == {"a": round(a / (a + kind), 9), "b": 0.0, "kind_y": round(kind / (a + kind), 9)}


@pytest.mark.parametrize("slices", [2, 5, 50])
def test_few_slices_give_the_same_tree(spark, monkeypatch, slices):
    rows, weights = some_rows(300, 7), {0: 0.75, 1: 1.5}
    df = spark.createDataFrame(rows, "y int, a double, b double, kind string, zone string").repartition(3)
    monkeypatch.setattr(tree, "SLICES", slices)
    nodes = tree.Grower("y", weights, NUMERIC, {"kind": "x", "zone": "n"}).grow(df, 3)
    assert {r.node: (r.variable, r.niveau, r.seuil, (r.n_0, r.n_1)) for r in nodes.collect()} == brute(rows, weights, ("x", "n"), 3)


def test_search_opens_few_values_where_a_split_is_clear(spark, monkeypatch):
    """Stored and exchanged counts follow the slices, not the distinct values."""
    rnd, stored = random.Random(4), []
    rows = [(int(i % 1000 > 400), float(i % 1000) + rnd.random() / 2, rnd.random(), "x", "n") for i in range(6000)]
    df = spark.createDataFrame(rows, "y int, a double, b double, kind string, zone string")
    real = tree.materialize

    def spy(frame, name="table"):
        out = real(frame, name)
        if name != "tree-rows":
            stored.append(out.count())
        return out
    monkeypatch.setattr(tree, "SLICES", 64)
    monkeypatch.setattr(tree, "materialize", spy)
    nodes = tree.Grower("y", {0: 1.0, 1: 1.0}, NUMERIC, {"kind": "x", "zone": "n"}).grow(df, 2).collect()
    assert (nodes[0].variable, nodes[0].n_0, nodes[0].n_1) == ("a", 2406, 3594) and 400.5 < nodes[0].seuil < 401
    assert max(stored) <= 2 * 64 + 2
