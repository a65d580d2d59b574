from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from etoile.llm import merkle, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, index long, level int, hash string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(hashes):
    """All levels over the hashes, from the definition."""
    levels = [hashes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def climbed(levels, i, h):
    proof = []
    for level in levels[:-1]:
        run = level[i // 2 * 2:i // 2 * 2 + 2]
        proof += [x for at, x in enumerate(run) if at != i % 2]
        h = H(*[h if at == i % 2 else x for at, x in enumerate(run)])
        i //= 2
    return proof, h


def brute(rows):
    def leaf(d, text, lang, source, n):
        return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (d, source, lang, n, text)])
    trees = {}
    for d, text, lang, source, n in rows:
        more = n + 1 if n is not None and d is not None and zlib.crc32(str(d).encode()) % 7 == 0 else n
        trees.setdefault(lang, []).append(((d is not None, d or 0), leaf(d, text, lang, source, n), leaf(d, text, lang, source, more), d))
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {g: tree([x[1] for x in sorted(trees[g], key=lambda x: x[:2])]) for g in order}
    top = tree([built[g][-1][0] for g in order]) if order else []
    out = []
    for at, g in enumerate(order):
        for i, (_, h, other, d) in enumerate(sorted(trees[g], key=lambda x: x[:2])):
            under, folded = climbed(built[g], i, other)
            over, folded = climbed(top, at, folded)
            out.append((d, h, built[g][-1][0], top[-1][0], H(*under, *over), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def found(spark, tmp_path, rows):
    df = spark.createDataFrame([(*r, "x", 1, 1, "x") for r in rows], SCHEMA)
    df.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in queries.QUERIES["op13_merkle"](spark, str(tmp_path)).collect()), key=str)


def some_rows(n, seed):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice([None, "", "é" * 5, f"text {i}", "a" * 200_000 if i == 3 else "z"]), rnd.choice(["en", "en", "en", None, "", "é", "zz"]),
             rnd.choice([None, "s1"]), rnd.choice([None, i])) for i in range(n)]
    return rows + [rows[0], rows[0], (None, "no id", "en", "s", 3), (None, "no id", "en", "s", 3), (5, "same id", "en", "s", 3), (77, "alone", "only", "s", 1)]


@pytest.mark.parametrize("n, levels", [(40, 10), (150, 2), (150, 1), (60, 3)])
def test_equals_brute_force(spark, tmp_path, monkeypatch, n, levels):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", levels)
    rows = some_rows(n, n + levels)
    assert found(spark, tmp_path, rows) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_small_trees(spark, tmp_path, n):
    rows = [(i * 7, "t", "en", None, i) for i in range(n)]
    assert found(spark, tmp_path, rows) == brute(rows)


def test_missing_is_the_minimal_union():
    rnd = random.Random(4)
    for size in (1, 2, 3, 7, 16, 37):
        levels = tree([H(str(i)) for i in range(size)])
        for _ in range(20):
            leaves = sorted(rnd.sample(range(size), rnd.randint(1, size)))
            names = merkle.missing(np.array(leaves), size)
            given = {(level, i): levels[level][i] for level, i in names}
            paths = merkle.expand({i: levels[0][i] for i in leaves}, size, given)          # enough: every proof comes out
            assert all(merkle.fold(levels[0][i], p) == levels[-1][0] for i, p in paths.items())
            held = [{i >> up for i in leaves} for up in range(len(levels))]
            assert all(i not in held[level] and i ^ 1 in held[level] for level, i in names) and len(set(names)) == len(names)   # none can be left out


def test_a_block_of_a_hot_group_asks_for_few_nodes(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 4)
    docs = spark.range(3000).select(F.lit("=en").alias("tree"), F.col("id").alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"),
                                    F.lit(None).cast("string").alias("other"))
    m = merkle.build(docs)
    assert m.leaves.count() == 3000 and m.nodes.where("tree = '=en'").count() < 2 * 3000 / 16 + 10
    out = merkle.prove(m)
    assert out.where("folded_root <> root").count() == 0 and out.select("key").distinct().count() == 3000
