from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from etoile import session
from etoile.llm import signature_join as sj
from etoile.llm.components import components
from llm_helpers import documents


def sets(rows, k):
    out = []
    for i, t in rows:
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").encode().split()
        out.append((i, {tuple(w[a:a + k]) for a in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())))
    return out


def expected(rows, k, num, den):
    s = sets(rows, k)
    label = list(range(len(s)))
    def find(a):
        while label[a] != a:
            a = label[a]
        return a
    links = [0] * len(s)
    for a in range(len(s)):
        for b in range(a):
            x, y = s[a][1], s[b][1]
            if x and y and den * len(x & y) >= num * len(x | y):
                label[find(a)] = find(b)
                links[a] += 1
                links[b] += 1
    groups = {}
    for a, (i, x) in enumerate(s):
        groups.setdefault(find(a), []).append(i)
    return sorted((i, len(x), min((g for g in groups[find(a)] if g is not None), default=None), links[a]) for a, (i, x) in enumerate(s))


def rows_of(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in df.collect()), key=str)


def corpus(seed, n=150):
    rnd = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(300)]
    passage = [rnd.choice(vocabulary) for _ in range(40)]
    rows, texts = [], []
    for i in range(n):
        w = [rnd.choice(vocabulary) for _ in range(rnd.choice([0, 1, 2, 3, 4, 8, 30, 60, 120, 200]))]
        if texts and rnd.random() < 0.6:
            w = list(rnd.choice(texts))                                # near copies, and copies of copies: chains
            for _ in range(rnd.randint(0, max(1, len(w) // 40))):
                if w:
                    w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
        if rnd.random() < 0.3:
            w += passage
        texts.append(w)
        rows.append((rnd.randint(0, 10 ** 6) * 1000 + i, " ".join(w).upper() if rnd.random() < 0.2 else " ".join(w)))
    return [*rows, (7, None), (8, ""), (9, "one"), (10, "One"), (11, "one two"), (12, " \t")]


@pytest.mark.parametrize(("k", "num", "den"), [(3, 90, 100), (5, 80, 100)])
def test_components_equal_brute_force(spark, k, num, den):
    rows = corpus(1)
    assert rows_of(sj.jaccard_components(documents(spark, rows), k, num, den)) == sorted(expected(rows, k, num, den), key=str)


def test_hot_groups_meet_in_parts_and_blocks(spark, monkeypatch):
    rnd = random.Random(3)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(rnd.choice([1, 1, 2, 3])):                       # near the threshold: some pairs link, some do not
            w[rnd.randrange(100)] = f"e{i}x{rnd.randrange(5)}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(base)) for i in range(40)]
    monkeypatch.setattr(sj, "BUCKET", 16)
    monkeypatch.setattr(sj, "BLOCK", 16)
    for num in (90, 93, 95):
        assert rows_of(sj.jaccard_components(documents(spark, rows), 3, num, 100)) == sorted(expected(rows, 3, num, 100), key=str)


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(5, "a b c d"), (5, "a b c d"), (5, "x y z"), (None, "A b c d"), (None, "q r s"), (4, "a b c d")]
    out = sj.jaccard_components(documents(spark, rows))
    assert rows_of(out) == sorted([(5, 2, 4, 3), (5, 2, 4, 3), (5, 1, 5, 0), (None, 2, 4, 3), (None, 1, None, 0), (4, 2, 4, 3)], key=str)
    assert len({r.class_id for r in out.collect()}) == 3
    assert sj.jaccard_components(documents(spark, [])).collect() == []


def test_only_shared_buckets_are_written_when_sieves_are_full(spark, monkeypatch):
    rows, sieve, write, tables = corpus(5), sj.sieve, sj.materialize, {}

    def full(keys, **kind):
        out = sieve(keys, **kind)
        return spark.sparkContext.broadcast(type(out.value)(np.full(1 << 24, 255, dtype=np.uint8)))

    def kept(df, name="table"):
        out = write(df, name)
        if name == "routed":
            tables[name] = out.groupBy("token").count().collect()
        return out

    monkeypatch.setattr(sj, "sieve", full)
    monkeypatch.setattr(sj, "materialize", kept)
    got = rows_of(sj.jaccard_components(documents(spark, rows), 5, 80, 100))
    assert got == sorted(expected(rows, 5, 80, 100), key=str)
    assert tables["routed"] and all(r["count"] > 1 for r in tables["routed"])


def test_only_the_result_and_components_stay_written(spark):
    before = set(session._FOLDERS)
    out = sj.jaccard_components(documents(spark, corpus(6)), 5, 80, 100)
    names = sorted(f.rsplit("/", 1)[1].split("-")[1] for f in session._FOLDERS - before)
    assert set(names) <= {"classes", "edges", "small"} and names.count("classes") == 1
    assert out.count() == len(corpus(6))


@pytest.mark.parametrize(("num", "den"), [(80, 100), (90, 100), (99, 100), (1, 2)])
def test_linked_sets_share_a_bucket(num, den):
    rnd = np.random.default_rng(11)
    classes = rnd.integers(0, 50, 1 << sj.SKETCH_BITS).astype(np.uint16)
    for size in [*range(1, 60), *rnd.integers(60, 3000, 150).tolist()]:
        a = np.unique(rnd.integers(0, 1 << 62, size).astype(np.uint64))
        most = int(len(a) * (1 - num / den) / 2)
        gone, new = rnd.integers(0, 2 * most + 1), rnd.integers(0, most + 1)
        b = np.unique(np.concatenate([rnd.permutation(a)[gone:], rnd.integers(0, 1 << 62, new).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if not len(b) or both * den < num * (len(a) + len(b) - both):
            continue
        batch = pa.RecordBatch.from_arrays([pa.array([len(a), len(b)]), pa.array([sj._prefix(s, classes, num, den).view(np.int64) for s in (a, b)])], ["size", "route"])
        row, keys = sj._bucket_keys(batch, num, den)
        assert np.intersect1d(keys[row == 0], keys[row == 1]).size


def test_overlaps_are_exact(monkeypatch):
    rnd = np.random.default_rng(4)
    some = [np.unique(rnd.integers(0, 200, n).astype(np.uint64)) for n in rnd.integers(1, 150, 40)] + [np.array([10 ** 9], dtype=np.uint64)]
    a, b = (x.reshape(-1) for x in np.meshgrid(np.arange(41), np.arange(41)))
    truth = [len(np.intersect1d(some[i], some[j])) for i, j in zip(a, b)]
    for gathered in (1 << 21, 100, 1):
        monkeypatch.setattr(sj, "GATHERED", gathered)
        got = sj.Overlap(some)(a, b)
        assert all(x == t for x, t, i, j in zip(got, truth, a, b) if i != j)


def test_very_long_texts_link(spark):
    base = [f"w{i % 7919}x{i % 101}" for i in range(200_000)]
    other = base[:]
    other[1000] = "edit"
    rows = [(1, " ".join(base)), (2, " ".join(other)), (3, " ".join(base[:150_000])), (4, "short text here")]
    got = rows_of(sj.jaccard_components(documents(spark, rows)))
    assert [r[0::2] for r in got] == [(1, 1), (2, 1), (3, 3), (4, 4)] and [r[3] for r in got] == [1, 1, 0, 0]


def test_traversal_keeps_every_link():
    rnd = np.random.default_rng(0)
    base = [np.unique(rnd.integers(0, 1 << 63, n).astype(np.uint64)) for n in rnd.integers(1, 400, 60)]
    some = base + [np.unique(np.concatenate([b[: max(1, int(len(b) * 0.95))], rnd.integers(0, 1 << 63, len(b) // 30).astype(np.uint64)])) for b in base]
    size = np.array([len(s) for s in some])
    groups = sj.Groups(np.arange(len(some)))
    found = {(int(a), int(b)) for x, y in sj.pairs_of(size, [sj.bitmap(s) for s in some], 80, 100, groups) for a, b in zip(x, y)}
    found |= {(b, a) for a, b in found}
    links = 0
    for a in range(len(some)):
        for b in range(a):
            both = len(np.intersect1d(some[a], some[b]))
            if both * 100 >= 80 * (size[a] + size[b] - both):
                links += 1
                assert (a, b) in found
    assert links >= 40 and len(found) < len(some) ** 2 / 4


def test_components_of_chains_stars_and_loops(spark):
    rnd = random.Random(9)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 700)] + [(900, 901), (901, 902), (902, 900), (950, 950)]
    rnd.shuffle(edges)
    out = {r.node: r.label for r in components(spark.createDataFrame([(b, a) if rnd.random() < .5 else (a, b) for a, b in edges], "u long, v long")).collect()}
    assert all(out[i] == 100 for i in range(100, 161)) and all(out[i] == 500 for i in range(500, 700))
    assert out[901] == out[902] == out[900] == 900 and 950 not in out
