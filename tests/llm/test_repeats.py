from __future__ import annotations

import random
import re

import numpy as np
import pytest

from etoile.llm import repeats
from etoile.llm.lists import pack, unpack
from llm_helpers import documents


def expected(rows, k):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    least = {}
    big = float("inf")
    for i, w in words:
        for s in range(len(w) - k + 1):
            key = tuple(w[s:s + k])
            least[key] = min(least.get(key, big), big if i is None else i)
    out = []
    for i, w in words:
        gone = set()
        for s in range(len(w) - k + 1):
            if (big if i is None else i) > least[tuple(w[s:s + k])]:
                gone.update(range(s, s + k))
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus():
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)] + ["é", "Ä", "W1"]
    def text(n):
        return [rnd.choice(vocabulary) for _ in range(n)]
    passage, line = text(60), text(15)
    rows = []
    for i in range(120):
        w = text(rnd.randint(0, 80))
        if i % 3 == 0:                                        # a passage of a third of the rows
            at = rnd.randint(0, len(w))
            w[at:at] = passage
        if i % 7 == 0:
            w += line * 3                                     # repeats inside one document do not count by themselves
        if i % 11 == 0:
            w += passage[10:10 + rnd.randint(3, 20)]
        rows.append((1000 - i, rnd.choice([" ", "\n", "\t "]).join(w)))
    rows += [(5, rows[3][1]), (6, rows[3][1]), (6, rows[3][1]), (None, rows[3][1]), (None, rows[4][1]), (7, None), (8, ""), (9, " \n ")]
    rows += [(2000, " ".join(text(30_000) + passage))]        # very long
    return rows


def test_removed_words_equal_brute_force(spark):
    rows = corpus()
    for k in (13, 4):
        assert got(repeats.remove_repeats(documents(spark, rows), k=k)) == expected(rows, k)


def test_small_blocks_and_a_full_sketch_change_nothing(spark, monkeypatch):
    rows = corpus()
    plain = got(repeats.remove_repeats(documents(spark, rows)))
    import etoile.llm.repeats as r
    for name, value in (("SKETCH_BITS", 10), ("SLICE_BITS", 8)):
        monkeypatch.setattr(r, name, value)
    h = np.random.default_rng(0).integers(0, 1 << 63, 5000).astype(np.uint64)
    parts = list(r._partial_sketch(13)([]))
    assert parts == []
    counts = {}
    for cells in r._counters(h):
        assert cells.max() < 1 << 10
        counts[len(counts)] = np.bincount(cells, minlength=1 << 10)
    assert plain == expected(rows, 13)


def test_empty_table(spark):
    assert repeats.remove_repeats(documents(spark, [])).collect() == []


@pytest.mark.parametrize("n", [0, 1, 1000])
def test_lists_round_trip(n):
    rnd = np.random.default_rng(n)
    a = np.sort(rnd.integers(0, 1 << 62, n).astype(np.uint64))
    b = rnd.integers(0, 1 << 31, n).astype(np.uint32)
    x, y = unpack(pack(a, b), np.uint64, np.uint32)
    assert (x == a).all() and (y == b).all()
