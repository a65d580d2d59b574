from __future__ import annotations

import hashlib
import random

from etoile.llm.exact_dedup import exact_groups

from llm_helpers import documents


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    return sorted((i, max(g := groups[lower(t)]), len(g), i == max(g), hashlib.sha256(lower(t).encode()).hexdigest())
                  for i, t in rows)


def got(df):
    return sorted(tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())


def test_groups_equal_brute_force_for_every_number_of_blocks(spark):
    rnd = random.Random(1)
    bases = ["".join(rnd.choice("abAB é") for _ in range(n)) for n in (0, 1, 3, 4, 5, 8, 9, 16, 17, 33, 64, 100)]
    rows = [(i, b) for i, b in enumerate(bases * 2)]
    rows += [(100 + i, b.swapcase()) for i, b in enumerate(bases)]
    rows += [(200 + i, b[:-1] + "z") for i, b in enumerate(bases) if b]            # differ in the last block
    rows += [(300 + i, b + b) for i, b in enumerate(bases)]                          # blocks of others, in other number
    rows += [(400, None), (401, ""), (402, "É"), (403, "é")]
    assert got(exact_groups(documents(spark, rows), block_bytes=4)) == expected(rows)


def test_hot_group_and_long_text(spark):
    long = "word " * 50_000
    rows = [(i, "the same text") for i in range(300)] + [(1000, long), (1001, long.upper()), (1002, long + "x")]
    assert got(exact_groups(documents(spark, rows))) == expected(rows)


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(1, "a"), (1, "a"), (1, "b"), (None, "a"), (None, "c"), (2, "q")]
    out = exact_groups(documents(spark, rows)).collect()
    a = [r for r in out if r.text_sha256 == hashlib.sha256(b"a").hexdigest()]
    assert [r.group_size for r in a] == [3, 3, 3] and [r.keep_id for r in a] == [1, 1, 1]
    assert sorted((r.doc_id is None, r.kept) for r in a) == [(False, False), (False, True), (True, False)]
    assert sorted((r.doc_id, r.group_size) for r in out if r.text_sha256 != a[0].text_sha256 and r.doc_id) == [(1, 1), (2, 1)]
    assert exact_groups(documents(spark, [])).collect() == []
