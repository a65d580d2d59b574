"""The pipeline's stages against plain Python on a small fixture, and the whole on a given table."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline as cp
from etoile.llm import bpe
from test_signature_join import expected as near_groups

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")


def fixture():
    rnd = random.Random(6)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(120):
        w = [rnd.choice(words) for _ in range(rnd.randint(1, 60))]
        if rows and i % 3 == 0:
            w = rows[rnd.randrange(len(rows))][1].split()
            if i % 2 and w:
                w[rnd.randrange(len(w))] = "edit"
        rows.append((i, " ".join(w), rnd.choice(["en", "de", None]), f"s{i % 4}"))
    return [*rows, (500, None, "en", None), (501, "", "en", "s0"), (502, "", None, "s1")]


def ids(df):
    assert df.columns == COLUMNS
    return sorted(r.doc_id for r in df.collect())


def test_exact_dedup_stage(spark):
    rows = fixture()
    best = {}
    for i, t, *_ in rows:
        key = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        best[key] = max(best.get(key, -1), i)
    assert ids(cp.drop_copies(spark, docs(spark, rows), "")) == sorted(best.values())


def test_near_duplicate_stage(spark):
    rows = fixture()
    groups = near_groups([(i, t) for i, t, *_ in rows], 5, 80, 100)
    assert ids(cp.drop_near_copies(spark, docs(spark, rows), "")) == sorted(i for i, _, c, _ in groups if i == c)


def test_near_duplicate_stage_decides_by_row(spark):
    near = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    other = "one two three four five six seven eight nine ten eleven"
    rows = [(7, near + " end", "en", "s0"), (7, near, "en", "s0"), (None, near, "en", "s0"), (7, other, "en", "s1"), (3, other + " twelve", "en", "s1"),
            (7, "a clean text that is like no other one here", "en", "s2"), (None, near + " end", "de", "s0"), (None, None, "en", None), (None, "", "en", None),
            (9, "equal rows are one row in the end, said twice", "en", "s0"), (9, "equal rows are one row in the end, said twice", "en", "s0"),
            (None, "without id and with a copy of the same kind", "en", "s4"), (None, "without id and with a copy of the same kind", "de", "s4")]
    got = [(r.doc_id, r.text) for r in cp.drop_near_copies(spark, docs(spark, rows), "").collect()]
    texts = [t for _, t in got]
    assert sum((t or "").startswith("a b c") for t in texts) == 1 and next(i for i, t in got if (t or "").startswith("a b c")) == 7
    assert (3, other + " twelve") in got and (7, other) not in got
    assert sum(t == rows[5][1] for t in texts) == 1 and sum(not t for t in texts) == 2
    assert texts.count(rows[9][1]) == 1 and texts.count(rows[11][1]) == 1 and len(got) == 7


def test_mixing_stage_draws_by_probability(spark):
    from etoile.llm import mixing
    d = docs(spark, fixture())
    p = {r.doc_id: r.probability for r in mixing.probabilities(d).collect()}
    u = {i: int(hashlib.md5(str(i).encode()).hexdigest()[:13], 16) / 2 ** 52 for i in p}
    assert ids(cp.mix_sources(spark, d, "")) == sorted(i for i in p if u[i] < p[i])


def test_encoding_stage(spark):
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path(cp.VOCABULARY)), special_tokens={})
    rows = fixture()
    out = {r.doc_id: list(r.ids) for r in cp.encode_texts(spark, docs(spark, rows), "").collect()}
    assert out == {i: enc.encode_ordinary(t or "") for i, t, *_ in rows}


def test_encoding_stage_decodes_and_gives_offsets(spark):
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path(cp.VOCABULARY)), special_tokens={})
    rows = [*fixture(), (600, "naïve 日本語 🙂🙃 ñandú\n\t  x", "en", "s0")]
    out = cp.encode_texts(spark, docs(spark, rows), "")
    assert out.columns == ["doc_id", "ids", "starts", "ends", "text"]
    out = {r.doc_id: r for r in out.collect()}
    assert {i: r.text for i, r in out.items()} == {i: t or "" for i, t, *_ in rows}
    for i, t, *_ in rows:
        assert list(out[i].starts) == enc.decode_with_offsets(enc.encode_ordinary(t or ""))[1]
        assert len(out[i].ends) == len(out[i].ids) and max(out[i].ends, default=0) == len(t or "")


def test_quality_stage_keeps_good_documents(spark):
    sf = "/root/testdata/sf0.01"
    d = spark.read.parquet(f"{sf}/documents.parquet")
    kept = set(ids(cp.good_documents(spark, d, sf)))
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    good = [r.doc_id for r in labels if r.quality == 1 and r.toxic == 0]
    bad = [r.doc_id for r in labels if r.quality == 0 or r.toxic == 1]
    assert sum(i in kept for i in good) >= 0.98 * len(good) and sum(i in kept for i in bad) <= 0.1 * len(bad)


@pytest.mark.parametrize("name", [n for n, _ in cp.STAGES])
def test_stages_take_an_empty_table(spark, name):
    assert dict(cp.STAGES)[name](spark, docs(spark, []), "/root/testdata/sf0.001").count() == 0


def test_whole_run_is_the_stages_in_order(spark):
    sf = "/root/testdata/sf0.001"
    d = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in cp.STAGES[:-1]:
        d = docs(spark, [tuple(r) for r in stage(spark, d, sf).select("doc_id", "text", "lang", "source").collect()])
    want = sorted((r.doc_id, list(r.ids)) for r in cp.STAGES[-1][1](spark, d, sf).collect())
    assert sorted((r.doc_id, list(r.ids)) for r in cp.run(spark, sf).collect()) == want and want
