from __future__ import annotations

import random

import numpy as np

from etoile.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tokens long, weight double, topic string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, source, 1, 1, 1.0, "x") for i, t, lang, source in rows], SCHEMA)


def corpus(n=3000):
    rnd = random.Random(1)
    rows = []
    for i in range(n):
        source = "s0" if i % 3 == 0 else f"s{rnd.randint(1, 5)}"                # a third from one source
        lang = rnd.choice(["en", "en", "en", "de", "fr", "xx", None])
        sep = " | " if rnd.random() < 0.2 else " "
        rows.append((i, sep.join(["w"] * rnd.randint(1, 40)), lang, source))
    return rows


def test_expected_tokens_have_the_raked_margins(spark):
    languages, topics = {"en": 0.3, "de": 0.3, "fr": 0.2, "other": 0.2}, {"prose": 0.6, "table": 0.4}
    out = mixing.probabilities(frame(spark, corpus()), languages, topics, source_power=0.5, sweeps=40).toPandas()
    w = out["mix_tokens"] * out["probability"]
    for column, targets in (("mix_language", languages), ("mix_topic", topics)):
        got = w.groupby(out[column]).sum() / w.sum()
        assert all(abs(got[k] - t) < 1e-6 for k, t in targets.items())
    tokens = out["mix_tokens"].groupby(out["mix_source"]).sum()
    aim = (tokens / tokens.sum()) ** 0.5
    got = w.groupby(out["mix_source"]).sum() / w.sum()
    assert np.allclose(got, aim / aim.sum(), atol=1e-6)
    assert out["probability"].max() == 1.0 and (out["probability"] > 0).all()
    drawn = out["mix_tokens"][out["drawn"]].sum()
    assert abs(drawn / w.sum() - 1) < 0.1


def test_raking_equals_brute_force(spark):
    rows = corpus(400)
    out = mixing.probabilities(frame(spark, rows), mixing.LANGUAGES, mixing.TOPICS, sweeps=5).toPandas()
    cells = out.groupby(["mix_source", "mix_language", "mix_topic"])["mix_tokens"].sum().astype(float)
    w = cells.copy()
    def targets(level, given):
        seen = dict(cells.groupby(level=level).sum() / cells.sum())
        free = {k: v for k, v in seen.items() if k not in given}                     # no target: the observed share stays
        named = sum(given[k] for k in seen if k in given)
        return free | {k: given[k] / named * (1 - sum(free.values())) for k in seen if k in given}
    share = cells.groupby(level=0).sum() / cells.sum()
    aims = [dict((share ** 0.7) / (share ** 0.7).sum()), targets(1, mixing.LANGUAGES), targets(2, mixing.TOPICS)]
    for _ in range(5):
        for level, aim in enumerate(aims):
            total = w.groupby(level=level).transform("sum")
            w = w * [aim[i[level]] for i in w.index] / total
    ratio = w / cells
    want = (ratio / ratio.max()).to_dict()
    for r in out.itertuples():
        assert abs(r.probability - want[r.mix_source, r.mix_language, r.mix_topic]) < 1e-12


def test_edge_cases(spark):
    rows = [(1, None, None, None), (2, "", "en", "s"), (3, "a b", "en", "s"), (3, "a b", "en", "s"), (None, "c | d", "zz", None)]
    out = mixing.probabilities(frame(spark, rows), carry=["text", "lang", "source", "n_chars"]).collect()
    assert len(out) == 5 and all(0 <= r.probability <= 1 for r in out)
    assert {r.mix_source for r in out} == {"s", "(none)"} and {r.mix_tokens for r in out} == {0, 2, 3}
    twins = [r.drawn for r in out if r.doc_id == 3]
    assert len(twins) == 2 and len(set(twins)) == 1
    assert mixing.probabilities(frame(spark, [])).collect() == []
    assert all(r.drawn for r in mixing.probabilities(frame(spark, [(1, None, "en", "s"), (2, "", "de", "s")])).collect())


def test_no_python_on_the_executors(spark):
    out = mixing.probabilities(frame(spark, corpus(100)))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
