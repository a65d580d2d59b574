"""Operator 9, mixing sources to target weights: iterative proportional fitting, then calibrated sampling. Native.

Documents are summed to cells (source, language, topic) of tokens. Raking scales the cells' weights to the target shares of each
margin in turn, ``SWEEPS`` times. A cell's ratio of raked weight to tokens, divided by the largest ratio, is the probability of its documents: at most 1,
so nothing is capped and the expected tokens of the sample have the raked margins. A document is drawn by a uniform number that is a digest of its id.

Targets of languages and topics are parameters (levels that are not named are one level ``other``, which keeps its observed share unless it has a target), so these margins have a bounded number of levels and their sums
may visit the driver. Sources may be many: their targets are shares of the observed ones to the power ``SOURCE_POWER`` (1: as observed, 0: all alike), and
their factors never leave the executors. Each sweep reads the written cell table, one row per cell that occurs. A source that holds a
third of the rows is one row per cell and task before it is shuffled.

Rules. A null source, language or topic is a level of its own, ``(none)``; null text has no tokens and probability of its cell. A cell without tokens
has probability 1, as it weighs nothing. Equal ids, and so repeated rows, are drawn alike; a null id reads as ``null``. A
target for a level that does not occur has no effect. An empty table gives an empty result. Other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from etoile.llm.components import sized
from etoile.session import materialize

SWEEPS = 12
SOURCE_POWER = 0.7
LANGUAGES = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}
TOPICS = {"prose": 0.9, "table": 0.05, "other": 0.05}
NONE = "(none)"


def topic_of(text: Column) -> Column:
    """The form of a text as its topic: cells between bars are a table, marks after the words are noise, else prose."""
    return (F.when(text.isNull(), F.lit("other")).when(F.instr(text, " | ") > 0, "table")
            .when((F.instr(text, "!! ") > 0) | (F.instr(text, "### ") > 0) | (F.instr(text, "*** ") > 0), "other").otherwise("prose"))


def _levels(column: Column, targets: dict[str, float]) -> Column:
    level = F.coalesce(column, F.lit(NONE))
    return F.when(level.isin(*targets), level).otherwise("other")


def _by(level: str, factors: dict[str, float]) -> Column:
    out = F.lit(None).cast("double")
    for k, f in sorted(factors.items()):
        out = F.when(F.col(level) == k, F.lit(f)).otherwise(out)
    return F.coalesce(out, F.lit(1.0))


def _shares(sums: dict[str, float], targets: dict[str, float]) -> dict[str, float]:
    """Targets of the levels that occur, as shares of the whole; ``other`` keeps its observed share if it has no target."""
    whole = sum(sums.values())
    there = {k: targets[k] for k, v in sums.items() if v > 0 and k in targets}
    free = {k: v / whole for k, v in sums.items() if v > 0 and k not in targets}
    total, left = sum(there.values()), 1.0 - sum(free.values())
    return {k: t / total * left for k, t in there.items()} | (free if there else {k: f / sum(free.values()) for k, f in free.items()})


def _sums(cells: DataFrame, level: str, weight: Column) -> dict[str, float]:
    return {r[0]: r[1] for r in cells.groupBy(level).agg(F.sum(weight)).collect()}      # named levels only


def rake(cells: DataFrame, languages: dict[str, float], topics: dict[str, float], source_power: float = SOURCE_POWER,
         sweeps: int = SWEEPS) -> DataFrame:
    """(source, language, topic, tokens) -> the same and ``weight``, a share of 1."""
    own = F.sum("tokens").over(W.partitionBy("source"))
    grand = cells.agg(F.sum("tokens")).first()[0] or 0
    if not grand:
        return cells.withColumn("weight", F.lit(0.0))
    power = cells.groupBy("source").agg(F.sum("tokens").alias("n")).agg(F.sum(F.pow(F.col("n") / F.lit(float(grand)), F.lit(source_power)))).first()[0]
    cells = cells.withColumn("aim", F.pow(own / F.lit(float(grand)), F.lit(source_power)) / F.lit(power))
    tokens = F.col("tokens").cast("double")
    aim_l, aim_t = (_shares(_sums(cells, k, tokens), t) for k, t in (("language", languages), ("topic", topics)))
    by_l, by_t = dict.fromkeys(aim_l, 1.0), dict.fromkeys(aim_t, 1.0)
    for _ in range(sweeps):
        now = tokens * _by("language", by_l) * _by("topic", by_t)
        a = cells.withColumn("now", now).withColumn("within", F.sum("now").over(W.partitionBy("source")))
        a = a.withColumn("a", F.when(F.col("within") > 0, F.col("aim") / F.col("within")).otherwise(0.0))
        held = _sums(a, "language", F.col("a") * F.col("now"))
        by_l = {k: by_l[k] * aim_l[k] / held[k] if held.get(k, 0) > 0 else by_l[k] for k in by_l}
        held = _sums(a, "topic", F.col("a") * tokens * _by("language", by_l) * _by("topic", by_t))
        by_t = {k: by_t[k] * aim_t[k] / held[k] if held.get(k, 0) > 0 else by_t[k] for k in by_t}
    return (a.withColumn("weight", F.col("a") * tokens * _by("language", by_l) * _by("topic", by_t))
            .select("source", "language", "topic", "tokens", "weight"))


def probabilities(docs: DataFrame, languages: dict[str, float] = LANGUAGES, topics: dict[str, float] = TOPICS,
                  source_power: float = SOURCE_POWER, sweeps: int = SWEEPS, carry: list[str] | None = None) -> DataFrame:
    """Every row's doc_id, ``carry`` columns, mix_source, mix_language, mix_topic, mix_tokens, probability and drawn."""
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), *(carry or []),
        F.coalesce(F.col("source").cast("string"), F.lit(NONE)).alias("mix_source"),
        _levels(F.col("lang").cast("string"), languages).alias("mix_language"),
        _levels(topic_of(text), topics).alias("mix_topic"),
        F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("mix_tokens"))
    keys = ["mix_source", "mix_language", "mix_topic"]
    if not carry:
        rows = materialize(rows, "mix-rows")              # short columns: the texts are scanned once
    cells = materialize(rows.groupBy(*keys).agg(F.sum("mix_tokens").alias("tokens"))
                        .toDF("source", "language", "topic", "tokens"), "cells")
    cells = sized(cells, cells.count())            # few cells are one partition, which the sweeps need not shuffle
    raked = rake(cells, languages, topics, source_power, sweeps).where("tokens > 0").withColumn("ratio", F.col("weight") / F.col("tokens"))
    raked = materialize(raked.select("source", "language", "topic", "ratio"), "ratios")
    most = raked.agg(F.max("ratio")).first()[0] or 1.0
    share = F.coalesce(F.col("ratio") / F.lit(most), F.lit(1.0))
    joined = rows.join(raked.toDF(*keys, "ratio"), keys, "left")
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    uniform = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    return joined.select("doc_id", *(carry or []), *keys, "mix_tokens", share.alias("probability"), (uniform < share).alias("drawn"))

