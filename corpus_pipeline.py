"""The corpus pipeline: documents through five operators, each stage written and read again by the next.

Every stage works on all rows of the stage before; all but the last return the columns of ``documents``.

Rules of all stages: null texts count as empty, texts of any length are whole, an empty table gives an empty result, other columns are left out. Quality classifier: repeated rows and ties are judged
alike; without labels all stay. Exact dedup: empty and null texts are equal; of equal texts the row with the largest id stays (null ids last), of equal rows one. Near copies: documents without words are linked with nothing and
stay; of each group exactly one row stays, that of the smallest id (null ids last, ties by a hash of the row), whatever other rows share its id. Mixing: equal ids are drawn alike. Encoding: each row is on its own.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from etoile.llm import bpe, exact_dedup, mixing, ordinal, signature_join
from etoile.llm.queries import VOCABULARY
from etoile.llm.sieve import without
from etoile.llm.text import small_batches
from etoile.session import dematerialize, materialize, ship_package

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stage(fn):
    @functools.wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return fn(spark, docs, sf_dir)
    return run


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose top grade (good and not toxic) is more likely than not; the others go."""
    labels = ordinal.graded(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return ordinal.grade(docs, labels, carry=["lang", "source", "n_chars"]).where("selected").select(*COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id stays."""
    return exact_dedup.distinct_texts(docs.select(*COLUMNS), COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles with similarity 0.8 or more, one row stays: that of the smallest id.

    Rows are told apart by a 64-bit hash of all their columns, not by id. Of rows equal in every column that are to stay, one does.
    """
    docs = docs.select(*COLUMNS, F.xxhash64(*COLUMNS).alias("row_key"))
    linked = signature_join.jaccard_components(docs, k=5, num=80, den=100, carry=("row_key",))
    groups = linked.where("class_id IS NOT NULL and n_links > 0").select("doc_id", "row_key", "class_id")
    first = F.min_by("row_key", F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("kept_key")
    firsts = groups.groupBy("class_id").agg(first)
    gone = materialize(groups.join(firsts, "class_id").where("row_key <> kept_key").select("row_key").distinct(), "near-copies")
    again = (groups.groupBy("row_key", "class_id").count().where("count > 1").join(firsts, "class_id").where("row_key = kept_key").select("row_key"))
    again = materialize(again, "equal-rows")
    dematerialize(linked)
    out = without(docs, "row_key", gone.union(again))
    if not again.isEmpty():
        out = out.union(docs.join(again, "row_key", "left_semi").dropDuplicates(["row_key"]).select(out.columns))
    return out.select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose expected tokens have the target shares of sources, languages and topics."""
    return mixing.probabilities(docs, carry=["text", "lang", "source", "n_chars"]).where("drawn").select(*COLUMNS)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids of every text, their offsets, and the text decoded from the ids."""
    return bpe.round_trip(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [(name, stage(fn)) for name, fn in (
    ("quality_classifier", good_documents), ("exact_dedup", drop_copies), ("ngram_jaccard_join", drop_near_copies), ("mix_sources", mix_sources), ("byte_bpe", encode_texts))]

#: The fitted classifier and the token ids are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from all of ``documents``."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, make in STAGES[:-1]:
        before, docs = docs, materialize(make(spark, docs, sf_dir), "stage")
        dematerialize(before)
    return STAGES[-1][1](spark, docs, sf_dir)
