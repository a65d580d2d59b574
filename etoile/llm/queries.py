"""The operators as registered queries over whole tables, with DuckDB SQL where it can express them."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from etoile.llm import bpe, conversations, ctw, exact_dedup, forest, licences, merkle, mixing, ordinal, repeats, sanitise, signature_join, topk
from etoile.llm.oracle import ORACLE  # noqa: F401 (part of this module's interface)
from etoile.llm.text import small_batches
from etoile.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def query(fn):
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        small_batches(spark)
        return fn(spark, sf_dir)
    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in documents; with ``revealing_terms``, the number of term spans."""
    return (sanitise.find_spans(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", F.size("terms").alias("revealing_terms")))


@query
def op2_signature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_join.jaccard_components(table(spark, sf_dir, "documents"), k=3, num=90, den=100).drop("class_id")


@query
def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree: source / language / thousands of the id / id."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 1000), "doc_id")
    out = licences.scan(docs.select(F.col("doc_id").alias("file"), path.alias("path"), "text"))
    return out.select(F.col("file").alias("doc_id"), "license", "origin", F.round("cosine", 6).alias("cosine"))


@query
def op4_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = ordinal.graded(table(spark, sf_dir, "labels"))
    return (ordinal.grade(table(spark, sf_dir, "documents"), labels)
            .select("doc_id", "expected_grade", "tail", "selected"))


@query
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@query
def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), digests=True).withColumnRenamed("kept", "kept_sha256")


@query
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


@query
def op8_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(table(spark, sf_dir, "documents"))


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.probabilities(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("mix_source").alias("source"), F.col("mix_language").alias("language"), F.col("mix_topic").alias("topic"),
                      F.col("mix_tokens").alias("tokens"), F.round("probability", 9).alias("probability"), "drawn")


@query
def op10_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.neighbours(table(spark, sf_dir, "embeddings"))


@query
def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with the faults that the checksum of ``conv_id:turn`` gives each row; nulls are one space."""
    def plain(column: str):
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn"))) % 20
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = rows.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"), code.alias("code")).where("code <> 0")
    return rows.select("conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


@query
def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversations.report(conversations.repair(damaged(rows), rows.select("conv_id")))


@query
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents under a tree per language; rows whose id's checksum is divisible by seven are checked with one more in n_chars."""
    key, n = F.col("doc_id"), F.col("n_chars")
    fields = [key, F.col("source"), F.col("lang"), n, F.col("text")]
    tampered = F.crc32(key.cast("string")) % 7 == 0
    docs = table(spark, sf_dir, "documents").select(
        merkle.tree_name(F.col("lang")).alias("tree"), key.alias("key"), merkle.digest(*fields).alias("leaf"),
        F.when(tampered, merkle.digest(*fields[:3], n + 1, *fields[4:])).alias("other"))
    out = merkle.prove(merkle.build(docs))
    return out.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", F.sha2(F.concat_ws("", "proof"), 256).alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))
