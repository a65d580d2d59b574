"""Queries with SQL: Spark result == DuckDB result on sf0.001; all are registered with the contract's columns."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as E
from etoile.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    1: ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"], 2: ["doc_id", "n_shingles", "component_id"],
    5: ["doc_id", "keep_id", "group_size", "kept", "text_sha256"], 6: ["doc_id", "n_words", "n_removed", "kept_sha256"],
    7: ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    8: ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"], 10: ["query_id", "rank", "vec_id", "score"],
    11: ["query_id", "rank", "vec_id", "score"], 12: ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
    13: ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]}
LONG = {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "n_shingles", "component_id", "keep_id", "group_size", "n_words", "n_removed", "n_tokens",
        "n_known", "train_tokens", "query_id", "vec_id", "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"}


def test_all_operators_and_the_pipeline_are_registered():
    names = E.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13 and "pipeline" in names


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_contract_columns(spark, name):
    df = QUERIES[name](spark, SF)
    n = int(name[2:].split("_")[0])
    assert df.columns[:len(COLUMNS.get(n, []))] == COLUMNS.get(n, [])
    types = dict(df.dtypes)
    assert all(types[c] == "bigint" for c in COLUMNS.get(n, []) if c in LONG)
    if n == 12:
        assert df.count() == spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct().count()
    elif n not in (10, 11):
        assert df.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    df = QUERIES[name](spark, SF)
    res = con.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(res.columns)
    a = sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=str)
    at = [res.columns.index(c) for c in sorted(res.columns)]
    b = sorted((tuple(r[i] for i in at) for r in res.fetchall()), key=str)
    assert a == b
