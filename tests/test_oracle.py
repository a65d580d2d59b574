"""Every registered query with an oracle: Spark result == DuckDB result on sf0.001.

Column names, row counts and the multiset of rows (exact values) must all match; the
driver runs the same comparison at sf0.01 (``tools/check_oracle.py`` does it locally).
"""

from __future__ import annotations

import os
import sys

import duckdb
import pytest
from helpers import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, rows_of  # noqa: E402

from etoile.plans.registry import ORACLE, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield con
    con.close()


def test_every_query_is_registered_with_a_callable():
    qs = E.queries()
    assert len(QUERIES) >= 90 and set(QUERIES) <= set(qs)
    assert set(ORACLE) <= set(QUERIES) and set(E.oracle_sql()) <= set(qs)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = duck.sql(ORACLE[name])
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(res.columns)
    assert len(srows) == len(drows)
    assert rows_of(df.columns, srows) == rows_of(res.columns, drows)


def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    assert df.columns == ["annee", "mois", "nom_mois", "region", "ca_total", "nb_commandes", "panier_moyen"]
    assert df.count() > 0
