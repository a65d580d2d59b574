"""Rows and frames that the tests share (a plain module: both test folders have a conftest)."""

from __future__ import annotations

import datetime as dt

from etoile.sources.schemas import RAW_COLUMNS

SF_SMALL = "/root/testdata/sf0.001"


def ts(text: str | None):
    return None if text is None else dt.datetime.fromisoformat(text)


def raw_tables(spark, **rows) -> dict:
    """Raw source frames from Python rows, typed as the CSV reader types them.

    Missing tables are empty. Ids are strings, as in the source CSVs.
    """
    from pyspark.sql import types as T

    out = {}
    for table, cols in RAW_COLUMNS.items():
        schema = T.StructType([T.StructField(n, t, True) for n, t in cols])
        out[table] = spark.createDataFrame(rows.get(table, []), schema)
    return out


def order(oid, cust, status="delivered", bought="2018-01-10 10:00:00", delivered="2018-01-15 10:00:00"):
    return (oid, cust, status, ts(bought), ts(delivered), ts("2018-02-01 00:00:00"))


def item(oid, n, prod="p1", seller="s1", price=10.0, freight=1.0):
    return (oid, n, prod, seller, price, freight)


def collect_sorted(df, *cols):
    return [tuple(r) for r in df.orderBy(*cols).collect()] if cols else sorted(tuple(r) for r in df.collect())
