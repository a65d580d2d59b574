"""Data-quality operators: the star schema's declared constraints, run as queries (Q1-Q6).

The source declares keys, foreign keys, CHECK ranges, NOT NULL and defaults in its DDL but
loads the tables with "replace", so none of them is enforced. Here each constraint is a
query that counts its violations; a clean warehouse gives zeros.

Output of Q1-Q4: ``(table_name, check_name, nb_violations)``, one row per check, always
present (zero when clean). Every check is one aggregate per table (partial + final), so
it scales with the table and a hot key combines map-side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etoile.sources.schemas import DEFAULTS, FOREIGN_KEYS, PRIMARY_KEYS, RANGE_CHECKS, not_null_columns

CHECK_COLUMNS = ["table_name", "check_name", "nb_violations"]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _unpivot_counts(table: str, counts: DataFrame, checks: list[str]) -> DataFrame:
    """One-row frame of per-check counts -> one row per check."""
    long = counts.unpivot([], checks, "check_name", "nb_violations")
    return long.select(F.lit(table).alias("table_name"), "check_name",
                       F.coalesce(F.col("nb_violations"), F.lit(0)).cast("long").alias("nb_violations"))


def primary_key_duplicates(tables: dict[str, DataFrame], keys: dict[str, list[str]] = PRIMARY_KEYS) -> DataFrame:
    """Q1: per table, the number of key values held by more than one row."""
    parts = []
    for table, key in keys.items():
        dup = tables[table].groupBy(*key).count().filter(F.col("count") > 1)
        parts.append(dup.agg(F.count(F.lit(1)).alias("nb_violations"))
                     .select(F.lit(table).alias("table_name"), F.lit("pk_" + "_".join(key)).alias("check_name"),
                             "nb_violations"))
    return _union(parts)


def foreign_key_orphans(tables: dict[str, DataFrame], fact: str = "FAIT_VENTES",
                        fks: list[tuple[str, str, str]] = FOREIGN_KEYS) -> DataFrame:
    """Q2: fact rows whose (non-null) foreign key has no row in the dimension.

    The fact is counted per key first (combined map-side, so a hot key is one row per task), then
    the keys are anti-joined: no fact row is shuffled for the join.
    """
    parts = []
    for col, dim, dim_col in fks:
        keys = tables[dim].select(F.col(dim_col).alias(col))
        held = tables[fact].filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("nb"))
        orphans = held.join(keys, col, "left_anti")
        parts.append(orphans.agg(F.coalesce(F.sum("nb"), F.lit(0)).cast("long").alias("nb_violations"))
                     .select(F.lit(fact).alias("table_name"), F.lit(f"fk_{col}_{dim}").alias("check_name"),
                             "nb_violations"))
    return _union(parts)


def range_violations(tables: dict[str, DataFrame], checks=RANGE_CHECKS) -> DataFrame:
    """Q3: values outside their CHECK range; NULL passes, as in SQL. One pass per table."""
    by_table: dict[str, list] = {}
    for table, col, lo, hi in checks:
        by_table.setdefault(table, []).append((col, lo, hi))
    parts = []
    for table, cols in by_table.items():
        names = [f"range_{c}" for c, _lo, _hi in cols]
        counts = tables[table].agg(*[
            F.count(F.when(~F.col(c).between(lo, hi), F.lit(1))).alias(n)
            for (c, lo, hi), n in zip(cols, names)])
        parts.append(_unpivot_counts(table, counts, names))
    return _union(parts)


def null_violations(tables: dict[str, DataFrame], names=None) -> DataFrame:
    """Q4: NULLs in NOT NULL columns, all columns of a table in one pass."""
    parts = []
    for table in names or PRIMARY_KEYS:
        cols = [c for c in not_null_columns(table) if c in tables[table].columns]
        checks = [f"not_null_{c}" for c in cols]
        counts = tables[table].agg(*[F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(n)
                                     for c, n in zip(cols, checks)])
        parts.append(_unpivot_counts(table, counts, checks))
    return _union(parts)


def apply_defaults(df: DataFrame, table: str) -> DataFrame:
    """Q5: the declared column defaults, applied to missing values."""
    return df.fillna(DEFAULTS.get(table, {}))


def table_counts(tables: dict[str, DataFrame], names=None) -> DataFrame:
    """``(table_name, nb)``, one count per table, unioned."""
    names = list(names or tables.keys())
    return _union([tables[n].agg(F.count(F.lit(1)).alias("nb")).select(F.lit(n).alias("table_name"), "nb")
                   for n in names])

