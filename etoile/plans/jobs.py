"""Batch jobs: raw sources -> star schema written as Parquet -> reports over the warehouse.

The warehouse is the hand-off between the ETL and every report (as the source's database
file is): the star is computed once, written, and each report reads the written tables,
so reports never re-run the ETL, and a report job that loses an executor re-reads
Parquet instead of recomputing joins.

On a cluster: ``spark-submit --master ... --conf spark.checkpoint.dir=SHARED --py-files etoile.zip
etoile/plans/jobs.py ...``; master, memory and shuffle settings are the submitted ones.

Usage::

    python -m etoile.plans.jobs etl --csv RAW_DIR --warehouse OUT_DIR [--files orders=my_orders.csv ...] [--rejects FOLDER]
    python -m etoile.plans.jobs etl --testdata SF_DIR --warehouse OUT_DIR
    python -m etoile.plans.jobs reports --warehouse OUT_DIR --out REPORT_DIR [names...]
    python -m etoile.plans.jobs dashboard --warehouse OUT_DIR --out CHART_DIR [--region Sudeste]
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from etoile.functions.lookups import ALL_REGIONS
from etoile.operators import kpis, star
from etoile.operators.dashboard import dashboard_frames
from etoile.plans.reports import MINING, REPORTS, Tables
from etoile.session import clear_materialized, materialize
from etoile.sources.csv import read_raw_csv, reject_counts, rejected_of_all
from etoile.sources.testdata import raw_from_testdata
from etoile.sources.warehouse import STAR_NAMES, name_load, new_load, read_star


def layout_for_write(name: str, df: DataFrame) -> DataFrame:
    """Physical layout of each warehouse table.

    The fact leaves the ETL hash-partitioned by order (its last joins are on the order
    key); rows are sorted inside each partition by date key and client, so Parquet row
    groups carry tight min/max statistics for date-range and client filters (pushed down
    to the scan) without a global sort. Dimensions are written as they come.
    """
    if name == "FAIT_VENTES":
        return df.sortWithinPartitions("temps_id", "client_id")
    return df


def run_etl(spark: SparkSession, raw: dict[str, DataFrame], warehouse: str) -> dict[str, str]:
    """B26 + A9: build the five tables, write them and the order roll-up, and make them the current load (see ``sources.warehouse``).

    A load that fails leaves the tables of the load before it readable. The date dimension is written first and read back to key the fact (its surrogate keys
    are then exactly the written ones, and the dates are not derived twice). The per-order
    table is staged in the checkpoint folder before the one large join (items ⋈ orders), so
    that join reads two plain shuffles (AQE can split a hot order) and an executor lost
    during it does not recompute the order-side joins.
    """
    root = new_load(warehouse)
    temps_path = f"{root}/DIM_TEMPS"
    star.dim_temps(star.delivered_orders(raw["orders"])).write.parquet(temps_path)
    tables = star.build_star(raw, temps=spark.read.parquet(temps_path), stage=materialize)
    paths = {"DIM_TEMPS": temps_path}
    for name in STAR_NAMES:
        if name == "DIM_TEMPS":
            continue
        path = f"{root}/{name}"
        layout_for_write(name, tables[name]).write.parquet(path)
        paths[name] = path
    orders = kpis.order_rollup(spark.read.parquet(paths["FAIT_VENTES"]))
    paths["FAIT_COMMANDES"] = f"{root}/FAIT_COMMANDES"
    orders.sortWithinPartitions("temps_id", "client_id").write.parquet(paths["FAIT_COMMANDES"])
    name_load(spark, root)
    return paths


def reports(spark: SparkSession, warehouse: str, names=None, with_mining: bool = True) -> dict[str, DataFrame]:
    """Every report (or ``names``) over the written warehouse, lazily; features, fits and predictions are made once for all."""
    tables = Tables(read_star(spark, warehouse))
    names = list(names or [n for n in REPORTS if with_mining or n not in MINING])
    return {n: REPORTS[n](tables) for n in names}


def dashboard(spark: SparkSession, warehouse: str, region: str = ALL_REGIONS) -> dict[str, DataFrame]:
    """The dashboard's frames over the written warehouse: base aggregates computed once and
    persisted, every chart derived from them (see ``dashboard.dashboard_frames``)."""
    t = read_star(spark, warehouse)
    return dashboard_frames(t["FAIT_VENTES"], t["DIM_TEMPS"], t["DIM_CLIENT"], t["DIM_PRODUIT"], region, t["FAIT_COMMANDES"])


def write_reports(frames: dict[str, DataFrame], out: str) -> None:
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{out.rstrip('/')}/{name}")


def main(argv=None) -> int:
    from etoile.session import build_session

    ap = argparse.ArgumentParser(prog="etoile.plans.jobs")
    sub = ap.add_subparsers(dest="cmd", required=True)
    e = sub.add_parser("etl")
    src = e.add_mutually_exclusive_group(required=True)
    src.add_argument("--csv")
    src.add_argument("--testdata")
    e.add_argument("--warehouse", required=True)
    e.add_argument("--files", nargs="*", default=[], metavar="TABLE=FILE", help="names of the CSV files that differ from TABLE.csv")
    e.add_argument("--rejects", help="folder for the records and cells of the CSV files that could not be read, as Parquet")
    r = sub.add_parser("reports")
    r.add_argument("--warehouse", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("names", nargs="*")
    d = sub.add_parser("dashboard")
    d.add_argument("--warehouse", required=True)
    d.add_argument("--out", required=True)
    d.add_argument("--region", default=ALL_REGIONS)
    a = ap.parse_args(argv)
    spark = build_session()
    if a.cmd == "etl":
        files = dict(f.split("=", 1) for f in a.files)
        raw = read_raw_csv(spark, a.csv, files) if a.csv else raw_from_testdata(spark, a.testdata, delivered_only=True)
        run_etl(spark, raw, a.warehouse)
        if a.csv and a.rejects:
            rejected_of_all(spark, a.csv, files).write.mode("overwrite").parquet(a.rejects)
            for row in reject_counts(spark.read.parquet(a.rejects)).orderBy("table_name", "column_name", "reason").collect():     # a row per column
                print("rejected", *row)
        counts = read_star(spark, a.warehouse)
        for n, df in counts.items():
            print(n, df.agg(F.count(F.lit(1))).first()[0])
    elif a.cmd == "reports":
        write_reports(reports(spark, a.warehouse, a.names or None), a.out)
    else:
        write_reports(dashboard(spark, a.warehouse, a.region), a.out)
    clear_materialized(spark)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
