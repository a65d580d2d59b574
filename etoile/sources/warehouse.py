"""Warehouse of Parquet tables: loads in versions, the reader of the current one, SQL views.

Each load writes its five tables and the order roll-up under a folder of its own, ``load-<id>``, and is then named by one small row
appended to ``_loads``. Readers take the load named last. A load that fails is never named, so the tables before it stay readable as a whole.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STAR_NAMES = ("DIM_TEMPS", "DIM_CLIENT", "DIM_PRODUIT", "DIM_VENDEUR", "FAIT_VENTES")
ROLLUPS = ("FAIT_COMMANDES",)     # derived from the fact: one row per order, for reports by month, region, quarter or client
KEEP_LOADS = 2          # the current load and the one before it (for readers that began on it)


def new_load(root: str) -> str:
    """Folder of a load that is not named yet."""
    return f"{root.rstrip('/')}/load-{uuid.uuid4().hex}"


def _named(spark: SparkSession, root: str) -> list[str]:
    """Folders of the named loads, the last one first."""
    rows = spark.read.schema("at long, load string").json(f"{root.rstrip('/')}/_loads")
    return [f"{root.rstrip('/')}/{r.load}" for r in rows.orderBy(F.desc("at"), F.desc("load")).limit(100).collect()]


def name_load(spark: SparkSession, folder: str) -> None:
    """Make a written load the current one, and delete loads before the last two."""
    root, load = folder.rsplit("/", 1)
    spark.range(1).select(F.lit(time.time_ns()).alias("at"), F.lit(load).alias("load")).write.mode("append").json(f"{root}/_loads")
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for old in _named(spark, root)[KEEP_LOADS:]:
        path = spark._jvm.org.apache.hadoop.fs.Path(old)
        path.getFileSystem(conf).delete(path, True)


def read_star(spark: SparkSession, root: str, names=(*STAR_NAMES, *ROLLUPS)) -> dict[str, DataFrame]:
    """The tables of the current load."""
    folder = _named(spark, root)[0]
    return {n: spark.read.parquet(f"{folder}/{n}") for n in names}


def register_views(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, sql: str, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """Run SQL over the warehouse tables (registered as temp views) and return a frame."""
    if tables:
        register_views({n: df for n, df in tables.items() if n in STAR_NAMES})
    return spark.sql(sql)
