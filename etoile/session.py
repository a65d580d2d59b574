"""Session helpers: one place that decides Spark settings for local runs and tests."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
import weakref

from pyspark.sql import SparkSession


_WRITTEN: dict[int, str] = {}     # frames of materialize() and their folders
_FOLDERS: set[str] = set()        # all folders of materialize() that are still there


def build_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "etoile",
                  extra: dict | None = None) -> SparkSession:
    """The session of a job, a test or the bench.

    Settings that were submitted (``spark-submit``, or ``PYSPARK_SUBMIT_ARGS`` with a master) stand: the defaults
    here are for runs without. Explicit arguments win.
    """
    submitted = "PYSPARK_GATEWAY_PORT" in os.environ or "--master" in os.environ.get("PYSPARK_SUBMIT_ARGS", "")
    builder = SparkSession.builder
    defaults = {
        "spark.app.name": app,
        "spark.master": "local[*]",
        "spark.driver.memory": os.environ.get("ETOILE_DRIVER_MEMORY", "16g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
    }
    chosen = {"spark.master": master, "spark.sql.shuffle.partitions": shuffle_partitions}
    for k, v in {**({} if submitted else defaults), **chosen, **(extra or {})}.items():
        if v is not None:
            builder = builder.config(k, str(v))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The folder for intermediate tables, as ``spark.checkpoint.dir`` names it.

    On a cluster that setting must name storage that every executor shares; without it this
    raises. Only a local master falls back to a scratch folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    try:
        context = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        raise RuntimeError("set spark.checkpoint.dir to a folder the cluster shares") from None
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder the cluster shares")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="etoile-ckpt-", dir="/tmp"))
    return context.getCheckpointDir()


def materialize(df, name: str = "table"):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    A written table cuts the lineage like ``checkpoint()`` does, but stays columnar and
    compressed, and the planner sees its real size (file statistics) when it chooses joins.
    """
    spark = df.sparkSession
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/etoile-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _WRITTEN[id(out)] = path
    _FOLDERS.add(path)
    weakref.finalize(out, _WRITTEN.pop, id(out), None)
    return out


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
    _FOLDERS.discard(path)


def dematerialize(df) -> None:
    """Delete the table behind a frame of ``materialize``, once every result that reads it is written."""
    path = _WRITTEN.pop(id(df), None)
    if path:
        _delete(df.sparkSession, path)


def clear_materialized(spark: SparkSession) -> None:
    """Delete every table that ``materialize`` wrote in this process: at the end of a job."""
    for path in list(_FOLDERS):
        _delete(spark, path)


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, as a zip, for functions that run there (once per session)."""
    if getattr(spark, "_etoile_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    made = shutil.make_archive(f"{tempfile.mkdtemp(prefix='etoile-code-')}/etoile", "zip", root, "etoile")
    spark.sparkContext.addPyFile(made)
    spark._etoile_shipped = True
