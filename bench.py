"""Benchmark: ETL to a Parquet warehouse, then every report over it; prints one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8),
``BENCH_REPEAT`` (timed runs per SQL report, best kept; default 2), ``BENCH_MINING``
(0 to skip the model-fitting reports).

Each report is executed in full with the ``noop`` sink (every row computed, nothing
collected to the driver). ``etl`` is the whole star build + write; ``flagship_from_raw``
is KPI 1 straight from the test tables (the driver's ``entry`` path); ``dashboard_all_cached``
is every dashboard frame from base aggregates computed once (the dashboard job). The model reports run as one job,
in order: each of the two fits counts for the first report that uses it.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from etoile.plans import jobs  # noqa: E402
from etoile.plans.registry import QUERIES  # noqa: E402
from etoile.plans.reports import MINING, REPORTS, Tables  # noqa: E402
from etoile.session import build_session, checkpoint_root, clear_materialized  # noqa: E402
from etoile.sources.testdata import raw_from_testdata  # noqa: E402
from etoile.sources.warehouse import read_star  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return round(time.perf_counter() - t0, 3)


#: Not timed from the warehouse: they read the given tables (or write and read files) themselves.
FROM_RAW = [n for n in QUERIES if n not in REPORTS]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))
    with_mining = os.environ.get("BENCH_MINING", "1") != "0"
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=2 * cpus, app="etoile-bench")
    # the shared folder the session names (a scratch one only when unset, as in local runs)
    warehouse = f"{checkpoint_root(spark).rstrip('/')}/etoile-bench-{uuid.uuid4().hex}/warehouse"

    times: dict[str, float] = {}

    def best(make) -> float:
        """Building the frame is part of the time: some reports run jobs while they are built."""
        return min(timed(lambda: run(make())) for _ in range(repeat))

    # warm-up (JVM, codegen caches): the flagship once from the raw tables
    run(QUERIES["kpi1_ca_mensuel_region"](spark, sf_dir))
    times["flagship_from_raw"] = timed(lambda: run(QUERIES["kpi1_ca_mensuel_region"](spark, sf_dir)))
    times["etl"] = timed(lambda: jobs.run_etl(spark, raw_from_testdata(spark, sf_dir, delivered_only=True), warehouse))
    for name in FROM_RAW:
        times[name] = best(lambda n=name: QUERIES[n](spark, sf_dir))
    for name in REPORTS:
        if name not in MINING:
            times[name] = best(lambda n=name: jobs.reports(spark, warehouse, names=[n])[n])

    def dashboard_all():
        frames = jobs.dashboard(spark, warehouse)
        for df in frames.values():
            run(df)
        spark.catalog.clearCache()
    times["dashboard_all_cached"] = timed(dashboard_all)
    if with_mining:
        # one job: features, segments and tree are made by the first report that needs them
        tables = Tables(read_star(spark, warehouse))
        for name in MINING:
            times[name] = timed(lambda n=name: run(REPORTS[n](tables)))
    clear_materialized(spark)

    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "suite_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf.group(1)) if sf else sf_dir, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
