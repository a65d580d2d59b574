"""The order roll-up: same reports as from the fact, nothing grouped by the order again."""

from __future__ import annotations

import re

import pytest
from helpers import SF_SMALL, item, order, raw_tables

from etoile.operators import kpis, star
from etoile.plans import jobs
from etoile.plans.registry import QUERIES, star_tables
from etoile.plans.reports import REPORTS, Tables
from etoile.sources.testdata import raw_from_testdata

NAMES = ["kpi1_ca_mensuel_region", "kpi6_ca_trimestriel", "dash_ca", "dash_trend", "client_profile", "trend_index"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_aggregate_on_the_order_in_the_plan(spark, name):
    df = QUERIES[f"commandes_{name}"](spark, SF_SMALL)
    grouped = [line for line in plan(df).splitlines() if "Aggregate" in line or "Exchange hashpartitioning" in line]
    assert grouped and not any(re.search(r"keys=\[[^\]]*commande_id|hashpartitioning\([^)]*commande_id", line) for line in grouped)


def test_the_job_writes_the_rollup_and_its_reports_read_it(spark, tmp_path):
    wh = f"{tmp_path}/wh"
    jobs.run_etl(spark, raw_from_testdata(spark, SF_SMALL, delivered_only=True), wh)
    lazily = star_tables(spark, SF_SMALL)
    for name, df in jobs.reports(spark, wh, NAMES).items():
        assert "ca_exact" in plan(df) and "prix_unitaire" not in plan(df)
        assert rows(df) == rows(REPORTS[name](lazily))


def test_missing_values_and_items_without_price(spark):
    raw = raw_tables(spark, orders=[order("o1", "c1"), order("o2", "c1", delivered=None), order("o3", "c2")], customers=[("c1", "x", "SP"), ("c2", "y", None)],
                     items=[item("o1", 1), item("o1", 2, price=None), item("o2", 1, price=5.55, freight=None), item("o3", 1, price=2.0)],
                     reviews=[("o1", 5), ("o1", 4)], products=[("p1", None, None)], sellers=[("s1", "z", "SP")])
    t = Tables(star.build_star(raw))
    both = Tables({**t, "FAIT_COMMANDES": kpis.order_rollup(t["FAIT_VENTES"])})
    assert both["FAIT_COMMANDES"].count() == 3
    for name in NAMES:
        assert rows(REPORTS[name](t)) == rows(REPORTS[name](both))
