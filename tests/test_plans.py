"""Physical-plan checks: pushdown, pruning, join strategies, exchanges, no Python in the path."""

from __future__ import annotations

import re

import pytest
from helpers import SF_SMALL

from etoile.plans.registry import ORACLE, QUERIES


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {n: plan_of(QUERIES[n](spark, SF_SMALL)) for n in ORACLE}


@pytest.fixture(scope="module")
def large_plans(spark):
    """Plans with broadcasts off but for the hinted ones: those of dimensions over the size limit."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield {n: plan_of(QUERIES[n](spark, SF_SMALL)) for n in ORACLE if not n.startswith(("csv_", "warehouse_"))}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_python_udf_in_any_sql_query(plans):
    for name, p in plans.items():
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_no_cross_join_in_any_sql_query(plans):
    for name, p in plans.items():
        assert "CartesianProduct" not in p and "NestedLoopJoin" not in p, name


def test_status_filter_and_columns_reach_the_orders_scan(plans):
    p = plans["fait_ventes"]
    scan = [line for line in p.splitlines() if "orders.parquet" in line][0]
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", scan)[1]
    assert "EqualTo(o_orderstatus,F)" in pushed and "IsNotNull(o_orderdate)" in pushed
    assert "o_comment" not in scan and "o_clerk" not in scan   # pruned


def _exchanges(plan: str, key: str) -> list[str]:
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and f"hashpartitioning({key}#" in line]


def test_item_numbering_and_fact_join_share_one_exchange(large_plans):
    p = large_plans["fait_ventes"]
    lines = p.splitlines()
    window = next(i for i, line in enumerate(lines) if "Window [row_number()" in line)
    above = "\n".join(lines[:window])
    # no exchange between the numbering window and the join above it on the way up from lineitem
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    path, level = [], depth(lines[window])
    for line in reversed(above.splitlines()):
        if depth(line) < level:
            path.append(line)
            level = depth(line)
    join = next(i for i, line in enumerate(path) if "Join" in line)
    assert not any("Exchange" in line for line in path[:join]), path[:join + 1]


def test_additive_reports_shuffle_products_not_fact_rows(large_plans):
    for name in ("kpi2_ca_mensuel_categorie", "kpi5_top_categories_satisfaction", "dash_top_categories"):
        p = large_plans[name].splitlines()
        keyed = [i for i, line in enumerate(p) if "Exchange hashpartitioning" in line and "produit_id#" in line]
        assert any("partial_sum" in "".join(p[i + 1:i + 3]) for i in keyed), name


def test_seller_and_key_checks_aggregate_before_they_join(large_plans):
    k3 = large_plans["kpi3_top_vendeurs"]
    join = next(i for i, line in enumerate(k3.splitlines()) if "Join" in line and "vendeur_id" in line)
    assert "Aggregate" in "".join(k3.splitlines()[join:join + 6])
    fk = large_plans["dq_fk"]
    assert fk.count("LeftAnti") == 4 and fk.count("partial_count(1)") >= 4


def test_no_cross_join_without_broadcasts(large_plans):
    for name, p in large_plans.items():
        assert "CartesianProduct" not in p and "NestedLoopJoin" not in p, name


def test_kpi1_single_order_grain_exchange_and_broadcast_dates(spark, plans):
    p = plans["kpi1_ca_mensuel_region"]
    assert "BroadcastHashJoin" in p
    keyed = [line for line in p.splitlines() if "Exchange hashpartitioning" in line and "commande_id" in line]
    assert len(keyed) == 1, keyed   # the distinct-order rewrite; no separate order-grain shuffle


def test_top_k_is_take_ordered(plans):
    for name in ("kpi3_top_vendeurs", "kpi5_top_categories_satisfaction", "client_sample"):
        assert "TakeOrderedAndProject" in plans[name], name


def test_dedup_is_an_aggregate(plans):
    p = plans["dim_client"]
    assert "Window" not in p
    assert re.search(r"(Sort|Hash|ObjectHash)Aggregate", p)


def test_stratified_split_ranks_only_the_bucket_of_the_cut(spark, monkeypatch):
    from etoile.operators import classify
    from etoile.plans.registry import star_tables
    from etoile.plans.reports import REPORTS
    train = REPORTS["order_training_set"](star_tables(spark, SF_SMALL))
    whole = classify.stratified_split(train)
    small = classify.stratified_split(train, edge_rows=10)
    p = small._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number()" in p and "Filter" in p.split("Window [row_number()")[1].split("Window")[0]
    cuts = classify._cuts(train.withColumn("_h", classify._hash(classify.KEY, classify.SEED)), classify.LABEL, 0.25, 10)
    assert all(len(prefix) >= 1 for prefix, _, _ in cuts.values())
    cols = [*classify.KEY, "is_test"]
    assert sorted(tuple(r) for r in whole.select(*cols).collect()) == sorted(tuple(r) for r in small.select(*cols).collect())


def test_kmeans_pass_combines_before_a_spread_shuffle(spark):
    import numpy as np
    from etoile.operators import kmeans
    seen = {}
    df = spark.range(100).selectExpr("id as client_id", "cast(id as double) as a", "cast(id % 7 as double) as b")
    schema = "model int, cluster int, n long, cost double, s_0 double, s_1 double"
    part = df.select("a", "b").mapInPandas(kmeans._partials(["a", "b"], [(0, 2)], np.zeros((2, 2))), schema)
    seen["plan"] = plan_of(part.groupBy("model", "cluster").agg({"n": "sum"}))
    assert "partial_sum" in seen["plan"] and "hashpartitioning(model" in seen["plan"] and "SinglePartition" not in seen["plan"]
