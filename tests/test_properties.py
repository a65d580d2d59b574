"""Properties (hypothesis): fact grain under any number of reviews and payments; report totals agree."""

from __future__ import annotations

from helpers import SF_SMALL, item, order, raw_tables
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from etoile.operators import kpis, star
from etoile.plans.registry import star_tables

orders_st = st.lists(
    st.tuples(st.integers(1, 3),                       # items
              st.integers(0, 3),                       # reviews
              st.integers(0, 3),                       # payments
              st.sampled_from(["delivered", "shipped"])),
    min_size=1, max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(orders_st)
def test_fact_rows_equal_items_of_delivered_orders(spark, spec):
    orders, items, reviews, payments = [], [], [], []
    for i, (n_items, n_rev, n_pay, status) in enumerate(spec):
        oid = f"o{i}"
        orders.append(order(oid, "c1", status=status))
        items += [item(oid, k + 1, price=float(k + 1)) for k in range(n_items)]
        reviews += [(oid, 1 + (i + r) % 5) for r in range(n_rev)]
        payments += [(oid, 1.25 * (p + 1)) for p in range(n_pay)]
    s = star.build_star(raw_tables(spark, orders=orders, items=items, reviews=reviews, payments=payments,
                                   customers=[("c1", "x", "SP")]))
    expected = sum(n for n, _r, _p, status in spec if status == "delivered")
    assert s["FAIT_VENTES"].count() == expected
    dup = s["FAIT_VENTES"].groupBy("commande_id", "item_id").count().filter("count > 1").count()
    assert dup == 0


def test_monthly_and_quarterly_revenue_agree(spark):
    s = star_tables(spark, SF_SMALL)
    k1 = kpis.kpi1_ca_mensuel_region(s["FAIT_VENTES"], s["DIM_TEMPS"], s["DIM_CLIENT"])
    k6 = kpis.kpi6_ca_trimestriel(s["FAIT_VENTES"], s["DIM_TEMPS"])
    # every fact row has a client in the test data, so both cover the same rows
    t1 = k1.agg(F.sum(F.col("ca_total").cast("decimal(18,2)"))).first()[0]
    t6 = k6.agg(F.sum(F.col("ca_total").cast("decimal(18,2)"))).first()[0]
    assert abs(t1 - t6) <= 0.01 * k1.count()
    assert k1.agg(F.sum("nb_commandes")).first()[0] == k6.agg(F.sum("nb_commandes")).first()[0]
