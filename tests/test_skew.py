"""A hot order holding a third of all items: the ETL's one large join is split by AQE, no row lost."""

from __future__ import annotations

import tempfile

from pyspark.sql import functions as F

import etoile.plans.jobs as jobs
from etoile.sources.warehouse import read_star

CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"}


def _raw(spark, n=30_000):
    ids = spark.range(n)
    oid = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("o"), (F.col("id") % 5000).cast("string")))
    items = ids.select(oid.alias("order_id"), (F.col("id") + 1).cast("int").alias("order_item_id"),
                       F.lit("p1").alias("product_id"), F.lit("s1").alias("seller_id"),
                       (F.col("id") % 97 + 1).cast("double").alias("price"), F.lit(1.0).alias("freight_value"))
    orders = items.select("order_id").distinct().select(
        "order_id", F.lit("c1").alias("customer_id"), F.lit("delivered").alias("order_status"),
        F.lit("2018-01-05 10:00:00").cast("timestamp_ntz").alias("order_purchase_timestamp"),
        F.lit("2018-01-07 10:00:00").cast("timestamp_ntz").alias("order_delivered_customer_date"),
        F.lit("2018-02-01 00:00:00").cast("timestamp_ntz").alias("order_estimated_delivery_date"))
    one = spark.createDataFrame([("x",)], "v string")
    return {
        "orders": orders, "items": items,
        "customers": one.select(F.lit("c1").alias("customer_id"), F.lit("x").alias("customer_city"),
                                F.lit("SP").alias("customer_state")),
        "products": one.select(F.lit("p1").alias("product_id"), F.lit("a").alias("product_category_name"),
                               F.lit(1.0).alias("product_weight_g")),
        "sellers": one.select(F.lit("s1").alias("seller_id"), F.lit("x").alias("seller_city"),
                              F.lit("SP").alias("seller_state")),
        "reviews": orders.select("order_id", F.lit(4).alias("review_score")),
        "translation": spark.createDataFrame([], "product_category_name string, product_category_name_english string"),
        "payments": orders.select("order_id", F.lit(10.0).alias("payment_value")),
    }


def test_hot_order_join_is_split_and_complete(spark, monkeypatch):
    old = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    captured = {}
    original = jobs.layout_for_write

    def spy(name, df):
        captured[name] = df
        return original(name, df)

    monkeypatch.setattr(jobs, "layout_for_write", spy)
    try:
        wh = tempfile.mkdtemp(prefix="etoile-skew-", dir="/tmp") + "/warehouse"
        jobs.run_etl(spark, _raw(spark), wh)
        fact = captured["FAIT_VENTES"]
        assert len(fact.collect()) == 30_000
        plan = fact._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan and "SortMergeJoin(skew=true)" in plan
        hot = read_star(spark, wh)["FAIT_VENTES"].filter("commande_id = 'hot'")
        assert hot.count() == 10_000 and hot.select("score_satisfaction").distinct().collect()[0][0] == 4.0
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_client_kpi_join_is_split_and_equal(spark):
    from etoile.operators import kpis
    n = 30_000
    ids = spark.range(n)
    fact = ids.select(
        F.concat(F.lit("o"), (F.col("id") % 9000).cast("string")).alias("commande_id"),
        (F.col("id") + 1).cast("int").alias("item_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), (F.col("id") % 2000).cast("string")))
        .alias("client_id"),
        F.lit("p1").alias("produit_id"), F.lit("s1").alias("vendeur_id"),
        (F.col("id") % 28 + 1).cast("int").alias("temps_id"),
        (F.col("id") % 97 + 1).cast("double").alias("prix_unitaire"), F.lit(1.0).alias("frais_livraison"))
    temps = spark.range(1, 29).select(F.col("id").cast("int").alias("temps_id"), F.lit(2018).alias("annee"),
                                      F.lit(2).alias("mois"), F.lit("February").alias("nom_mois"))
    clients = spark.range(2000).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("client_id"),
                                       F.when(F.col("id") % 2 == 0, "Sul").otherwise("Norte").alias("region"))
    clients = clients.unionByName(spark.createDataFrame([("hot", "Sudeste")], "client_id string, region string"))
    expected = sorted(tuple(r) for r in kpis.kpi1_ca_mensuel_region(fact, temps, clients).collect())
    old = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    try:
        df = kpis.kpi1_ca_mensuel_region(fact, temps, clients)
        got = sorted(tuple(r) for r in df.collect())
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true)" in plan
    assert got == expected


def test_hot_seller_and_product_are_combined_before_the_join(spark):
    """A seller and a product with a third of the rows: what reaches the joins is one row per key."""
    from etoile.operators import kpis, quality
    ids = spark.range(30_000)
    key = lambda p, n: F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit(p), (F.col("id") % n).cast("string")))
    fact = ids.select(F.concat(F.lit("o"), (F.col("id") % 9000).cast("string")).alias("commande_id"), key("s", 300).alias("vendeur_id"),
                      key("p", 200).alias("produit_id"), key("c", 50).alias("client_id"), (F.col("id") % 28 + 1).cast("int").alias("temps_id"),
                      (F.col("id") % 97 + 1).cast("double").alias("prix_unitaire"), (F.col("id") % 5 + 1).cast("double").alias("score_satisfaction"))
    dim = lambda p, n, out, extra: (spark.range(n).select(F.concat(F.lit(p), F.col("id").cast("string")).alias(out))
                                    .union(spark.createDataFrame([("hot",)], "k string")).withColumn(extra, F.lit("x")))
    sellers, products = dim("s", 300, "vendeur_id", "etat"), dim("p", 200, "produit_id", "categorie")
    old = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    try:
        k3 = kpis.kpi3_top_vendeurs(fact, sellers, limit=400)
        rows = {r.vendeur_id: r for r in k3.collect()}
        assert len(rows) == 301 - 100 and rows["hot"].nb_commandes == 3000
        k5 = kpis.kpi5_top_categories_satisfaction(fact, products).first()
        assert k5.nb_evaluations == 30_000 and k5.score_moyen == 3.0
        fk = quality.foreign_key_orphans({"FAIT_VENTES": fact, "DIM_VENDEUR": sellers.where("vendeur_id <> 'hot'")},
                                         fks=[("vendeur_id", "DIM_VENDEUR", "vendeur_id")])
        assert fk.first().nb_violations == 10_000
        for df in (k3, fk):
            joined = df._jdf.queryExecution().executedPlan().toString().split("Join", 1)[1]
            assert "Aggregate" in joined
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
