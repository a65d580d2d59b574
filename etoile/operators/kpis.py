"""KPI queries over the star schema (K1-K6).

Every operator takes the warehouse tables as DataFrames and returns the report frame with
the source's column names. Joins are inner (a fact row whose dimension row is missing
drops out, as in the source).

Plan shape (checked with ``explain``). Where the measures add up (sums and counts: K2, K5 and the
dashboard's categories), the fact is aggregated per product (and month) before the product
dimension is joined, and a seller's whole report row (K3) before its dimension: what is joined is one row per key, so a
hot product or seller is combined map-side. K1 and K4 count distinct orders by attributes of the client, so the dimension is joined
first; ``COUNT(DISTINCT commande_id)`` is then planned as partial aggregate on (keys,
commande_id) -> one exchange -> final aggregate on keys.

Join strategy: the date dimension has one row per calendar day, a size bounded by the
calendar and not by the data, so it is broadcast by hint. The client, product and seller
dimensions grow with the data: they are left to the planner's size check
(``spark.sql.autoBroadcastJoinThreshold`` on the plan statistics, and AQE's runtime
threshold on the real shuffle size); beyond it the join is a shuffle join, with AQE's
skew-join split for a hot key.

Grain. What is grouped by month, region, quarter or client and not by item attributes (K1, K6, and with them D1, D5, M1, M21) reads the fact or, where a
warehouse has it, the per-order roll-up ``order_rollup``: there an order is a row, so distinct orders are a plain count and nothing is grouped by the order
again. ``measures`` has the same exact measures for both grains.

Rounding follows ``etoile.functions.numeric``: exact DECIMAL sums, engine-stable averages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from etoile.functions.numeric import MONEY_SCALE, SCORE_SCALE, average_of, rounded_avg, rounded_sum


def price() -> Column:
    """Item revenue (price only): KPI 2, 3 and the dashboard's categories."""
    return F.col("prix_unitaire")


def revenue() -> Column:
    """Revenue with freight (KPI 1, 6, client profile), exact in DECIMAL."""
    return (F.col("prix_unitaire").cast(f"decimal(18,{MONEY_SCALE})")
            + F.col("frais_livraison").cast(f"decimal(18,{MONEY_SCALE})"))


def revenue_total() -> Column:
    """ROUND(SUM(price + freight), 2), exact."""
    return F.round(F.sum(revenue()), 2).cast("double")


def dates(dim_temps: DataFrame, *cols: str) -> DataFrame:
    """Date-dimension columns for a join on ``temps_id``; broadcast (bounded by the calendar)."""
    return F.broadcast(dim_temps.select("temps_id", *cols))


def with_dates(fact: DataFrame, dim_temps: DataFrame, *cols: str) -> DataFrame:
    return fact.join(dates(dim_temps, *cols), "temps_id")


def with_clients(fact: DataFrame, dim_client: DataFrame, *cols: str) -> DataFrame:
    return fact.join(dim_client.select("client_id", *cols), "client_id")


def with_products(fact: DataFrame, dim_produit: DataFrame, *cols: str) -> DataFrame:
    return fact.join(dim_produit.select("produit_id", *cols), "produit_id")


def nb_orders() -> Column:
    return F.countDistinct("commande_id")


def product_sums() -> list[Column]:
    """Exact sums and counts of a product's fact rows, to be merged per category after the join."""
    return [F.sum(price().cast(f"decimal(18,{MONEY_SCALE})")).alias("_price"), F.count(F.lit(1)).alias("_items"),
            F.sum(F.col("score_satisfaction").cast(f"decimal(28,{SCORE_SCALE})")).alias("_score"),
            F.count("score_satisfaction").alias("_scored")]


def merged_sum(col: str, digits: int = 2) -> Column:
    return F.round(F.sum(col), digits).cast("double")


def merged_avg(total: str, count: str, digits: int) -> Column:
    """``rounded_avg`` from exact sums and counts of parts."""
    return average_of(F.sum(total).cast("double"), F.sum(count), digits)


def order_rollup(fact: DataFrame) -> DataFrame:
    """The fact per order: client, date, items, and exact sums and counts of what the reports average.

    An order has one client and one purchase date (they come from the order, see ``star.order_level``), so it is one row here; were it not, each
    (order, client, date) would be.
    """
    money, score = f"decimal(18,{MONEY_SCALE})", f"decimal(28,{SCORE_SCALE})"
    return fact.groupBy("commande_id", "client_id", "temps_id").agg(
        F.count(F.lit(1)).alias("nb_articles"), F.sum(revenue()).alias("ca_exact"),
        F.sum(price().cast(money)).alias("prix_exact"), F.count(price()).alias("nb_prix"),
        F.sum(F.col("score_satisfaction").cast(score)).alias("score_exact"), F.count("score_satisfaction").alias("nb_scores"),
        F.sum(F.col("delai_livraison_jours").cast(money)).alias("delai_exact"), F.count("delai_livraison_jours").alias("nb_delais"))


def measures(rows: DataFrame) -> dict[str, Column]:
    """Aggregates over items (the fact) or orders (``order_rollup``): revenue, orders, mean item price, mean score, mean delay."""
    if "nb_articles" in rows.columns:
        return {"ca": merged_sum("ca_exact"), "commandes": F.count("commande_id"), "panier": merged_avg("prix_exact", "nb_prix", 2),
                "score": merged_avg("score_exact", "nb_scores", 2), "delai": merged_avg("delai_exact", "nb_delais", 1)}
    return {"ca": revenue_total(), "commandes": nb_orders(), "panier": rounded_avg(price(), 2),
            "score": rounded_avg("score_satisfaction", 2, SCORE_SCALE), "delai": rounded_avg("delai_livraison_jours", 1)}


def kpi1_ca_mensuel_region(fact: DataFrame, dim_temps: DataFrame, dim_client: DataFrame) -> DataFrame:
    """K1: revenue (price + freight), distinct orders and mean item price per month and region."""
    f, m = with_clients(with_dates(fact, dim_temps, "annee", "mois", "nom_mois"), dim_client, "region"), measures(fact)
    return (f.groupBy("annee", "mois", "nom_mois", "region")
            .agg(m["ca"].alias("ca_total"), m["commandes"].alias("nb_commandes"), m["panier"].alias("panier_moyen"))
            .orderBy("annee", "mois", F.desc("ca_total")))


def kpi2_ca_mensuel_categorie(fact: DataFrame, dim_temps: DataFrame, dim_produit: DataFrame) -> DataFrame:
    """K2: item revenue (price only) and items sold per month and category."""
    per_product = with_dates(fact, dim_temps, "annee", "mois").groupBy("annee", "mois", "produit_id").agg(*product_sums())
    return (with_products(per_product, dim_produit, "categorie").groupBy("annee", "mois", "categorie")
            .agg(merged_sum("_price").alias("ca_categorie"), F.sum("_items").alias("nb_articles_vendus"))
            .orderBy("annee", "mois", F.desc("ca_categorie")))


def kpi3_top_vendeurs(fact: DataFrame, dim_vendeur: DataFrame, limit: int = 20) -> DataFrame:
    """K3: top sellers by mean satisfaction (rated items only); ties broken by seller id.

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: each partition keeps its own
    top n, only n rows per partition reach the final merge.
    """
    per_seller = fact.filter(F.col("score_satisfaction").isNotNull()).groupBy("vendeur_id").agg(
        rounded_avg("score_satisfaction", 2, SCORE_SCALE).alias("score_moyen"),
        nb_orders().alias("nb_commandes"),
        rounded_sum(price()).alias("ca_total"))
    agg = (per_seller.join(dim_vendeur.select("vendeur_id", "etat"), "vendeur_id")
           .select("vendeur_id", "etat", "score_moyen", "nb_commandes", "ca_total"))
    return agg.orderBy(F.desc("score_moyen"), F.asc("vendeur_id")).limit(limit)


def delay_by_state(fact: DataFrame, dim_client: DataFrame, with_range: bool = True,
                   mean_name: str = "delai_moyen_jours") -> DataFrame:
    """Positive delivery delays per client state (K4; the dashboard's D3 without min/max)."""
    f = with_clients(fact.filter(F.col("delai_livraison_jours") > 0), dim_client, "etat", "region")
    aggs = [rounded_avg("delai_livraison_jours", 1).alias(mean_name)]
    if with_range:
        aggs += [F.round(F.min("delai_livraison_jours"), 1).alias("delai_min"),
                 F.round(F.max("delai_livraison_jours"), 1).alias("delai_max")]
    aggs.append(nb_orders().alias("nb_commandes"))
    return f.groupBy("etat", "region").agg(*aggs).orderBy(F.desc(mean_name), F.asc("etat"))


def kpi4_delai_etat(fact: DataFrame, dim_client: DataFrame) -> DataFrame:
    """K4: delivery delay (positive delays only) per client state."""
    return delay_by_state(fact, dim_client)


def kpi5_top_categories_satisfaction(fact: DataFrame, dim_produit: DataFrame, limit: int = 10,
                                     min_ratings: int = 50) -> DataFrame:
    """K5: best-rated categories having more than ``min_ratings`` rated items."""
    per_product = fact.filter(F.col("score_satisfaction").isNotNull()).groupBy("produit_id").agg(*product_sums())
    agg = (with_products(per_product, dim_produit, "categorie").groupBy("categorie")
           .agg(merged_avg("_score", "_scored", 2).alias("score_moyen"), F.sum("_scored").alias("nb_evaluations")))
    return (agg.filter(F.col("nb_evaluations") > min_ratings)
            .orderBy(F.desc("score_moyen"), F.asc("categorie")).limit(limit))


def periode_trimestre(annee="annee", trimestre="trimestre") -> Column:
    """``<year>-T<quarter>``."""
    return F.concat(F.col(annee).cast("string"), F.lit("-T"), F.col(trimestre).cast("string"))


def quarterly_revenue(fact: DataFrame, dim_temps: DataFrame, with_orders: bool = True) -> DataFrame:
    """Revenue (and distinct orders) per quarter: K6, and the series of D5 and M21."""
    aggs = [measures(fact)["ca"].alias("ca_total")]
    if with_orders:
        aggs.append(measures(fact)["commandes"].alias("nb_commandes"))
    g = with_dates(fact, dim_temps, "annee", "trimestre").groupBy("annee", "trimestre").agg(*aggs)
    return (g.select("annee", "trimestre", periode_trimestre().alias("periode"), *[a for a in g.columns[2:]])
            .orderBy("annee", "trimestre"))


def kpi6_ca_trimestriel(fact: DataFrame, dim_temps: DataFrame) -> DataFrame:
    """K6: revenue and distinct orders per quarter."""
    return quarterly_revenue(fact, dim_temps)
