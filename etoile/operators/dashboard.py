"""Dashboard data (D1-D12): the frames behind each chart and headline number.

The source draws charts from cached result sets; here each chart's data is a DataFrame
operator and the drawing is left to the caller. The region filter (D10, D11) is a
parameter applied to the already aggregated monthly / per-state frames, as in the source:
it never re-scans the fact. Chart order is returned as an explicit ``ordre`` column
where the source depends on a sort (D9, D11, D12), computed over a bounded frame only
(after a top-k, or over the handful of regions).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from etoile.functions.lookups import ALL_REGIONS
from etoile.functions.numeric import MONEY_SCALE, SCORE_SCALE
from etoile.operators import kpis


def periode_mois(annee="annee", mois="mois") -> Column:
    """``<year>-<month, two digits>``."""
    return F.concat_ws("-", F.col(annee).cast("string"), F.lpad(F.col(mois).cast("string"), 2, "0"))


def monthly_revenue(fact: DataFrame, dim_temps: DataFrame, dim_client: DataFrame) -> DataFrame:
    """K1 grouped the same way, sorted by month only, plus ``periode`` (YYYY-MM)."""
    k1 = kpis.kpi1_ca_mensuel_region(fact, dim_temps, dim_client)
    return k1.withColumn("periode", periode_mois()).orderBy("annee", "mois")


def top_categories(fact: DataFrame, dim_produit: DataFrame, limit: int = 15) -> DataFrame:
    """Categories by item revenue, with mean score (rated items) and item count."""
    f = kpis.with_products(fact.groupBy("produit_id").agg(*kpis.product_sums()), dim_produit, "categorie")
    agg = f.groupBy("categorie").agg(
        kpis.merged_sum("_price").alias("ca_categorie"),
        kpis.merged_avg("_score", "_scored", 2).alias("score_moyen"),
        F.sum("_items").alias("nb_ventes"))
    return agg.orderBy(F.desc("ca_categorie"), F.asc("categorie")).limit(limit)


def categories_chart(top: DataFrame) -> DataFrame:
    """The top categories in chart order (ascending revenue); ``ordre`` = 1..n."""
    w = Window.orderBy(F.asc("ca_categorie"), F.desc("categorie"))
    return top.withColumn("ordre", F.row_number().over(w)).orderBy("ordre")


def delay_by_state(fact: DataFrame, dim_client: DataFrame) -> DataFrame:
    """D3: mean positive delay and distinct orders per state, slowest first."""
    return kpis.delay_by_state(fact, dim_client, with_range=False, mean_name="delai_moyen")


def score_distribution(fact: DataFrame) -> DataFrame:
    """Number of items per (order-averaged) score."""
    return (fact.filter(F.col("score_satisfaction").isNotNull())
            .groupBy("score_satisfaction").agg(F.count(F.lit(1)).alias("nb"))
            .orderBy("score_satisfaction"))


def quarterly_trend(fact: DataFrame, dim_temps: DataFrame) -> DataFrame:
    """Revenue per quarter."""
    return kpis.quarterly_revenue(fact, dim_temps, with_orders=False)


def global_sums(fact: DataFrame) -> DataFrame:
    """D8 base, one row: exact sums and counts of scores and of positive delays."""
    delay = F.when(F.col("delai_livraison_jours") > 0, F.col("delai_livraison_jours"))
    return fact.agg(F.sum(F.col("score_satisfaction").cast(f"decimal(28,{SCORE_SCALE})")).alias("_score"),
                    F.count("score_satisfaction").alias("_scored"),
                    F.sum(delay.cast(f"decimal(18,{MONEY_SCALE})")).alias("_delay"), F.count(delay).alias("_delayed"))


def headline(monthly: DataFrame, sums: DataFrame) -> DataFrame:
    """Total revenue and orders (sums over the monthly x region frame, as the source
    does), global mean score and global mean positive delay; one row.

    Summing the per-group distinct counts equals the global distinct count because an order
    has one date and one client. The monthly rows and the row of ``global_sums`` are stacked (each side
    fills only its own columns) and reduced by one global aggregate: no join.
    """
    dec = f"decimal(18,{MONEY_SCALE})"
    a = monthly.select(F.col("ca_total").cast(dec).alias("_ca"), F.col("nb_commandes").alias("_nb"))
    return a.unionByName(sums, allowMissingColumns=True).agg(
        F.round(F.sum("_ca"), 2).cast("double").alias("ca_total"),
        F.sum("_nb").alias("nb_commandes"),
        kpis.merged_avg("_score", "_scored", 2).alias("score_global"),
        kpis.merged_avg("_delay", "_delayed", 1).alias("delai_global"))


def region_choices(monthly: DataFrame) -> DataFrame:
    """Filter choices, 'Toutes' first then the regions present, sorted; ``ordre`` = 0..n."""
    regions = monthly.select("region").distinct()
    ranked = regions.withColumn("ordre", F.row_number().over(Window.orderBy("region")))
    first = monthly.sparkSession.range(1).select(F.lit(ALL_REGIONS).alias("region"), F.lit(0).alias("ordre"))
    return first.unionByName(ranked).orderBy("ordre")


def _for_region(df: DataFrame, region: str) -> DataFrame:
    return df if region == ALL_REGIONS else df.filter(F.col("region") == F.lit(region))


def monthly_revenue_for(monthly: DataFrame, region: str = ALL_REGIONS) -> DataFrame:
    """Monthly revenue for one region, or all of them, summed per ``periode``."""
    return (_for_region(monthly, region).groupBy("periode")
            .agg(F.round(F.sum(F.col("ca_total").cast(f"decimal(18,{MONEY_SCALE})")), 2)
                 .cast("double").alias("ca_total"))
            .orderBy("periode"))


def slowest_states_for(delays: DataFrame, region: str = ALL_REGIONS, top: int = 20) -> DataFrame:
    """The ``top`` slowest states (of one region or all), then ascending for the chart."""
    slow = _for_region(delays, region).orderBy(F.desc("delai_moyen"), F.asc("etat")).limit(top)
    w = Window.orderBy(F.asc("delai_moyen"), F.desc("etat"))
    return slow.withColumn("ordre", F.row_number().over(w)).orderBy("ordre")


def dashboard_frames(fact: DataFrame, dim_temps: DataFrame, dim_client: DataFrame, dim_produit: DataFrame,
                     region: str = ALL_REGIONS, orders: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every chart's data at once, as the source's dashboard loads it at start; ``orders``: the order roll-up, if there is one.

    The base aggregates (monthly x region, per state, top categories, scores, quarters, global sums) are
    persisted: they are bounded by the calendar, the states, the score values and the top-k,
    not by the fact, so they stay small whatever the data volume. The region filter and the
    derived frames then read these small frames and never the fact again.
    """
    base = {
        "dash_ca": monthly_revenue(fact if orders is None else orders, dim_temps, dim_client),
        "dash_delai": delay_by_state(fact, dim_client),
        "dash_top_categories": top_categories(fact, dim_produit),
        "dash_scores": score_distribution(fact),
        "dash_trend": quarterly_trend(fact if orders is None else orders, dim_temps),
        "sums": global_sums(fact),
    }
    base = {k: v.persist() for k, v in base.items()}
    sums = base.pop("sums")
    return {
        **base,
        "dash_headline": headline(base["dash_ca"], sums),
        "dash_regions": region_choices(base["dash_ca"]),
        "dash_ca_region": monthly_revenue_for(base["dash_ca"], region),
        "dash_delai_region": slowest_states_for(base["dash_delai"], region),
        "dash_categories_chart": categories_chart(base["dash_top_categories"]),
    }
