"""Star builders: raw sources -> DIM_TEMPS, DIM_CLIENT, DIM_PRODUIT, DIM_VENDEUR, FAIT_VENTES.

Scale notes
* Everything keyed by order (items, delivered orders, review means, payment totals) meets
  in joins on the order id, so one hash partitioning on that key serves all of them.
* Reviews and payments are aggregated per order *before* the join (partial + final hash
  aggregate), which both avoids fan-out and shrinks the shuffle.
* Deduplication is an aggregate (``min_by`` on a tie-break struct) instead of a window:
  it combines map-side, so a key holding a third of all rows never lands whole in one task.
* The date dimension has one row per calendar day; its size is bounded by the calendar,
  so it is the one dimension broadcast unconditionally.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from etoile.functions.dates import date_parts, delay_days, parse_timestamp
from etoile.functions.lookups import DEFAULT_CATEGORY, region_of
from etoile.functions.numeric import MONEY_SCALE
from etoile.sources.csv import POSITION
from etoile.sources.schemas import TIMESTAMP_COLUMNS

DELIVERED = "delivered"
POSITIONS = [POSITION, "_translation_position"]      # order of the rows in the source files, where the reader gives it


# ---------------------------------------------------------------- generic building blocks

def parse_order_timestamps(orders: DataFrame) -> DataFrame:
    """B1: text timestamps -> TIMESTAMP_NTZ, unparseable -> null (no-op for typed input)."""
    types = dict(orders.dtypes)
    out = orders
    for c in TIMESTAMP_COLUMNS:
        if c in types and types[c] == "string":
            out = out.withColumn(c, parse_timestamp(F.col(c)))
    return out


def keep_first(df: DataFrame, key: str, order_by: list[str] | None = None) -> DataFrame:
    """One row per key value, the smallest by ``order_by`` (default: all other columns).

    The source keeps the first row in file order. Rows that carry their position (``sources.csv``) go by it; others have no file order,
    and the tie-break is an explicit total order on the row's own values (nulls first). Null keys form one
    group, as in the source. Implemented as an aggregate so it combines map-side.
    """
    others = [c for c in df.columns if c not in (key, *POSITIONS)]
    order_by = [*[c for c in POSITIONS if c in df.columns], *(order_by or others)]
    first = F.min_by(F.struct(*[F.col(c) for c in others]), F.struct(*[F.col(c) for c in order_by]))
    return (df.groupBy(key).agg(first.alias("_row"))
            .select(key, *[F.col(f"_row.{c}").alias(c) for c in others]))


# ---------------------------------------------------------------- orders and dimensions

def delivered_orders(orders: DataFrame) -> DataFrame:
    """Parsed, delivered orders with a purchase time (the filter pushes to the scan)."""
    o = parse_order_timestamps(orders)
    return o.filter((F.col("order_status") == DELIVERED) & F.col("order_purchase_timestamp").isNotNull())


def _placed(df: DataFrame) -> list[str]:
    return [c for c in POSITIONS if c in df.columns]


def translated_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """English category name, else the raw name, else 'unknown'."""
    t = translation.withColumnRenamed(POSITION, POSITIONS[1]).select("product_category_name", "product_category_name_english", *(POSITIONS[1:] if POSITION in translation.columns else []))
    p = products.join(t, on="product_category_name", how="left")
    return p.withColumn("product_category_name_english",
                        F.coalesce("product_category_name_english", "product_category_name",
                                   F.lit(DEFAULT_CATEGORY)))


def dim_temps(delivered: DataFrame) -> DataFrame:
    """One row per distinct purchase date. temps_id = 1..n by first appearance, as the source numbers them, if the orders carry
    their position in the file; else in date order.

    Only the distinct dates (bounded by the calendar) reach the single-partition window.
    """
    day = F.to_date("order_purchase_timestamp").alias("date_achat")
    if POSITION in delivered.columns:
        dates, order = delivered.groupBy(day).agg(F.min(POSITION).alias("_first")), ["_first"]
    else:
        dates, order = delivered.select(day).distinct(), ["date_achat"]
    parts = date_parts(F.col("date_achat"))
    return dates.select(
        "date_achat",
        F.row_number().over(Window.orderBy(*order)).alias("temps_id"),
        parts["jour"].alias("jour"), parts["mois"].alias("mois"),
        parts["trimestre"].alias("trimestre"), parts["annee"].alias("annee"),
        parts["nom_mois"].alias("nom_mois"), parts["date_str"].alias("date_str"),
    )


def dim_client(customers: DataFrame) -> DataFrame:
    """B12, B13, B14, B15."""
    c = customers.select(F.col("customer_id").alias("client_id"), F.col("customer_city").alias("ville"),
                         F.col("customer_state").alias("etat"), *_placed(customers))
    c = c.withColumn("region", region_of(F.col("etat")))
    return keep_first(c, "client_id", ["ville", "etat"]).select("client_id", "ville", "etat", "region")


def dim_produit(products: DataFrame, translation: DataFrame) -> DataFrame:
    """B16."""
    p = translated_products(products, translation)
    p = p.select(F.col("product_id").alias("produit_id"), F.col("product_category_name_english").alias("categorie"), F.col("product_weight_g").alias("poids_g"), *_placed(p))
    return keep_first(p, "produit_id", ["categorie", "poids_g"]).select("produit_id", "categorie", "poids_g")


def dim_vendeur(sellers: DataFrame) -> DataFrame:
    """B17."""
    s = sellers.select(F.col("seller_id").alias("vendeur_id"), F.col("seller_city").alias("ville"),
                       F.col("seller_state").alias("etat"), *_placed(sellers))
    return keep_first(s, "vendeur_id", ["ville", "etat"]).select("vendeur_id", "ville", "etat")


# ---------------------------------------------------------------- per-order pre-aggregates

def order_scores(reviews: DataFrame) -> DataFrame:
    """Mean review score per order (null when every score is null)."""
    return reviews.groupBy("order_id").agg(F.avg(F.col("review_score").cast("double")).alias("score_moyen"))


def order_payments(payments: DataFrame) -> DataFrame:
    """Payment total per order, exact in DECIMAL, rounded to cents; an all-null group is 0."""
    total = F.round(F.sum(F.col("payment_value").cast(f"decimal(18,{MONEY_SCALE})")), 2).cast("double")
    return payments.groupBy("order_id").agg(F.coalesce(total, F.lit(0.0)).alias("montant_total"))


# ---------------------------------------------------------------- the fact

FACT_COLUMNS = ["commande_id", "item_id", "client_id", "produit_id", "vendeur_id", "temps_id",
                "prix_unitaire", "frais_livraison", "montant_total", "score_satisfaction",
                "delai_livraison_jours"]


def order_level(delivered: DataFrame, scores: DataFrame, payments_per_order: DataFrame,
                temps: DataFrame) -> DataFrame:
    """Everything the fact takes from the order, one row per delivered order.

    Delivered orders ⟕ review mean ⟕ payment total are all keyed by the order id with at most
    one row per order (the means and totals are pre-aggregated), so these joins cannot skew.
    The date key (broadcast of the date dimension, bounded by the calendar) and the delay
    are computed once per order, not once per item.
    """
    o = delivered.select("order_id", "customer_id", "order_purchase_timestamp", "order_delivered_customer_date")
    o = o.join(scores, on="order_id", how="left").join(payments_per_order, on="order_id", how="left")
    dates = F.broadcast(temps.select(F.col("date_achat").alias("_d"), "temps_id"))
    o = o.join(dates, F.to_date(o.order_purchase_timestamp) == dates._d, "left")
    return o.select(
        "order_id", "customer_id", "temps_id", "montant_total", "score_moyen",
        delay_days(F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date"))
        .alias("delai_livraison_jours"))


def fait_ventes(items: DataFrame, delivered: DataFrame, scores: DataFrame, payments_per_order: DataFrame,
                temps: DataFrame, stage=None) -> DataFrame:
    """Item-grain fact.

    The source joins items ⋈ delivered orders (inner), then ⟕ review mean and ⟕ payment total.
    The per-order inputs are unique per order, so the same rows come from joining them first
    (``order_level``) and then items ⋈ that table once: a single join on the order id whose
    build side has one row per key. A hot order (many items) is then split by AQE's skew-join
    handling (or the order table is broadcast while under the size threshold), which a chain
    of joins inside one stage would not allow. ``stage`` (the ETL job passes
    ``session.materialize``) writes the order table first, so both join inputs are plain
    shuffles of scanned tables: the shape AQE's skew split works on.
    """
    o = order_level(delivered, scores, payments_per_order, temps)
    if stage is not None:
        o = stage(o, "order-level")
    f = items.join(o, on="order_id", how="inner")
    return f.select(
        F.col("order_id").alias("commande_id"),
        F.col("order_item_id").alias("item_id"),
        F.col("customer_id").alias("client_id"),
        F.col("product_id").alias("produit_id"),
        F.col("seller_id").alias("vendeur_id"),
        F.col("temps_id"),
        F.col("price").cast(T.DoubleType()).alias("prix_unitaire"),
        F.col("freight_value").cast(T.DoubleType()).alias("frais_livraison"),
        F.col("montant_total"),
        F.col("score_moyen").alias("score_satisfaction"),
        F.col("delai_livraison_jours"),
    )


def build_star(raw: dict[str, DataFrame], temps: DataFrame | None = None, stage=None) -> dict[str, DataFrame]:
    """The whole transform, lazily; returns the five warehouse tables.

    ``temps``: an already written date dimension to key the fact with (the ETL job writes
    it first), instead of deriving the dates again. ``stage``: see ``fait_ventes``.
    """
    delivered = delivered_orders(raw["orders"])
    temps = dim_temps(delivered) if temps is None else temps
    return {
        "DIM_TEMPS": temps,
        "DIM_CLIENT": dim_client(raw["customers"]),
        "DIM_PRODUIT": dim_produit(raw["products"], raw["translation"]),
        "DIM_VENDEUR": dim_vendeur(raw["sellers"]),
        "FAIT_VENTES": fait_ventes(raw["items"], delivered, order_scores(raw["reviews"]),
                                   order_payments(raw["payments"]), temps, stage),
    }
