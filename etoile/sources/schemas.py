"""Declared schemas: the raw sources (only the columns the ETL reads) and the star schema.

Ids are kept as whatever type the source carries (strings in CSV, longs in the test
tables); every operator is key-type agnostic.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, I, TS = T.StringType(), T.DoubleType(), T.IntegerType(), T.TimestampNTZType()

# Raw source columns and the type each is cast to after reading text.
RAW_COLUMNS: dict[str, list[tuple[str, T.DataType]]] = {
    "orders": [("order_id", S), ("customer_id", S), ("order_status", S),
               ("order_purchase_timestamp", TS), ("order_delivered_customer_date", TS),
               ("order_estimated_delivery_date", TS)],
    "items": [("order_id", S), ("order_item_id", I), ("product_id", S), ("seller_id", S),
              ("price", D), ("freight_value", D)],
    "customers": [("customer_id", S), ("customer_city", S), ("customer_state", S)],
    "products": [("product_id", S), ("product_category_name", S), ("product_weight_g", D)],
    "sellers": [("seller_id", S), ("seller_city", S), ("seller_state", S)],
    "reviews": [("order_id", S), ("review_score", I)],
    "translation": [("product_category_name", S), ("product_category_name_english", S)],
    "payments": [("order_id", S), ("payment_value", D)],
}

TIMESTAMP_COLUMNS = ("order_purchase_timestamp", "order_delivered_customer_date",
                     "order_estimated_delivery_date")

# Star schema: table name -> (column, type, nullable). Column order is the load order.
STAR_TABLES = {
    "DIM_TEMPS": [("date_achat", T.DateType(), False), ("temps_id", I, False), ("jour", I, False),
                  ("mois", I, False), ("trimestre", I, False), ("annee", I, False),
                  ("nom_mois", S, False), ("date_str", S, False)],
    "DIM_CLIENT": [("client_id", None, False), ("ville", S, True), ("etat", S, False), ("region", S, False)],
    "DIM_PRODUIT": [("produit_id", None, False), ("categorie", S, False), ("poids_g", D, True)],
    "DIM_VENDEUR": [("vendeur_id", None, False), ("ville", S, True), ("etat", S, True)],
    "FAIT_VENTES": [("commande_id", None, False), ("item_id", I, False), ("client_id", None, False),
                    ("produit_id", None, False), ("vendeur_id", None, False), ("temps_id", I, False),
                    ("prix_unitaire", D, False), ("frais_livraison", D, False),
                    ("montant_total", D, True), ("score_satisfaction", D, True),
                    ("delai_livraison_jours", D, True)],
}

PRIMARY_KEYS = {
    "DIM_TEMPS": ["temps_id"],
    "DIM_CLIENT": ["client_id"],
    "DIM_PRODUIT": ["produit_id"],
    "DIM_VENDEUR": ["vendeur_id"],
    "FAIT_VENTES": ["commande_id", "item_id"],
}

FOREIGN_KEYS = [  # (fact column, dimension table, dimension column)
    ("client_id", "DIM_CLIENT", "client_id"),
    ("produit_id", "DIM_PRODUIT", "produit_id"),
    ("vendeur_id", "DIM_VENDEUR", "vendeur_id"),
    ("temps_id", "DIM_TEMPS", "temps_id"),
]

RANGE_CHECKS = [  # (table, column, low, high); NULL passes a CHECK
    ("DIM_TEMPS", "jour", 1, 31),
    ("DIM_TEMPS", "mois", 1, 12),
    ("DIM_TEMPS", "trimestre", 1, 4),
    ("FAIT_VENTES", "score_satisfaction", 1, 5),
]

DEFAULTS = {
    "DIM_PRODUIT": {"categorie": "unknown"},
    "FAIT_VENTES": {"prix_unitaire": 0.0, "frais_livraison": 0.0},
}


def not_null_columns(table: str) -> list[str]:
    return [name for name, _t, nullable in STAR_TABLES[table] if not nullable]

