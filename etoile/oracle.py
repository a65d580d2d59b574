"""DuckDB SQL that computes the same results as the Spark operators, for the correctness gate.

The adapter and the star schema are shared CTEs; each report appends its own SELECT.
Numeric rule as in ``etoile.functions.numeric``: exact DECIMAL sums, averages rounded as
``sign(S) * floor(|S| / n * 10^d + 0.5) / 10^d``, integer outputs cast to Spark's types.
The fixed lookup values come from the same Python constants the Spark code uses.
"""

from __future__ import annotations

from etoile.functions.lookups import DEFAULT_CATEGORY, DEFAULT_REGION, REGION_BY_STATE
from etoile.sources import testdata as td
from etoile.sources.schemas import FOREIGN_KEYS, PRIMARY_KEYS, RANGE_CHECKS, not_null_columns  # noqa: F401

# warehouse table -> CTE name in the oracle SQL
VIEW = {"DIM_TEMPS": "dim_temps", "DIM_CLIENT": "dim_client", "DIM_PRODUIT": "dim_produit",
        "DIM_VENDEUR": "dim_vendeur", "FAIT_VENTES": "fait_ventes"}
RAW_TABLES = ("orders", "items", "customers", "products", "sellers", "reviews", "translation", "payments")

MONEY = 4
SCORE = 12


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def dec(x: str, scale: int = MONEY) -> str:
    prec = 18 if scale <= 6 else 28
    return f"CAST({x} AS DECIMAL({prec},{scale}))"


def rsum(x: str, digits: int = 2, scale: int = MONEY) -> str:
    return f"CAST(ROUND(SUM({dec(x, scale)}), {digits}) AS DOUBLE)"


def ravg(x: str, digits: int, scale: int = MONEY) -> str:
    s = f"CAST(SUM({dec(x, scale)}) AS DOUBLE)"
    p = f"CAST({10 ** digits} AS DOUBLE)"
    return f"(SIGN({s}) * FLOOR(ABS({s}) / COUNT({x}) * {p} + CAST(0.5 AS DOUBLE)) / {p})"


REV = f"({dec('prix_unitaire')} + {dec('frais_livraison')})"

_states = ", ".join(_q(s) for s in td.STATE_BY_NATION)
_status = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in td.STATUS_BY_LETTER.items())
_region = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in REGION_BY_STATE.items())
_item_order = ", ".join(f"{c} NULLS FIRST" for c in td.ITEM_ORDER)

ADAPTER = [
    f"""src_last_ship AS (SELECT l_orderkey, MAX(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey)""",
    f"""src_orders AS (
  SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id,
         CASE o.o_orderstatus {_status} END AS order_status,
         o.o_orderdate AS order_purchase_timestamp,
         CASE WHEN o.o_orderkey % {td.UNDELIVERED_EVERY} = 0 THEN NULL ELSE s.last_ship END AS order_delivered_customer_date,
         o.o_orderdate + INTERVAL {td.ESTIMATED_DAYS} DAY AS order_estimated_delivery_date
  FROM orders o LEFT JOIN src_last_ship s ON o.o_orderkey = s.l_orderkey)""",
    f"""src_items AS (
  SELECT l_orderkey AS order_id,
         CAST(ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY {_item_order}) AS INTEGER) AS order_item_id,
         l_partkey AS product_id, l_suppkey AS seller_id, l_extendedprice AS price,
         CAST(ROUND(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) AS DOUBLE) AS freight_value
  FROM lineitem)""",
    f"""src_reviews AS (
  SELECT o_orderkey AS order_id, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS review_score
  FROM orders WHERE o_orderkey % {td.UNREVIEWED_EVERY} <> 0
  UNION ALL
  SELECT o_orderkey AS order_id, 1 + CAST(substr(o_orderpriority, 1, 1) AS INTEGER) % 5 AS review_score
  FROM orders WHERE o_orderkey % {td.UNREVIEWED_EVERY} <> 0 AND o_orderkey % {td.SECOND_REVIEW_EVERY} = 0)""",
    """src_payments AS (SELECT l_orderkey AS order_id, l_extendedprice AS payment_value FROM lineitem)""",
    f"""src_products AS (
  SELECT p_partkey AS product_id,
         CASE WHEN p_partkey % {td.UNCATEGORISED_EVERY} = 0 THEN NULL ELSE p_brand END AS product_category_name,
         CAST(p_size * 100 AS DOUBLE) AS product_weight_g
  FROM part)""",
    f"""src_translation AS (
  SELECT product_category_name, 'cat_' || CAST(n AS VARCHAR) AS product_category_name_english
  FROM (SELECT DISTINCT p_brand AS product_category_name,
               TRY_CAST(string_split(p_brand, '#')[-1] AS INTEGER) AS n FROM part)
  WHERE n <= {td.TRANSLATED_BRANDS})""",
    f"""src_customers AS (
  SELECT c_custkey AS customer_id, c_mktsegment AS customer_city,
         [{_states}][c_nationkey + 1] AS customer_state FROM customer)""",
    f"""src_sellers AS (
  SELECT s_suppkey AS seller_id, s_name AS seller_city,
         [{_states}][s_nationkey + 1] AS seller_state FROM supplier)""",
]

STAR = [
    """delivered AS (
  SELECT * FROM src_orders WHERE order_status = 'delivered' AND order_purchase_timestamp IS NOT NULL)""",
    """dim_temps AS (
  SELECT date_achat, CAST(ROW_NUMBER() OVER (ORDER BY date_achat) AS INTEGER) AS temps_id,
         CAST(day(date_achat) AS INTEGER) AS jour, CAST(month(date_achat) AS INTEGER) AS mois,
         CAST(quarter(date_achat) AS INTEGER) AS trimestre, CAST(year(date_achat) AS INTEGER) AS annee,
         monthname(date_achat) AS nom_mois, strftime(date_achat, '%Y-%m-%d') AS date_str
  FROM (SELECT DISTINCT CAST(order_purchase_timestamp AS DATE) AS date_achat FROM delivered))""",
    f"""dim_client AS (
  SELECT client_id, ville, etat, region FROM (
    SELECT customer_id AS client_id, customer_city AS ville, customer_state AS etat,
           COALESCE(CASE customer_state {_region} END, {_q(DEFAULT_REGION)}) AS region
    FROM src_customers)
  QUALIFY ROW_NUMBER() OVER (PARTITION BY client_id ORDER BY ville NULLS FIRST, etat NULLS FIRST) = 1)""",
    f"""dim_produit AS (
  SELECT produit_id, categorie, poids_g FROM (
    SELECT p.product_id AS produit_id,
           COALESCE(t.product_category_name_english, p.product_category_name, {_q(DEFAULT_CATEGORY)}) AS categorie,
           p.product_weight_g AS poids_g
    FROM src_products p LEFT JOIN src_translation t ON p.product_category_name = t.product_category_name)
  QUALIFY ROW_NUMBER() OVER (PARTITION BY produit_id ORDER BY categorie NULLS FIRST, poids_g NULLS FIRST) = 1)""",
    """dim_vendeur AS (
  SELECT vendeur_id, ville, etat FROM (
    SELECT seller_id AS vendeur_id, seller_city AS ville, seller_state AS etat FROM src_sellers)
  QUALIFY ROW_NUMBER() OVER (PARTITION BY vendeur_id ORDER BY ville NULLS FIRST, etat NULLS FIRST) = 1)""",
    """order_scores AS (
  SELECT order_id, AVG(CAST(review_score AS DOUBLE)) AS score_moyen FROM src_reviews GROUP BY order_id)""",
    f"""order_payments AS (
  SELECT order_id, COALESCE(CAST(ROUND(SUM({dec('payment_value')}), 2) AS DOUBLE), CAST(0.0 AS DOUBLE)) AS montant_total
  FROM src_payments GROUP BY order_id)""",
    """fait_ventes AS (
  SELECT i.order_id AS commande_id, i.order_item_id AS item_id, o.customer_id AS client_id,
         i.product_id AS produit_id, i.seller_id AS vendeur_id, t.temps_id,
         CAST(i.price AS DOUBLE) AS prix_unitaire, CAST(i.freight_value AS DOUBLE) AS frais_livraison,
         p.montant_total, s.score_moyen AS score_satisfaction,
         round_even(date_diff('second', o.order_purchase_timestamp, o.order_delivered_customer_date)
                    / CAST(86400 AS DOUBLE), 1) AS delai_livraison_jours
  FROM src_items i
  JOIN delivered o ON i.order_id = o.order_id
  LEFT JOIN order_scores s ON i.order_id = s.order_id
  LEFT JOIN order_payments p ON i.order_id = p.order_id
  LEFT JOIN dim_temps t ON CAST(o.order_purchase_timestamp AS DATE) = t.date_achat)""",
]


def with_star(select_sql: str, extra_ctes: list[str] | None = None) -> str:
    """Prefix ``select_sql`` with the adapter, star and any extra CTEs."""
    ctes = ADAPTER + STAR + list(extra_ctes or [])
    return "WITH " + ",\n".join(ctes) + "\n" + select_sql
