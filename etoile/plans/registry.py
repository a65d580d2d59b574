"""Registry of every report: Spark callable ``(spark, sf_dir) -> DataFrame`` and DuckDB SQL.

Each callable reads the driver's test tables through the adapter and builds the star
lazily, so every report's work grows with the given tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from etoile import oracle as O
from etoile.operators import classify, kpis, quality, segments, star
from etoile.plans import jobs, reports
from etoile.plans.reports import REPORTS, Tables
from etoile.session import checkpoint_root, materialize
from etoile.sources.csv import read_csv_table, reject_counts, rejected
from etoile.sources.schemas import FOREIGN_KEYS, PRIMARY_KEYS, RANGE_CHECKS, RAW_COLUMNS, not_null_columns
from etoile.sources.testdata import load_test_tables, raw_from_testdata
from etoile.sources.warehouse import read_star

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def sql_only(name: str, sql: str) -> None:
    """A report of the warehouse tables (``plans.reports``) with its DuckDB oracle."""
    QUERIES[name] = from_star(name)
    ORACLE[name] = sql


def mining(name: str) -> None:
    """A model-fitting report: no SQL equivalent (rows-only check)."""
    QUERIES[name] = from_star(name)


def from_star(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return REPORTS[name](star_tables(spark, sf_dir))
    run.__name__ = f"q_{name}"
    return run


def raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return raw_from_testdata(spark, sf_dir)


def star_tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(star.build_star(raw_from_testdata(spark, sf_dir, delivered_only=True)))


# ------------------------------------------------------------------ A: raw sources

_RAW_SQL = {
    "orders": "SELECT * FROM src_orders", "items": "SELECT * FROM src_items",
    "customers": "SELECT * FROM src_customers", "products": "SELECT * FROM src_products",
    "sellers": "SELECT * FROM src_sellers", "reviews": "SELECT * FROM src_reviews",
    "translation": "SELECT * FROM src_translation", "payments": "SELECT * FROM src_payments",
}

for _name, _sql in _RAW_SQL.items():
    register(f"raw_{_name}", O.with_star(_sql))(lambda spark, sf, _n=_name: raw(spark, sf)[_n])


# The same tables as CSV files: written from the adapter to the checkpoint folder (with some bad
# timestamps), read back by the CSV reader. Ids are text there.
BAD_EVERY = 13


def _csv(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = raw(spark, sf_dir)[name]
    if name == "orders":
        bad = F.when(F.col("order_id") % BAD_EVERY == 0, F.lit("not a time"))
        df = df.withColumn("order_purchase_timestamp", F.coalesce(bad, F.col("order_purchase_timestamp").cast("string")))
    folder = f"{checkpoint_root(spark).rstrip('/')}/etoile-csv-{uuid.uuid4().hex}"
    df.write.option("header", True).csv(f"{folder}/{name}")
    return read_csv_table(spark, f"{folder}/{name}", name)


def _csv_sql(name: str) -> str:
    """Ids as text, timestamps that cannot be read as null; else the adapter's rows."""
    def column(c: str, kind) -> str:
        if c == "order_purchase_timestamp":
            return f"CASE WHEN order_id % {BAD_EVERY} = 0 THEN NULL ELSE {c} END AS {c}"
        return f"CAST({c} AS VARCHAR) AS {c}" if isinstance(kind, T.StringType) else c
    return O.with_star(f"SELECT {', '.join(column(c, k) for c, k in RAW_COLUMNS[name])} FROM src_{name}")


for _name in _RAW_SQL:
    register(f"csv_{_name}", _csv_sql(_name))(lambda spark, sf, _n=_name: _csv(spark, sf, _n))


# CSV files whose order matters: some keys are there twice with other values, and the lines stand in the order of a hash, over several part files.
# The dimensions keep the first line of a key and number dates by first appearance.
AGAIN_EVERY = 3
_AGAIN = {"customers": ("customer_id", "customer_city"), "sellers": ("seller_id", "seller_city"), "products": ("product_id", "product_category_name"),
          "orders": ("order_id", None), "translation": ("product_category_name", "product_category_name_english")}


def _line(key: str, copy: int) -> F.Column:
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(copy))))


def _in_order(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The CSV of a source with repeated keys, written line by line in the order of ``_line``, read back with positions."""
    key, other = _AGAIN[name]
    df = raw(spark, sf_dir)[name].withColumn("_line", _line(key, 0))
    if other:
        again = df.where(F.length(F.col(key).cast("string")) % AGAIN_EVERY != 1)
        df = df.unionByName(again.withColumn(other, F.concat(F.lit("again "), F.col(key).cast("string"))).withColumn("_line", _line(key, 1)))
    folder = f"{checkpoint_root(spark).rstrip('/')}/etoile-csv-{uuid.uuid4().hex}"
    df.repartitionByRange("_line").sortWithinPartitions("_line").drop("_line").write.option("header", True).csv(f"{folder}/{name}")
    return read_csv_table(spark, f"{folder}/{name}", name, position=True)


def _lines_sql(name: str) -> str:
    key, other = _AGAIN[name]
    line = f"md5(CAST({key} AS VARCHAR) || '|' || "
    sql = f"SELECT *, {line}'0') AS line FROM src_{name}"
    if other:
        sql += (f" UNION ALL SELECT * REPLACE ('again ' || CAST({key} AS VARCHAR) AS {other}), {line}'1') AS line FROM src_{name} "
                f"WHERE length(CAST({key} AS VARCHAR)) % {AGAIN_EVERY} <> 1")
    return f"lines_{name} AS ({sql})"


def _first(name: str) -> str:
    key = _AGAIN[name][0]
    return f"QUALIFY ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY line) = 1"


@register("csv_first_client", O.with_star(f"""
SELECT CAST(customer_id AS VARCHAR) AS client_id, customer_city AS ville, customer_state AS etat, region FROM lines_customers
JOIN (SELECT client_id, region FROM dim_client) d ON d.client_id = customer_id {_first("customers")}""", [_lines_sql("customers")]))
def q_first_client(spark, sf):
    """B14, B15 over a file with repeated clients: the first line counts."""
    return star.dim_client(_in_order(spark, sf, "customers"))


@register("csv_first_vendeur", O.with_star(f"""
SELECT CAST(seller_id AS VARCHAR) AS vendeur_id, seller_city AS ville, seller_state AS etat FROM lines_sellers {_first("sellers")}""", [_lines_sql("sellers")]))
def q_first_vendeur(spark, sf):
    """B14, B17 over a file with repeated sellers."""
    return star.dim_vendeur(_in_order(spark, sf, "sellers"))


@register("csv_first_produit", O.with_star("""
SELECT CAST(product_id AS VARCHAR) AS produit_id, COALESCE(t.product_category_name_english, p.product_category_name, 'unknown') AS categorie, product_weight_g AS poids_g
FROM lines_products p LEFT JOIN lines_translation t ON p.product_category_name = t.product_category_name
QUALIFY ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY p.line, t.line) = 1""", [_lines_sql("products"), _lines_sql("translation")]))
def q_first_produit(spark, sf):
    """B14, B16 over files with repeated products and translations: the first line of the product, then of the translation."""
    return star.dim_produit(_in_order(spark, sf, "products"), _in_order(spark, sf, "translation"))


@register("csv_first_temps", O.with_star("""
SELECT d.* REPLACE (CAST(ROW_NUMBER() OVER (ORDER BY f.line) AS INTEGER) AS temps_id) FROM dim_temps d JOIN (
  SELECT CAST(order_purchase_timestamp AS DATE) AS date_achat, MIN(line) AS line FROM lines_orders
  WHERE order_status = 'delivered' AND order_purchase_timestamp IS NOT NULL GROUP BY 1) f USING (date_achat)""", [_lines_sql("orders")]))
def q_first_temps(spark, sf):
    """Dates numbered in order of their first delivered order in the file."""
    return star.dim_temps(star.delivered_orders(_in_order(spark, sf, "orders")))


# CSV files with records of a wrong number of fields and cells that are no values
SHORT_EVERY, LONG_EVERY, BAD_PRICE_EVERY = 11, 17, 7


def _flawed(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Path of a source written line by line (its rows have no quotes or separators), some lines with a field too few or too many."""
    df = raw(spark, sf_dir)[name]
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    if name == "orders":
        cells[df.columns.index("order_purchase_timestamp")] = F.when(F.col("order_id") % BAD_EVERY == 0, "not a time").otherwise(cells[df.columns.index("order_purchase_timestamp")])
    line = F.concat_ws(",", *cells)
    if name == "items":
        bad = F.col("product_id") % BAD_PRICE_EVERY == 0
        line = F.concat_ws(",", *[F.when(bad, "n/a").otherwise(x) if c == "price" else x for c, x in zip(df.columns, cells)])
        short = F.concat_ws(",", *cells[:-1])
        line = F.when(F.col("order_id") % SHORT_EVERY == 0, short).when(F.col("order_id") % LONG_EVERY == 0, F.concat(line, F.lit(",more"))).otherwise(line)
    path = f"{checkpoint_root(spark).rstrip('/')}/etoile-csv-{uuid.uuid4().hex}/{name}"
    # one column named as the header line, and a separator that no line holds: lines are written as they are
    df.select(line.alias(",".join(df.columns))).write.option("header", True).option("sep", "\u0001").csv(path)
    return path


@register("csv_rejects", O.with_star(f"""
SELECT 'orders' AS table_name, 'order_purchase_timestamp' AS column_name, 'cast' AS reason, COUNT(*) AS nb FROM src_orders WHERE order_id % {BAD_EVERY} = 0
UNION ALL SELECT 'items', NULL, 'fields', COUNT(*) FROM src_items WHERE order_id % {SHORT_EVERY} = 0 OR order_id % {LONG_EVERY} = 0
UNION ALL SELECT 'items', 'price', 'cast', COUNT(*) FROM src_items WHERE order_id % {SHORT_EVERY} <> 0 AND product_id % {BAD_PRICE_EVERY} = 0"""))
def q_rejects(spark, sf):
    """What the CSV reader could not read, by table, column and reason."""
    return reject_counts(rejected(spark, _flawed(spark, sf, "orders"), "orders").unionByName(rejected(spark, _flawed(spark, sf, "items"), "items")))


@register("warehouse_fait_ventes", O.with_star("SELECT * FROM fait_ventes"))
def q_warehouse_fact(spark, sf):
    """The ETL job's fact, written to a warehouse in the checkpoint folder and read back."""
    root = f"{checkpoint_root(spark).rstrip('/')}/etoile-warehouse-{uuid.uuid4().hex}"
    jobs.run_etl(spark, raw(spark, sf), root)
    return read_star(spark, root)["FAIT_VENTES"]


# ------------------------------------------------------------------ B: star builders

@register("delivered_orders", O.with_star("SELECT * FROM delivered"))
def q_delivered(spark, sf):
    return star.delivered_orders(raw_from_testdata(spark, sf, delivered_only=True)["orders"])


sql_only("dim_temps", O.with_star("SELECT * FROM dim_temps"))


sql_only("dim_client", O.with_star("SELECT * FROM dim_client"))


sql_only("dim_produit", O.with_star("SELECT * FROM dim_produit"))


sql_only("dim_vendeur", O.with_star("SELECT * FROM dim_vendeur"))


@register("order_scores", O.with_star("SELECT * FROM order_scores"))
def q_order_scores(spark, sf):
    return star.order_scores(raw(spark, sf)["reviews"])


@register("order_payments", O.with_star("SELECT * FROM order_payments"))
def q_order_payments(spark, sf):
    return star.order_payments(raw(spark, sf)["payments"])


@register("translated_products", O.with_star(
    "SELECT p.product_id, p.product_category_name, p.product_weight_g, "
    f"COALESCE(t.product_category_name_english, p.product_category_name, 'unknown') AS product_category_name_english "
    "FROM src_products p LEFT JOIN src_translation t ON p.product_category_name = t.product_category_name"))
def q_translated(spark, sf):
    r = raw(spark, sf)
    return star.translated_products(r["products"], r["translation"])


sql_only("fait_ventes", O.with_star("SELECT * FROM fait_ventes"))


# ------------------------------------------------------------------ K: KPI queries

sql_only("kpi1_ca_mensuel_region", O.with_star(f"""
SELECT t.annee, t.mois, t.nom_mois, c.region,
       {O.rsum(O.REV)} AS ca_total,
       COUNT(DISTINCT f.commande_id) AS nb_commandes,
       {O.ravg('f.prix_unitaire', 2)} AS panier_moyen
FROM fait_ventes f JOIN dim_temps t ON f.temps_id = t.temps_id JOIN dim_client c ON f.client_id = c.client_id
GROUP BY t.annee, t.mois, t.nom_mois, c.region
ORDER BY t.annee, t.mois, ca_total DESC"""))


sql_only("kpi2_ca_mensuel_categorie", O.with_star(f"""
SELECT t.annee, t.mois, p.categorie,
       {O.rsum('f.prix_unitaire')} AS ca_categorie,
       COUNT(*) AS nb_articles_vendus
FROM fait_ventes f JOIN dim_temps t ON f.temps_id = t.temps_id JOIN dim_produit p ON f.produit_id = p.produit_id
GROUP BY t.annee, t.mois, p.categorie
ORDER BY t.annee, t.mois, ca_categorie DESC"""))


sql_only("kpi3_top_vendeurs", O.with_star(f"""
SELECT v.vendeur_id, v.etat,
       {O.ravg('f.score_satisfaction', 2, O.SCORE)} AS score_moyen,
       COUNT(DISTINCT f.commande_id) AS nb_commandes,
       {O.rsum('f.prix_unitaire')} AS ca_total
FROM fait_ventes f JOIN dim_vendeur v ON f.vendeur_id = v.vendeur_id
WHERE f.score_satisfaction IS NOT NULL
GROUP BY v.vendeur_id, v.etat
ORDER BY score_moyen DESC, v.vendeur_id ASC
LIMIT 20"""))


sql_only("kpi4_delai_etat", O.with_star(f"""
SELECT c.etat, c.region,
       {O.ravg('f.delai_livraison_jours', 1)} AS delai_moyen_jours,
       ROUND(MIN(f.delai_livraison_jours), 1) AS delai_min,
       ROUND(MAX(f.delai_livraison_jours), 1) AS delai_max,
       COUNT(DISTINCT f.commande_id) AS nb_commandes
FROM fait_ventes f JOIN dim_client c ON f.client_id = c.client_id
WHERE f.delai_livraison_jours > 0
GROUP BY c.etat, c.region
ORDER BY delai_moyen_jours DESC"""))


sql_only("kpi5_top_categories_satisfaction", O.with_star(f"""
SELECT p.categorie,
       {O.ravg('f.score_satisfaction', 2, O.SCORE)} AS score_moyen,
       COUNT(*) AS nb_evaluations
FROM fait_ventes f JOIN dim_produit p ON f.produit_id = p.produit_id
WHERE f.score_satisfaction IS NOT NULL
GROUP BY p.categorie
HAVING COUNT(*) > 50
ORDER BY score_moyen DESC, p.categorie ASC
LIMIT 10"""))


sql_only("kpi6_ca_trimestriel", O.with_star(f"""
SELECT t.annee, t.trimestre, CAST(t.annee AS VARCHAR) || '-T' || CAST(t.trimestre AS VARCHAR) AS periode,
       {O.rsum(O.REV)} AS ca_total,
       COUNT(DISTINCT f.commande_id) AS nb_commandes
FROM fait_ventes f JOIN dim_temps t ON f.temps_id = t.temps_id
GROUP BY t.annee, t.trimestre
ORDER BY t.annee, t.trimestre"""))


# A10: the same KPIs run as SQL text through spark.sql (same oracles as K6 and K3)
sql_only("sql_ca_trimestriel", ORACLE["kpi6_ca_trimestriel"])
sql_only("sql_top_vendeurs", ORACLE["kpi3_top_vendeurs"])


# ------------------------------------------------------------------ Q: data quality


_PK_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, 'pk_{'_'.join(k)}' AS check_name, COUNT(*) AS nb_violations "
    f"FROM (SELECT {', '.join(k)} FROM {O.VIEW[t]} GROUP BY {', '.join(k)} HAVING COUNT(*) > 1)"
    for t, k in O.PRIMARY_KEYS.items())


sql_only("dq_pk", O.with_star(_PK_SQL))


_FK_SQL = " UNION ALL ".join(
    f"SELECT 'FAIT_VENTES' AS table_name, 'fk_{c}_{d}' AS check_name, COUNT(*) AS nb_violations "
    f"FROM fait_ventes f WHERE f.{c} IS NOT NULL AND NOT EXISTS "
    f"(SELECT 1 FROM {O.VIEW[d]} x WHERE x.{dc} = f.{c})"
    for c, d, dc in O.FOREIGN_KEYS)


sql_only("dq_fk", O.with_star(_FK_SQL))


_RANGE_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, 'range_{c}' AS check_name, "
    f"COUNT(CASE WHEN NOT ({c} BETWEEN {lo} AND {hi}) THEN 1 END) AS nb_violations FROM {O.VIEW[t]}"
    for t, c, lo, hi in O.RANGE_CHECKS)


sql_only("dq_ranges", O.with_star(_RANGE_SQL))


_NN_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, 'not_null_{c}' AS check_name, "
    f"COUNT(CASE WHEN {c} IS NULL THEN 1 END) AS nb_violations FROM {O.VIEW[t]}"
    for t in O.PRIMARY_KEYS for c in O.not_null_columns(t))


sql_only("dq_not_null", O.with_star(_NN_SQL))


sql_only("dq_defaults", O.with_star(
    "SELECT commande_id, item_id, client_id, produit_id, vendeur_id, temps_id, "
    "COALESCE(prix_unitaire, CAST(0.0 AS DOUBLE)) AS prix_unitaire, "
    "COALESCE(frais_livraison, CAST(0.0 AS DOUBLE)) AS frais_livraison, "
    "montant_total, score_satisfaction, delai_livraison_jours FROM fait_ventes"))


sql_only("dq_defaults_produit", O.with_star(
    "SELECT produit_id, COALESCE(categorie, 'unknown') AS categorie, poids_g FROM dim_produit"))


sql_only("table_counts", O.with_star(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS nb FROM {O.VIEW[t]}" for t in O.PRIMARY_KEYS)))


@register("source_counts", O.with_star(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS nb FROM src_{t}" for t in O.RAW_TABLES)))
def q_source_counts(spark, sf):
    """Rows per source table."""
    return quality.table_counts(raw(spark, sf), O.RAW_TABLES)


# ------------------------------------------------------------------ D: dashboard data

_DASH_CA_SQL = f"""
SELECT t.annee, t.mois, t.nom_mois, c.region,
       {O.rsum(O.REV)} AS ca_total,
       COUNT(DISTINCT f.commande_id) AS nb_commandes,
       {O.ravg('f.prix_unitaire', 2)} AS panier_moyen,
       CAST(t.annee AS VARCHAR) || '-' || lpad(CAST(t.mois AS VARCHAR), 2, '0') AS periode
FROM fait_ventes f JOIN dim_temps t ON f.temps_id = t.temps_id JOIN dim_client c ON f.client_id = c.client_id
GROUP BY t.annee, t.mois, t.nom_mois, c.region"""
_DASH_DELAI_SQL = f"""
SELECT c.etat, c.region, {O.ravg('f.delai_livraison_jours', 1)} AS delai_moyen,
       COUNT(DISTINCT f.commande_id) AS nb_commandes
FROM fait_ventes f JOIN dim_client c ON f.client_id = c.client_id
WHERE f.delai_livraison_jours > 0 GROUP BY c.etat, c.region"""
_DASH_CAT_SQL = f"""
SELECT p.categorie, {O.rsum('f.prix_unitaire')} AS ca_categorie,
       {O.ravg('f.score_satisfaction', 2, O.SCORE)} AS score_moyen, COUNT(*) AS nb_ventes
FROM fait_ventes f JOIN dim_produit p ON f.produit_id = p.produit_id
GROUP BY p.categorie ORDER BY ca_categorie DESC, p.categorie ASC LIMIT 15"""
_DASH = [f"dash_ca AS ({_DASH_CA_SQL})", f"dash_delai AS ({_DASH_DELAI_SQL})", f"dash_cat AS ({_DASH_CAT_SQL})"]


sql_only("dash_ca", O.with_star("SELECT * FROM dash_ca", _DASH))


sql_only("dash_top_categories", O.with_star("SELECT * FROM dash_cat", _DASH))


sql_only("dash_categories_chart", O.with_star(
    "SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY ca_categorie ASC, categorie DESC) AS INTEGER) AS ordre "
    "FROM dash_cat", _DASH))


sql_only("dash_delai", O.with_star("SELECT * FROM dash_delai", _DASH))


sql_only("dash_scores", O.with_star(
    "SELECT score_satisfaction, COUNT(*) AS nb FROM fait_ventes WHERE score_satisfaction IS NOT NULL "
    "GROUP BY score_satisfaction"))


sql_only("dash_trend", O.with_star(f"""
SELECT t.annee, t.trimestre, CAST(t.annee AS VARCHAR) || '-T' || CAST(t.trimestre AS VARCHAR) AS periode,
       {O.rsum(O.REV)} AS ca_total
FROM fait_ventes f JOIN dim_temps t ON f.temps_id = t.temps_id GROUP BY t.annee, t.trimestre"""))


sql_only("dash_headline", O.with_star(f"""
SELECT a.ca_total, a.nb_commandes, b.score_global, c.delai_global FROM
  (SELECT {O.rsum('ca_total')} AS ca_total, CAST(SUM(nb_commandes) AS BIGINT) AS nb_commandes FROM dash_ca) a,
  (SELECT {O.ravg('score_satisfaction', 2, O.SCORE)} AS score_global FROM fait_ventes
   WHERE score_satisfaction IS NOT NULL) b,
  (SELECT {O.ravg('delai_livraison_jours', 1)} AS delai_global FROM fait_ventes
   WHERE delai_livraison_jours > 0) c""", _DASH))


sql_only("dash_regions", O.with_star(
    "SELECT 'Toutes' AS region, 0 AS ordre UNION ALL "
    "SELECT region, CAST(ROW_NUMBER() OVER (ORDER BY region) AS INTEGER) AS ordre "
    "FROM (SELECT DISTINCT region FROM dash_ca)", _DASH))


def _ca_region_sql(region: str | None) -> str:
    where = f"WHERE region = '{region}'" if region else ""
    return O.with_star(f"SELECT periode, {O.rsum('ca_total')} AS ca_total FROM dash_ca {where} GROUP BY periode",
                       _DASH)


def _delai_region_sql(region: str | None) -> str:
    where = f"WHERE region = '{region}'" if region else ""
    return O.with_star(f"""
SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY delai_moyen ASC, etat DESC) AS INTEGER) AS ordre FROM (
  SELECT * FROM dash_delai {where} ORDER BY delai_moyen DESC, etat ASC LIMIT 20)""", _DASH)


sql_only("dash_ca_region", _ca_region_sql(None))


sql_only("dash_ca_region_nordeste", _ca_region_sql("Nordeste"))


sql_only("dash_delai_region", _delai_region_sql(None))


sql_only("dash_delai_region_sudeste", _delai_region_sql("Sudeste"))


# ------------------------------------------------------------------ the same reports from the stored order roll-up

def _with_orders(spark: SparkSession, sf_dir: str) -> Tables:
    t = star_tables(spark, sf_dir)
    t["FAIT_COMMANDES"] = materialize(kpis.order_rollup(t["FAIT_VENTES"]), "commandes")
    return t


@register("commandes", O.with_star(f"""
SELECT commande_id, client_id, temps_id, COUNT(*) AS nb_articles, CAST(SUM({O.REV}) AS DOUBLE) AS ca_exact, CAST(SUM({O.dec('prix_unitaire')}) AS DOUBLE) AS prix_exact,
  COUNT(prix_unitaire) AS nb_prix, CAST(SUM({O.dec('score_satisfaction', O.SCORE)}) AS DOUBLE) AS score_exact, COUNT(score_satisfaction) AS nb_scores,
  CAST(SUM({O.dec('delai_livraison_jours')}) AS DOUBLE) AS delai_exact, COUNT(delai_livraison_jours) AS nb_delais
FROM fait_ventes GROUP BY commande_id, client_id, temps_id"""))
def q_orders(spark, sf):
    """The order roll-up; its exact decimals as doubles."""
    orders = kpis.order_rollup(star_tables(spark, sf)["FAIT_VENTES"])
    return orders.select(*[F.col(c).cast("double").alias(c) if c.endswith("_exact") else c for c in orders.columns])


def from_orders(name: str) -> None:
    """A report over the stored order roll-up: the same rows as from the fact."""
    QUERIES[f"commandes_{name}"] = lambda spark, sf, _n=name: REPORTS[_n](_with_orders(spark, sf))
    ORACLE[f"commandes_{name}"] = ORACLE[name]


for _name in ("kpi1_ca_mensuel_region", "kpi6_ca_trimestriel", "dash_ca", "dash_trend"):
    from_orders(_name)


# ------------------------------------------------------------------ M21-M28: forecast

_TREND = [f"""trend AS (
  SELECT t.annee, t.trimestre, CAST(t.annee AS VARCHAR) || '-T' || CAST(t.trimestre AS VARCHAR) AS periode,
         {O.rsum(O.REV)} AS ca_total,
         CAST(ROW_NUMBER() OVER (ORDER BY t.annee, t.trimestre) - 1 AS INTEGER) AS t
  FROM fait_ventes f JOIN dim_temps t ON f.temps_id = t.temps_id GROUP BY t.annee, t.trimestre)""",
          """sums AS (
  SELECT COUNT(*) AS n, SUM(CAST(t AS BIGINT)) AS st, SUM(CAST(t AS BIGINT) * CAST(t AS BIGINT)) AS stt,
         SUM(CAST(ca_total AS DECIMAL(38,2))) AS sy,
         SUM(CAST(t AS DECIMAL(38,0)) * CAST(ca_total AS DECIMAL(38,2))) AS sty,
         SUM(CAST(ca_total AS DECIMAL(38,2)) * CAST(ca_total AS DECIMAL(38,2))) AS syy
  FROM trend WHERE ca_total IS NOT NULL)""",
          """parts AS (
  SELECT n, st, sy, CAST(n * stt - st * st AS DOUBLE) AS den, CAST(n * sty - st * sy AS DOUBLE) AS num,
         CAST(n * syy - sy * sy AS DOUBLE) AS var_y FROM sums)""",
          """model AS (
  SELECT CASE WHEN den <> 0 THEN num / den END AS pente,
         (CAST(sy AS DOUBLE) - (CASE WHEN den <> 0 THEN num / den END) * CAST(st AS DOUBLE)) / n AS ordonnee,
         CASE WHEN den <> 0 AND var_y <> 0 THEN (num * num) / (den * var_y) END AS r2, n
  FROM parts)"""]


sql_only("trend_index", O.with_star("SELECT * FROM trend", _TREND))


sql_only("forecast_model", O.with_star("SELECT * FROM model", _TREND))


sql_only("forecast_series", O.with_star("""
SELECT tr.t, tr.annee, tr.trimestre, tr.periode, tr.ca_total, m.ordonnee + m.pente * tr.t AS ca_prevu,
       'reel' AS type FROM trend tr, model m
UNION ALL
SELECT CAST(l.t_last + s.step AS INTEGER) AS t,
       CAST(FLOOR((l.annee * 4 + l.trimestre - 1 + s.step) / 4) AS INTEGER) AS annee,
       CAST((l.annee * 4 + l.trimestre - 1 + s.step) % 4 + 1 AS INTEGER) AS trimestre,
       CAST(FLOOR((l.annee * 4 + l.trimestre - 1 + s.step) / 4) AS INTEGER) || '-T'
         || CAST((l.annee * 4 + l.trimestre - 1 + s.step) % 4 + 1 AS INTEGER) AS periode,
       CAST(NULL AS DOUBLE) AS ca_total, m.ordonnee + m.pente * (l.t_last + s.step) AS ca_prevu,
       'prevision' AS type
FROM (SELECT t AS t_last, annee, trimestre FROM trend ORDER BY t DESC LIMIT 1) l,
     (SELECT * FROM range(1, 3) r(step)) s, model m""", _TREND))


from_orders("trend_index")


# ------------------------------------------------------------------ M1-M10: segments

_PROFILE = [f"""profile AS (
  SELECT client_id, COUNT(DISTINCT commande_id) AS freq_achat,
         {O.ravg('prix_unitaire', 2)} AS montant_moyen,
         {O.rsum(O.REV)} AS ca_total,
         {O.ravg('score_satisfaction', 2, O.SCORE)} AS score_moyen,
         {O.ravg('delai_livraison_jours', 1)} AS delai_moyen
  FROM fait_ventes GROUP BY client_id HAVING COUNT(DISTINCT commande_id) >= 1)"""]


sql_only("client_profile", O.with_star("SELECT * FROM profile", _PROFILE))
from_orders("client_profile")


_Z = ", ".join(
    f"CAST(COALESCE({c}, 0) AS DOUBLE) AS {c}" for c in segments.FEATURES)
_ZSQL = ("SELECT client_id, " + ", ".join(segments.FEATURES) + ", "
         + ", ".join(f"ROUND(CASE WHEN s_{c} > 0 THEN ({c} - m_{c}) / s_{c} ELSE CAST(0.0 AS DOUBLE) END, 9) AS z_{c}"
                     for c in segments.FEATURES)
         + " FROM feat, (SELECT " + ", ".join(f"AVG({c}) AS m_{c}, STDDEV_POP({c}) AS s_{c}"
                                               for c in segments.FEATURES) + " FROM feat) st")


sql_only("client_zscores", O.with_star(_ZSQL, _PROFILE + [f"feat AS (SELECT client_id, {_Z} FROM profile)"]))


sql_only("client_sample", O.with_star(
    "SELECT * FROM profile ORDER BY md5(CAST(client_id AS VARCHAR) || '42'), client_id LIMIT 3000", _PROFILE))
mining("elbow_curve")
mining("client_segments")
mining("segment_summary")
mining("segment_sizes")
mining("segment_sample")

# from stated centers: nearest center (ties to the lower index), labels by rank of mean revenue, Lloyd's steps
_FEAT = _PROFILE + [f"feat AS (SELECT client_id, {_Z} FROM profile)",
                    "z AS MATERIALIZED (SELECT client_id, " + ", ".join(segments.FEATURES) + ", "
                    + ", ".join(f"CASE WHEN s_{c} > 0 THEN ({c} - m_{c}) / s_{c} ELSE CAST(0.0 AS DOUBLE) END AS z_{c}" for c in segments.FEATURES)
                    + " FROM feat, (SELECT " + ", ".join(f"AVG({c}) AS m_{c}, STDDEV_POP({c}) AS s_{c}" for c in segments.FEATURES) + " FROM feat) st)"]


def _nearest_cte(name: str, centers: str) -> str:
    """Each client's nearest row of ``centers`` (segment, coordinates)."""
    d = " + ".join(f"(z.z_{c} - k.z_{c}) * (z.z_{c} - k.z_{c})" for c in segments.FEATURES)
    return (f"{name} AS MATERIALIZED (SELECT z.*, k.segment, {d} AS d FROM z, {centers} k "
            "QUALIFY ROW_NUMBER() OVER (PARTITION BY client_id ORDER BY d, k.segment) = 1)")


_START = ("k0 AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, " + ", ".join(f"CAST({v} AS DOUBLE)" for v in row) + ")"
                                                        for i, row in enumerate(reports.CENTERS))
          + ") k(segment, " + ", ".join(segments.Z_FEATURES) + "))")
_GIVEN = _FEAT + [_START, _nearest_cte("near0", "k0"), f"""named AS (
  SELECT near0.*, segment_label FROM near0 JOIN (
    SELECT segment, [{", ".join("'" + x + "'" for x in segments.SEGMENT_LABELS)}][ROW_NUMBER() OVER (ORDER BY AVG(ca_total), segment)] AS segment_label
    FROM near0 GROUP BY segment) USING (segment))"""]
_LLOYD = _FEAT + [_START]
for _i in range(reports.LLOYD_STEPS):
    _LLOYD += [_nearest_cte(f"near{_i}", f"k{_i}"),
               f"k{_i + 1} AS MATERIALIZED (SELECT k.segment, " + ", ".join(f"COALESCE(AVG(n.{c}), ANY_VALUE(k.{c})) AS {c}" for c in segments.Z_FEATURES)
               + f" FROM k{_i} k LEFT JOIN near{_i} n USING (segment) GROUP BY k.segment)"]

sql_only("segments_given", O.with_star("SELECT client_id, CAST(segment AS INTEGER) AS segment, segment_label FROM named", _GIVEN))
sql_only("segment_summary_given", O.with_star(
    "SELECT segment_label, " + ", ".join(f"ROUND(AVG({c}), 2) AS {c}" for c in segments.FEATURES) + " FROM named GROUP BY segment_label", _GIVEN))
sql_only("segment_sizes_given", O.with_star("SELECT segment_label, COUNT(*) AS nb_clients FROM named GROUP BY segment_label", _GIVEN))
sql_only("segment_sample_given", O.with_star("""
SELECT p.*, CAST(n.segment AS INTEGER) AS segment, n.segment_label FROM (
  SELECT * FROM profile ORDER BY md5(CAST(client_id AS VARCHAR) || '42'), client_id LIMIT 3000) p JOIN named n USING (client_id)""", _GIVEN))
sql_only("inertia_given", O.with_star("SELECT ROUND(SUM(d), 6) AS inertie FROM near0", _GIVEN))
sql_only("lloyd_given", O.with_star(
    "SELECT CAST(segment AS INTEGER) AS segment, " + ", ".join(f"ROUND({c}, 6) AS {c}" for c in segments.Z_FEATURES)
    + f" FROM k{reports.LLOYD_STEPS}", _LLOYD))


# ------------------------------------------------------------------ M11-M20: classifier

_TRAIN = ["""training AS (
  SELECT f.commande_id, f.item_id, f.score_satisfaction, f.prix_unitaire, f.frais_livraison,
         f.delai_livraison_jours, p.categorie, c.region,
         CAST(f.score_satisfaction >= 4 AS INTEGER) AS bonne_note
  FROM fait_ventes f JOIN dim_produit p ON f.produit_id = p.produit_id JOIN dim_client c ON f.client_id = c.client_id
  WHERE f.score_satisfaction IS NOT NULL AND f.delai_livraison_jours > 0)""",
          """split AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY bonne_note ORDER BY
              md5(concat_ws('|', CAST(commande_id AS VARCHAR), CAST(item_id AS VARCHAR), '42')), commande_id, item_id)
            <= CEIL(COUNT(*) OVER (PARTITION BY bonne_note) * 0.25) AS is_test
  FROM training)"""]


sql_only("order_training_set", O.with_star("SELECT * FROM training", _TRAIN))


sql_only("onehot_levels", O.with_star(" UNION ALL ".join(
    f"SELECT '{c}' AS variable, niveau, '{c}_' || niveau AS colonne FROM "
    f"(SELECT DISTINCT {c} AS niveau FROM training) WHERE niveau <> (SELECT MIN({c}) FROM training)"
    for c in classify.CATEGORICAL), _TRAIN))


sql_only("stratified_split", O.with_star("SELECT * FROM split", _TRAIN))


sql_only("class_weights", O.with_star("""
SELECT bonne_note, COUNT(*) AS nb,
       CAST(SUM(COUNT(*)) OVER () AS DOUBLE) / CAST(COUNT(*) OVER () * COUNT(*) AS DOUBLE) AS poids
FROM split WHERE NOT is_test GROUP BY bonne_note""", _TRAIN))


def _tree_ctes() -> list[str]:
    """The tree grown level by level: ``node`` of every row after each level, every threshold of every feature, the best per node."""
    numeric, w = classify.NUMERIC, ("w0", "w1")
    features = [*numeric, *classify.CATEGORICAL]
    first = {c: f"(SELECT MIN({c}) FROM training)" for c in classify.CATEGORICAL}

    def side(a: str, b: str) -> str:
        x, y = f"({a} * {w[0]})", f"({b} * {w[1]})"
        return f"({x} * {x} + {y} * {y}) / ({x} + {y})"

    def row(d: int, extra: str) -> str:
        return (f"SELECT node, {d} AS depth, {extra}, n0, n1, n0 * w0 + n1 * w1 AS poids, "
                "1 - (n0 * w0 / (n0 * w0 + n1 * w1)) * (n0 * w0 / (n0 * w0 + n1 * w1)) - (n1 * w1 / (n0 * w0 + n1 * w1)) * (n1 * w1 / (n0 * w0 + n1 * w1)) AS gini, "
                "CAST(n1 * w1 > n0 * w0 AS INTEGER) AS prediction")
    out = ["""w AS MATERIALIZED (SELECT CAST(n0 + n1 AS DOUBLE) / CAST(2 * n0 AS DOUBLE) AS w0, CAST(n0 + n1 AS DOUBLE) / CAST(2 * n1 AS DOUBLE) AS w1 FROM (
  SELECT COUNT(*) FILTER (bonne_note = 0) AS n0, COUNT(*) FILTER (bonne_note = 1) AS n1 FROM split WHERE NOT is_test))""",
           "at0 AS MATERIALIZED (SELECT *, 1 AS node FROM split)"]
    for d in range(classify.MAX_DEPTH + 1):
        out.append(f"""tot{d} AS MATERIALIZED (SELECT node, COUNT(*) FILTER (bonne_note = 0) AS n0, COUNT(*) FILTER (bonne_note = 1) AS n1
  FROM at{d} WHERE NOT is_test AND node >= {2 ** d} GROUP BY node)""")
        if d == classify.MAX_DEPTH:
            break
        rows = f"FROM at{d} a JOIN tot{d} t USING (node) WHERE NOT is_test AND n0 > 0 AND n1 > 0"
        per = "COUNT(*) FILTER (bonne_note = 0) AS a0, COUNT(*) FILTER (bonne_note = 1) AS a1, ANY_VALUE(n0) AS n0, ANY_VALUE(n1) AS n1"
        long = " UNION ALL ".join(f"SELECT node, {i} AS f, {c} AS v, {per} {rows} GROUP BY node, {c}" for i, c in enumerate(numeric))
        dummies = " UNION ALL ".join(f"SELECT node, {len(numeric) + i} AS f, {c} AS niveau, {per} {rows} AND {c} <> {first[c]} GROUP BY node, {c}"
                                     for i, c in enumerate(classify.CATEGORICAL))
        out.append(f"""cut{d} AS (
  SELECT node, f, CAST(NULL AS VARCHAR) AS niveau, (v + next) / 2 AS seuil, l0, l1, n0, n1 FROM (
    SELECT *, LEAD(v) OVER o AS next, SUM(a0) OVER o AS l0, SUM(a1) OVER o AS l1 FROM ({long}) WINDOW o AS (PARTITION BY node, f ORDER BY v)) WHERE next IS NOT NULL
  UNION ALL SELECT node, f, niveau, 0.5, n0 - a0, n1 - a1, n0, n1 FROM ({dummies}) WHERE n0 + n1 > a0 + a1)""")
        out.append(f"""best{d} AS MATERIALIZED (SELECT node, f, niveau, seuil, [{", ".join("'" + c + "'" for c in features)}][f + 1] AS variable FROM cut{d}, w
  QUALIFY ROW_NUMBER() OVER (PARTITION BY node ORDER BY {side("CAST(l0 AS BIGINT)", "CAST(l1 AS BIGINT)")} + {side("CAST(n0 - l0 AS BIGINT)", "CAST(n1 - l1 AS BIGINT)")} DESC,
    f, niveau NULLS FIRST, seuil) = 1)""")
        value = " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(numeric)) + " " + " ".join(
            f"WHEN {len(numeric) + i} THEN CAST(COALESCE({c} = b.niveau, FALSE) AS INTEGER)" for i, c in enumerate(classify.CATEGORICAL))
        out.append(f"""at{d + 1} AS MATERIALIZED (SELECT a.* REPLACE (CASE WHEN b.node IS NULL THEN a.node ELSE 2 * a.node + CAST((CASE b.f {value} END) > b.seuil AS INTEGER) END AS node)
  FROM at{d} a LEFT JOIN best{d} b ON a.node = b.node)""")
    levels = [row(d, "variable, niveau, seuil, variable IS NULL AS feuille") + f" FROM tot{d} LEFT JOIN best{d} USING (node), w" for d in range(classify.MAX_DEPTH)]
    levels.append(row(classify.MAX_DEPTH, "NULL, NULL, NULL, TRUE") + f" FROM tot{classify.MAX_DEPTH}, w")
    out.append("nodes AS MATERIALIZED (" + " UNION ALL ".join(levels) + ")")
    out.append(f"""predicted AS (SELECT commande_id, item_id, bonne_note, prediction FROM at{classify.MAX_DEPTH} JOIN nodes USING (node) WHERE is_test)""")
    return out


_TREE = _TRAIN + _tree_ctes()
sql_only("tree_nodes", O.with_star("""
SELECT CAST(node AS INTEGER) AS node, CAST(depth AS INTEGER) AS depth, variable, niveau, CAST(seuil AS DOUBLE) AS seuil, feuille, n0 AS n_0, n1 AS n_1,
  ROUND(poids, 6) AS poids, ROUND(gini, 9) AS gini, prediction FROM nodes""", _TREE))
sql_only("tree_predictions", O.with_star("SELECT * FROM predicted", _TREE))
sql_only("tree_importances", O.with_star(f"""
SELECT variable, ROUND(COALESCE(taken / total, 0), 4) AS importance FROM (
  SELECT unnest([{", ".join("'" + c + "'" for c in classify.NUMERIC)}]) AS variable
  {"".join(f"UNION ALL SELECT '{c}_' || niveau FROM (SELECT DISTINCT {c} AS niveau FROM training) WHERE niveau <> (SELECT MIN({c}) FROM training) " for c in classify.CATEGORICAL)}) names
LEFT JOIN (
  SELECT CASE WHEN niveau IS NULL THEN variable ELSE variable || '_' || niveau END AS variable, SUM(poids * gini - below) AS taken, SUM(SUM(poids * gini - below)) OVER () AS total
  FROM nodes JOIN (SELECT node // 2 AS node, SUM(poids * gini) AS below FROM nodes WHERE node > 1 GROUP BY node // 2) USING (node) WHERE NOT feuille GROUP BY 1) USING (variable)
ORDER BY importance DESC, variable LIMIT {classify.TOP_FEATURES}""", _TREE))


def _prediction_reports(prefix: str, ctes: list[str], predictions: str) -> None:
    """M17-M19 over (y, p) of the test part."""
    ctes = ctes + [f"rule AS MATERIALIZED ({predictions})", "per AS (" + " UNION ALL ".join(f"""
  SELECT '{classify.CLASS_NAMES[c]}' AS classe, COALESCE(CAST(SUM(CAST(y = {c} AND p = {c} AS INTEGER)) AS DOUBLE) / NULLIF(SUM(CAST(p = {c} AS INTEGER)), 0), 0) AS precision,
    COALESCE(CAST(SUM(CAST(y = {c} AND p = {c} AS INTEGER)) AS DOUBLE) / NULLIF(SUM(CAST(y = {c} AS INTEGER)), 0), 0) AS rappel,
    CAST(SUM(CAST(y = {c} AS INTEGER)) AS BIGINT) AS support FROM rule""" for c in (0, 1)) + ")",
                   """scored AS (SELECT *, CASE WHEN precision + rappel > 0 THEN 2 * precision * rappel / (precision + rappel) ELSE 0 END AS f1 FROM per)"""]
    sql_only(f"{prefix}_accuracy", O.with_star("SELECT AVG(CAST(y = p AS DOUBLE)) AS precision_globale FROM rule", ctes))
    sql_only(f"{prefix}_confusion", O.with_star("""
SELECT CAST(a AS INTEGER) AS bonne_note, CAST(b AS INTEGER) AS prediction, COUNT(y) AS nb
FROM (SELECT a, b FROM range(2) x(a), range(2) z(b)) g LEFT JOIN rule ON y = a AND p = b GROUP BY a, b""", ctes))
    sql_only(f"{prefix}_report", O.with_star("""
SELECT classe, precision, rappel, support, f1 FROM scored
UNION ALL SELECT 'accuracy', AVG(CAST(y = p AS DOUBLE)), AVG(CAST(y = p AS DOUBLE)), COUNT(*), AVG(CAST(y = p AS DOUBLE)) FROM rule
UNION ALL SELECT 'macro avg', AVG(precision), AVG(rappel), CAST(SUM(support) AS BIGINT), AVG(f1) FROM scored
UNION ALL SELECT 'weighted avg', SUM(precision * support) / SUM(support), SUM(rappel * support) / SUM(support), CAST(SUM(support) AS BIGINT),
  SUM(f1 * support) / SUM(support) FROM scored""", ctes))


_prediction_reports("rule", _TRAIN, f"SELECT bonne_note AS y, CAST(delai_livraison_jours <= {reports.RULE_DELAY} AS INTEGER) AS p FROM split WHERE is_test")
_prediction_reports("tree", _TREE, "SELECT bonne_note AS y, prediction AS p FROM predicted")


# ------------------------------------------------------------------ Q: the checks over inputs that break them
# Views of the given tables as star tables that violate each constraint: lineitem repeats (order, line); dimensions lack
# some keys or hold some twice; scores out of range and missing values come from the given columns.

def _broken(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    t = load_test_tables(spark, sf_dir, ("customer", "supplier", "part", "orders", "lineitem"))
    line, part, cust = t["lineitem"], t["part"], t["customer"]
    days = t["orders"].select(F.to_date("o_orderdate").alias("date_achat")).distinct()
    key = F.datediff("date_achat", F.lit("1990-01-01").cast("date"))
    score = F.col("l_linenumber") - 1
    client = cust.select(F.col("c_custkey").alias("client_id"), F.col("c_mktsegment").alias("ville"),
                         F.when(F.col("c_nationkey") != 3, F.col("c_nationkey").cast("string")).alias("etat"), F.lit("x").alias("region"))
    return {
        "DIM_TEMPS": days.select("date_achat", key.alias("temps_id"), (F.dayofmonth("date_achat") + 3).alias("jour"), (F.month("date_achat") - 1).alias("mois"),
                                 (F.quarter("date_achat") * 2).alias("trimestre"), F.year("date_achat").alias("annee"),
                                 F.lit("x").alias("nom_mois"), F.lit("x").alias("date_str")),
        "DIM_CLIENT": client.union(client.where("client_id % 9 = 0").withColumn("ville", F.lit("A"))),
        "DIM_PRODUIT": part.where("p_partkey % 6 <> 0").select(
            F.col("p_partkey").alias("produit_id"), F.when(F.col("p_size") > 5, F.col("p_brand")).alias("categorie"), F.lit(1.0).alias("poids_g")),
        "DIM_VENDEUR": t["supplier"].where("s_suppkey % 4 <> 0").select(
            F.col("s_suppkey").alias("vendeur_id"), F.col("s_name").alias("ville"), F.col("s_nationkey").cast("string").alias("etat")),
        "FAIT_VENTES": line.select(
            F.col("l_orderkey").alias("commande_id"), F.col("l_linenumber").cast("int").alias("item_id"), F.col("l_orderkey").alias("client_id"),
            F.when(F.col("l_quantity") > 2, F.col("l_partkey")).alias("produit_id"), F.col("l_suppkey").alias("vendeur_id"),
            F.datediff(F.to_date("l_shipdate"), F.lit("1990-01-01").cast("date")).alias("temps_id"),
            F.when(F.col("l_tax") > 0.01, F.col("l_extendedprice")).alias("prix_unitaire"),
            F.when(F.col("l_discount") > 0.02, F.col("l_extendedprice")).alias("frais_livraison"),
            F.col("l_extendedprice").alias("montant_total"), score.cast("double").alias("score_satisfaction"), F.lit(1.0).alias("delai_livraison_jours")),
    }


_BROKEN = ["""b_temps AS (SELECT date_achat, date_diff('day', DATE '1990-01-01', date_achat) AS temps_id, day(date_achat) + 3 AS jour,
    month(date_achat) - 1 AS mois, quarter(date_achat) * 2 AS trimestre, year(date_achat) AS annee, 'x' AS nom_mois, 'x' AS date_str
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date_achat FROM orders))""",
           """b_client0 AS (SELECT c_custkey AS client_id, c_mktsegment AS ville, CASE WHEN c_nationkey <> 3 THEN CAST(c_nationkey AS VARCHAR) END AS etat, 'x' AS region FROM customer)""",
           """b_client AS (SELECT * FROM b_client0 UNION ALL SELECT client_id, 'A', etat, region FROM b_client0 WHERE client_id % 9 = 0)""",
           """b_produit AS (SELECT p_partkey AS produit_id, CASE WHEN p_size > 5 THEN p_brand END AS categorie, CAST(1.0 AS DOUBLE) AS poids_g FROM part WHERE p_partkey % 6 <> 0)""",
           """b_vendeur AS (SELECT s_suppkey AS vendeur_id, s_name AS ville, CAST(s_nationkey AS VARCHAR) AS etat FROM supplier WHERE s_suppkey % 4 <> 0)""",
           """b_fait AS (SELECT l_orderkey AS commande_id, CAST(l_linenumber AS INTEGER) AS item_id, l_orderkey AS client_id,
    CASE WHEN l_quantity > 2 THEN l_partkey END AS produit_id, l_suppkey AS vendeur_id,
    date_diff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE)) AS temps_id, CASE WHEN l_tax > 0.01 THEN l_extendedprice END AS prix_unitaire,
    CASE WHEN l_discount > 0.02 THEN l_extendedprice END AS frais_livraison, l_extendedprice AS montant_total,
    CAST(l_linenumber - 1 AS DOUBLE) AS score_satisfaction, CAST(1.0 AS DOUBLE) AS delai_livraison_jours FROM lineitem)"""]
_BVIEW = {"DIM_TEMPS": "b_temps", "DIM_CLIENT": "b_client", "DIM_PRODUIT": "b_produit", "DIM_VENDEUR": "b_vendeur", "FAIT_VENTES": "b_fait"}


def _over_broken(name: str, sql: str) -> None:
    QUERIES[f"{name}_broken"] = lambda spark, sf, _n=name: REPORTS[_n](Tables(_broken(spark, sf)))
    ORACLE[f"{name}_broken"] = "WITH " + ",\n".join(_BROKEN) + "\n" + sql


_over_broken("dq_pk", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, 'pk_{'_'.join(k)}' AS check_name, COUNT(*) AS nb_violations FROM "
    f"(SELECT 1 FROM {_BVIEW[t]} GROUP BY {', '.join(k)} HAVING COUNT(*) > 1)" for t, k in PRIMARY_KEYS.items()))
_over_broken("dq_fk", " UNION ALL ".join(
    f"SELECT 'FAIT_VENTES' AS table_name, 'fk_{c}_{d}' AS check_name, COUNT(*) AS nb_violations FROM b_fait f "
    f"WHERE f.{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {_BVIEW[d]} d WHERE d.{k} = f.{c})" for c, d, k in FOREIGN_KEYS))
_over_broken("dq_ranges", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, 'range_{c}' AS check_name, COUNT(*) FILTER (WHERE {c} NOT BETWEEN {lo} AND {hi}) AS nb_violations FROM {_BVIEW[t]}"
    for t, c, lo, hi in RANGE_CHECKS))
_over_broken("dq_not_null", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, 'not_null_{c}' AS check_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS nb_violations FROM {_BVIEW[t]}"
    for t in PRIMARY_KEYS for c in not_null_columns(t)))
_over_broken("dq_defaults", "SELECT * REPLACE (COALESCE(prix_unitaire, 0) AS prix_unitaire, COALESCE(frais_livraison, 0) AS frais_livraison) FROM b_fait")
_over_broken("dq_defaults_produit", "SELECT * REPLACE (COALESCE(categorie, 'unknown') AS categorie) FROM b_produit")


@register("keep_first_broken", "WITH " + ",\n".join(_BROKEN) + """
SELECT client_id, ville, etat FROM b_client QUALIFY ROW_NUMBER() OVER (PARTITION BY client_id ORDER BY ville NULLS FIRST, etat NULLS FIRST) = 1""")
def q_keep_first(spark, sf):
    """B14 over clients of whom some are there twice."""
    return star.keep_first(_broken(spark, sf)["DIM_CLIENT"].drop("region"), "client_id", ["ville", "etat"]).select("client_id", "ville", "etat")
