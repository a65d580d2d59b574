"""Every report as a function of the warehouse tables: ``fn(tables) -> DataFrame``.

``tables`` maps ``DIM_TEMPS, DIM_CLIENT, DIM_PRODUIT, DIM_VENDEUR, FAIT_VENTES`` to frames:
either the lazily built star (``star.build_star``) or the tables read back from the
warehouse (``sources.warehouse.read_star``). The job runner, the bench and the driver's
registry all go through this one table of reports.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etoile.operators import classify, dashboard, forecast, kmeans, kpis, quality, segments
from etoile.session import materialize
from etoile.sources.warehouse import run_sql


class Tables(dict[str, DataFrame]):
    """Warehouse tables, and what reports over the same tables share: stored features, fits, predictions."""

    def __init__(self, tables: dict[str, DataFrame]):
        super().__init__(tables)
        self.shared: dict[str, object] = {}

    def once(self, name: str, make: Callable[[], object]):
        if name not in self.shared:
            self.shared[name] = make()
        return self.shared[name]


REPORTS: dict[str, Callable[[Tables], DataFrame]] = {}

# Reports that fit models (rows-only checks; minutes, not seconds, at scale).
MINING = ("elbow_curve", "client_segments", "segment_summary", "segment_sizes", "segment_sample", "tree_nodes", "tree_predictions",
          "tree_accuracy", "tree_report", "tree_confusion", "tree_importances")


def report(name: str):
    def deco(fn):
        REPORTS[name] = fn
        return fn
    return deco


def _f(t: Tables) -> DataFrame:
    return t["FAIT_VENTES"]


def _orders(t: Tables) -> DataFrame:
    """The order roll-up where the warehouse has it, else the fact: for reports that do not look at items."""
    return t.get("FAIT_COMMANDES", _f(t))


# star tables themselves
for _n, _t in (("dim_temps", "DIM_TEMPS"), ("dim_client", "DIM_CLIENT"), ("dim_produit", "DIM_PRODUIT"),
               ("dim_vendeur", "DIM_VENDEUR"), ("fait_ventes", "FAIT_VENTES")):
    REPORTS[_n] = lambda t, _t=_t: t[_t]

# K: KPI queries
REPORTS["kpi1_ca_mensuel_region"] = lambda t: kpis.kpi1_ca_mensuel_region(_orders(t), t["DIM_TEMPS"], t["DIM_CLIENT"])
REPORTS["kpi2_ca_mensuel_categorie"] = lambda t: kpis.kpi2_ca_mensuel_categorie(_f(t), t["DIM_TEMPS"],
                                                                                t["DIM_PRODUIT"])
REPORTS["kpi3_top_vendeurs"] = lambda t: kpis.kpi3_top_vendeurs(_f(t), t["DIM_VENDEUR"])
REPORTS["kpi4_delai_etat"] = lambda t: kpis.kpi4_delai_etat(_f(t), t["DIM_CLIENT"])
REPORTS["kpi5_top_categories_satisfaction"] = lambda t: kpis.kpi5_top_categories_satisfaction(_f(t),
                                                                                              t["DIM_PRODUIT"])
REPORTS["kpi6_ca_trimestriel"] = lambda t: kpis.kpi6_ca_trimestriel(_orders(t), t["DIM_TEMPS"])

# Q: data quality
REPORTS["dq_pk"] = quality.primary_key_duplicates
REPORTS["dq_fk"] = quality.foreign_key_orphans
REPORTS["dq_ranges"] = quality.range_violations
REPORTS["dq_not_null"] = quality.null_violations
REPORTS["dq_defaults"] = lambda t: quality.apply_defaults(_f(t), "FAIT_VENTES")
REPORTS["dq_defaults_produit"] = lambda t: quality.apply_defaults(t["DIM_PRODUIT"], "DIM_PRODUIT")
REPORTS["table_counts"] = quality.table_counts


# D: dashboard data
def _monthly(t: Tables) -> DataFrame:
    return dashboard.monthly_revenue(_orders(t), t["DIM_TEMPS"], t["DIM_CLIENT"])


def _delays(t: Tables) -> DataFrame:
    return dashboard.delay_by_state(_f(t), t["DIM_CLIENT"])


def _top_categories(t: Tables) -> DataFrame:
    return dashboard.top_categories(_f(t), t["DIM_PRODUIT"])


REPORTS["dash_ca"] = _monthly
REPORTS["dash_top_categories"] = _top_categories
REPORTS["dash_categories_chart"] = lambda t: dashboard.categories_chart(_top_categories(t))
REPORTS["dash_delai"] = _delays
REPORTS["dash_scores"] = lambda t: dashboard.score_distribution(_f(t))
REPORTS["dash_trend"] = lambda t: dashboard.quarterly_trend(_orders(t), t["DIM_TEMPS"])
REPORTS["dash_headline"] = lambda t: dashboard.headline(_monthly(t), dashboard.global_sums(_f(t)))
REPORTS["dash_regions"] = lambda t: dashboard.region_choices(_monthly(t))
REPORTS["dash_ca_region"] = lambda t: dashboard.monthly_revenue_for(_monthly(t))
REPORTS["dash_ca_region_nordeste"] = lambda t: dashboard.monthly_revenue_for(_monthly(t), "Nordeste")
REPORTS["dash_delai_region"] = lambda t: dashboard.slowest_states_for(_delays(t))
REPORTS["dash_delai_region_sudeste"] = lambda t: dashboard.slowest_states_for(_delays(t), "Sudeste")

# forecast
REPORTS["trend_index"] = lambda t: forecast.trend_index(_orders(t), t["DIM_TEMPS"])
REPORTS["forecast_model"] = lambda t: forecast.forecast_model(_orders(t), t["DIM_TEMPS"])
REPORTS["forecast_series"] = lambda t: forecast.forecast_series(_orders(t), t["DIM_TEMPS"])

# segments
REPORTS["client_profile"] = lambda t: segments.client_profile(_orders(t))
REPORTS["client_sample"] = lambda t: segments.client_sample(segments.client_profile(_orders(t)))


def _z(t: Tables) -> DataFrame:
    return t.once("z", lambda: segments.client_zscores(_orders(t)))


REPORTS["client_zscores"] = lambda t: _z(t).select(
    "client_id", *segments.FEATURES, *[F.round(c, 9).alias(c) for c in segments.Z_FEATURES])
REPORTS["elbow_curve"] = lambda t: segments.elbow_curve(_z(t))


def _segments(t: Tables) -> DataFrame:
    return t.once("segments", lambda: materialize(segments.segment(_z(t))[0], "segments"))


REPORTS["client_segments"] = _segments
REPORTS["segment_summary"] = lambda t: segments.segment_summary(_segments(t))
REPORTS["segment_sizes"] = lambda t: segments.segment_sizes(_segments(t))
REPORTS["segment_sample"] = lambda t: segments.segment_sample(segments.client_profile(_orders(t)), _segments(t))

# the same steps from stated centers: what a fit leaves to be done, without the draw
CENTERS = [[-0.5, -0.5, -0.5], [0.0, 0.75, 0.25], [1.0, -0.25, 0.5], [1.5, 0.5, 2.0]]
LLOYD_STEPS = 3


def _given(t: Tables) -> DataFrame:
    return t.once("given", lambda: segments.label_segments(_z(t), CENTERS))


REPORTS["segments_given"] = lambda t: _given(t).select("client_id", "segment", "segment_label")
REPORTS["segment_summary_given"] = lambda t: segments.segment_summary(_given(t))
REPORTS["segment_sizes_given"] = lambda t: segments.segment_sizes(_given(t))
REPORTS["segment_sample_given"] = lambda t: segments.segment_sample(segments.client_profile(_orders(t)), _given(t))
REPORTS["inertia_given"] = lambda t: segments.inertia(_z(t), CENTERS).select(F.round("inertie", 6).alias("inertie"))


@report("lloyd_given")
def _lloyd(t: Tables) -> DataFrame:
    centers = kmeans.lloyd(_z(t), segments.Z_FEATURES, CENTERS, LLOYD_STEPS)
    rows = [(i, *map(float, c)) for i, c in enumerate(centers)]
    df = _f(t).sparkSession.createDataFrame(rows, "segment int, " + ", ".join(f"{c} double" for c in segments.Z_FEATURES))
    return df.select("segment", *[F.round(c, 6).alias(c) for c in segments.Z_FEATURES])


# classifier
def _training(t: Tables) -> DataFrame:
    return classify.training_set(_f(t), t["DIM_PRODUIT"], t["DIM_CLIENT"])


def _split(t: Tables) -> DataFrame:
    return t.once("split", lambda: classify.stratified_split(_training(t)))


def _tree(t: Tables):
    """(tree, stored predictions): one fit for all reports of a job."""
    def fit():
        nodes, pred = classify.fit_tree(_split(t))
        return nodes, materialize(pred, "predictions")
    return t.once("tree", fit)


RULE_DELAY = 30.0


def _rule(t: Tables) -> DataFrame:
    return classify.rule_predictions(_split(t), RULE_DELAY)


REPORTS["order_training_set"] = _training
REPORTS["onehot_levels"] = lambda t: classify.onehot_levels(_training(t))
REPORTS["stratified_split"] = _split
REPORTS["class_weights"] = lambda t: classify.class_weights(_split(t).filter(~F.col("is_test")))
REPORTS["tree_nodes"] = lambda t: _tree(t)[0].withColumn("poids", F.round("poids", 6)).withColumn("gini", F.round("gini", 9))
REPORTS["tree_predictions"] = lambda t: _tree(t)[1]
REPORTS["tree_accuracy"] = lambda t: classify.accuracy(_tree(t)[1])
REPORTS["tree_report"] = lambda t: classify.report(_tree(t)[1])
REPORTS["tree_confusion"] = lambda t: classify.confusion(_tree(t)[1])


REPORTS["rule_accuracy"] = lambda t: classify.accuracy(_rule(t))
REPORTS["rule_report"] = lambda t: classify.report(_rule(t))
REPORTS["rule_confusion"] = lambda t: classify.confusion(_rule(t))


@report("tree_importances")
def _importances(t: Tables) -> DataFrame:
    return classify.importances(_tree(t)[0], _split(t))


# A10: reports written as SQL text, run by ``spark.sql`` over the warehouse tables as temp views
# (the source runs its KPI file this way). Same rounding rule as the DataFrame operators.
SQL_REPORTS = {
    "sql_ca_trimestriel": """
SELECT t.annee, t.trimestre, CONCAT(CAST(t.annee AS STRING), '-T', CAST(t.trimestre AS STRING)) AS periode,
       CAST(ROUND(SUM(CAST(f.prix_unitaire AS DECIMAL(18,4)) + CAST(f.frais_livraison AS DECIMAL(18,4))), 2)
            AS DOUBLE) AS ca_total,
       COUNT(DISTINCT f.commande_id) AS nb_commandes
FROM FAIT_VENTES f JOIN DIM_TEMPS t ON f.temps_id = t.temps_id
GROUP BY t.annee, t.trimestre
ORDER BY t.annee, t.trimestre""",
    "sql_top_vendeurs": """
SELECT v.vendeur_id, v.etat,
       SIGN(s) * FLOOR(ABS(s) / n * 100D + 0.5D) / 100D AS score_moyen,
       nb_commandes, ca_total
FROM (SELECT f.vendeur_id, CAST(SUM(CAST(f.score_satisfaction AS DECIMAL(28,12))) AS DOUBLE) AS s,
             COUNT(f.score_satisfaction) AS n, COUNT(DISTINCT f.commande_id) AS nb_commandes,
             CAST(ROUND(SUM(CAST(f.prix_unitaire AS DECIMAL(18,4))), 2) AS DOUBLE) AS ca_total
      FROM FAIT_VENTES f WHERE f.score_satisfaction IS NOT NULL GROUP BY f.vendeur_id) a
JOIN DIM_VENDEUR v ON a.vendeur_id = v.vendeur_id
ORDER BY score_moyen DESC, v.vendeur_id ASC
LIMIT 20""",
}


def _sql_report(sql: str) -> Callable[[Tables], DataFrame]:
    def run(t: Tables) -> DataFrame:
        return run_sql(_f(t).sparkSession, sql, t)
    return run


for _n, _sql in SQL_REPORTS.items():
    REPORTS[_n] = _sql_report(_sql)
