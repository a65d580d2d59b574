"""Dashboard, forecast, segmentation and classifier semantics on hand fixtures."""

from __future__ import annotations

import math

from helpers import SF_SMALL, collect_sorted
from pyspark.sql import functions as F

from etoile.operators import classify, dashboard, forecast, segments
from etoile.plans.registry import star_tables


def _dims_for_quarters(spark, quarters):
    """Fact rows of revenue ``v`` in each (year, quarter) listed, one order each."""
    temps = spark.createDataFrame([(i + 1, y, q, (q - 1) * 3 + 1) for i, (y, q, _v) in enumerate(quarters)],
                                  "temps_id int, annee int, trimestre int, mois int")
    fact = spark.createDataFrame([(f"o{i}", 1, "c1", "p1", "s1", i + 1, float(v), 0.0, None, None, None)
                                  for i, (_y, _q, v) in enumerate(quarters)],
                                 "commande_id string, item_id int, client_id string, produit_id string, "
                                 "vendeur_id string, temps_id int, prix_unitaire double, frais_livraison double, "
                                 "montant_total double, score_satisfaction double, delai_livraison_jours double")
    return fact, temps


def test_t20_t21_forecast_index_collapses_gaps_and_labels_follow_data(spark):
    fact, temps = _dims_for_quarters(spark, [(2017, 3, 10.0), (2017, 4, 20.0), (2018, 2, 40.0)])
    idx = collect_sorted(forecast.trend_index(fact, temps).select("t", "periode"), "t")
    assert idx == [(0, "2017-T3"), (1, "2017-T4"), (2, "2018-T2")]
    m = forecast.forecast_model(fact, temps).first()
    assert math.isclose(m.pente, 15.0) and math.isclose(m.ordonnee, 25.0 / 3.0)
    s = collect_sorted(forecast.forecast_series(fact, temps).select("t", "periode", "type", "ca_prevu"), "t")
    assert [r[1] for r in s] == ["2017-T3", "2017-T4", "2018-T2", "2018-T3", "2018-T4"]
    assert [r[2] for r in s][-2:] == ["prevision", "prevision"]
    assert math.isclose(s[3][3], m.ordonnee + 3 * m.pente)


def test_forecast_year_rollover(spark):
    fact, temps = _dims_for_quarters(spark, [(2018, 3, 1.0), (2018, 4, 2.0)])
    s = forecast.forecast_series(fact, temps).filter(F.col("type") == "prevision").orderBy("t").collect()
    assert [r.periode for r in s] == ["2019-T1", "2019-T2"]


def test_r2_of_a_perfect_line_is_one(spark):
    fact, temps = _dims_for_quarters(spark, [(2018, 1, 1.0), (2018, 2, 3.0), (2018, 3, 5.0)])
    m = forecast.forecast_model(fact, temps).first()
    assert m.r2 == 1.0 and m.pente == 2.0 and m.ordonnee == 1.0 and m.n == 3


def test_t17_headline_equals_global_distinct_orders(spark):
    s = star_tables(spark, SF_SMALL)
    monthly = dashboard.monthly_revenue(s["FAIT_VENTES"], s["DIM_TEMPS"], s["DIM_CLIENT"])
    h = dashboard.headline(monthly, dashboard.global_sums(s["FAIT_VENTES"])).first()
    joined = s["FAIT_VENTES"].join(s["DIM_CLIENT"].select("client_id"), "client_id")
    assert h.nb_commandes == joined.select("commande_id").distinct().count()


def test_t18_t19_region_filter_and_chart_order(spark):
    delays = spark.createDataFrame([(f"E{i:02d}", "Norte" if i % 2 else "Sul", float(i), 1) for i in range(30)],
                                   "etat string, region string, delai_moyen double, nb_commandes long")
    allr = dashboard.slowest_states_for(delays).collect()
    assert len(allr) == 20
    assert [r.delai_moyen for r in allr] == sorted(r.delai_moyen for r in allr)   # ascending for the chart
    assert min(r.delai_moyen for r in allr) == 10.0                                # the 20 slowest
    norte = dashboard.slowest_states_for(delays, "Norte").collect()
    assert {r.region for r in norte} == {"Norte"} and len(norte) == 15
    choices = [r.region for r in dashboard.region_choices(
        spark.createDataFrame([("Sul",), ("Norte",), ("Sul",)], "region string")).collect()]
    assert choices == ["Toutes", "Norte", "Sul"]


def test_m3_zscores_population_std_and_constant_feature(spark):
    f = spark.createDataFrame([("a", 1.0, 1.0, 2.0), ("b", 1.0, 3.0, 4.0)],
                              "client_id string, freq_achat double, montant_moyen double, ca_total double")
    z = {r.client_id: r for r in segments.zscores(f).collect()}
    assert z["a"].z_freq_achat == 0.0                         # zero variance -> 0
    assert z["a"].z_montant_moyen == -1.0 and z["b"].z_ca_total == 1.0   # population std


def test_t23_segment_labels_follow_mean_revenue(spark):
    s = star_tables(spark, SF_SMALL)
    segs, best = segments.segment(segments.client_zscores(s["FAIT_VENTES"]), n_init=2)
    means = {r.segment_label: r.m for r in segs.groupBy("segment_label").agg(F.avg("ca_total").alias("m")).collect()}
    ordered = [means[label] for label in segments.SEGMENT_LABELS]
    assert ordered == sorted(ordered)
    assert best.centers.shape == (segments.K, 3) and best.cost > 0


def test_elbow_curve_shape(spark):
    s = star_tables(spark, SF_SMALL)
    e = segments.elbow_curve(segments.client_zscores(s["FAIT_VENTES"]), k_range=range(2, 5), n_init=2).collect()
    assert [r.k for r in e] == [2, 3, 4]
    assert all(r.inertie > 0 for r in e)
    assert e[-1].inertie <= e[0].inertie * 1.05


def test_m14_split_sizes_are_exact_per_class(spark):
    rows = [(f"o{i}", 1, i % 3 == 0) for i in range(1000)]
    df = spark.createDataFrame(rows, "commande_id string, item_id int, bonne_note boolean").withColumn(
        "bonne_note", F.col("bonne_note").cast("int"))
    split = classify.stratified_split(df)
    got = {(r.bonne_note, r.is_test): r.n for r in split.groupBy("bonne_note", "is_test")
           .agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = 334, 666
    assert got[(1, True)] == math.ceil(0.25 * n1) and got[(0, True)] == math.ceil(0.25 * n0)
    assert got[(1, False)] + got[(1, True)] == n1
    again = {r.commande_id for r in classify.stratified_split(df).filter("is_test").collect()}
    assert again == {r.commande_id for r in split.filter("is_test").collect()}   # seeded, repeatable


def test_tree_reports_invariants(spark):
    s = star_tables(spark, SF_SMALL)
    split = classify.stratified_split(classify.training_set(s["FAIT_VENTES"], s["DIM_PRODUIT"], s["DIM_CLIENT"]))
    nodes, pred = classify.fit_tree(split)
    assert max(r.depth for r in nodes.collect()) <= 5
    n_test = split.filter("is_test").count()
    conf = classify.confusion(pred).collect()
    assert len(conf) == 4 and sum(r.nb for r in conf) == n_test
    rep = {r.classe: r for r in classify.report(pred).collect()}
    assert rep["macro avg"].support == rep["accuracy"].support == n_test
    assert set(classify.CLASS_NAMES.values()) < set(rep)
    acc = classify.accuracy(pred).first().precision_globale
    assert math.isclose(rep["accuracy"].f1, acc)
    assert math.isclose(acc, sum(r.nb for r in conf if r.bonne_note == r.prediction) / n_test)
    imp = classify.importances(nodes, split).collect()
    assert len(imp) <= 10 and sum(r.importance for r in imp) <= 1.0001
    w = {r.bonne_note: r for r in classify.class_weights(split.filter(~F.col("is_test"))).collect()}
    assert math.isclose(sum(r.nb * r.poids for r in w.values()), sum(r.nb for r in w.values()))


def test_distributed_kmeans_equals_brute_force_lloyd(spark):
    import numpy as np

    from etoile.operators import kmeans
    rng = np.random.default_rng(0)
    pts = np.vstack([rng.normal(c, 0.3, size=(40, 2)) for c in ((0, 0), (5, 5), (0, 6))])
    df = spark.createDataFrame([(f"c{i}", float(x), float(y)) for i, (x, y) in enumerate(pts)],
                               "client_id string, a double, b double").repartition(3)
    fits = kmeans.fit_many(df, ["a", "b"], [(3, 7), (3, 8), (2, 7)], max_iter=100, tol=1e-8)
    assert kmeans._groups([(0, 3), (3, 3), (6, 2)]) == [(0, 3, 2), (6, 2, 1)]
    # brute force: same seeds drawn over all points, plain Lloyd
    seeds = [kmeans.KMeansFit(f.k, f.seed, np.zeros((0, 2))) for f in fits]
    kmeans.seed_centers(df.selectExpr("xxhash64(client_id) as _h", "a", "b"), ["a", "b"], seeds)
    for f, start in zip(fits, seeds):
        c = start.centers
        for _ in range(100):
            lab = ((pts[:, None, :] - c[None]) ** 2).sum(2).argmin(1)
            new = np.array([pts[lab == j].mean(0) if (lab == j).any() else c[j] for j in range(f.k)])
            done = ((new - c) ** 2).sum() <= 1e-8 * pts.var(0).mean()
            c = new
            if done:
                break
        cost = ((pts - c[((pts[:, None, :] - c[None]) ** 2).sum(2).argmin(1)]) ** 2).sum()
        assert np.allclose(np.sort(f.centers, 0), np.sort(c, 0))
        assert math.isclose(f.cost, cost, rel_tol=1e-9)
    best3 = kmeans.best_per_k(fits)[3]
    got = kmeans.assign(df, ["a", "b"], best3.centers).groupBy("segment").count().collect()
    assert sorted(r["count"] for r in got) == [40, 40, 40]


def test_m14_split_does_not_depend_on_bucket_resolution(spark):
    rows = [(f"o{i}", i % 4, int(i % 5 == 0)) for i in range(3000)]
    df = spark.createDataFrame(rows, "commande_id string, item_id int, bonne_note int")
    sets = [{(r.commande_id, r.item_id) for r in classify.stratified_split(df, edge_rows=e).filter("is_test").collect()}
            for e in (100_000, 30, 3)]
    assert sets[0] == sets[1] == sets[2]
    assert len(sets[0]) == math.ceil(0.25 * 600) + math.ceil(0.25 * 2400)


def test_importance_names_match_dummy_columns(spark):
    s = star_tables(spark, SF_SMALL)
    split = classify.stratified_split(classify.training_set(s["FAIT_VENTES"], s["DIM_PRODUIT"], s["DIM_CLIENT"]))
    names = [r.variable for r in classify.feature_names(split).collect()]
    dummies = {r.colonne for r in classify.onehot_levels(split).collect()}
    assert names[:3] == classify.NUMERIC
    assert set(names[3:]) == dummies
