"""Data-quality operators on a warehouse with known violations (Q1-Q5)."""

from __future__ import annotations

import datetime as dt

from etoile.operators import quality

FACT = ("commande_id string, item_id int, client_id string, produit_id string, vendeur_id string, temps_id int, "
        "prix_unitaire double, frais_livraison double, montant_total double, score_satisfaction double, "
        "delai_livraison_jours double")


def _tables(spark):
    temps = spark.createDataFrame(
        [(dt.date(2018, 1, 1), 1, 1, 1, 1, 2018, "January", "2018-01-01"),
         (dt.date(2018, 1, 2), 1, 32, 13, 5, 2018, "January", "2018-01-02"),     # dup key, 3 range errors
         (None, 3, 3, 1, 1, 2018, "January", None)],                              # 2 nulls
        "date_achat date, temps_id int, jour int, mois int, trimestre int, annee int, nom_mois string, "
        "date_str string")
    clients = spark.createDataFrame([("c1", "x", "SP", "Sudeste"), ("c2", None, None, "Outro")],
                                    "client_id string, ville string, etat string, region string")
    produits = spark.createDataFrame([("p1", "a", 1.0), ("p2", None, None)],
                                     "produit_id string, categorie string, poids_g double")
    vendeurs = spark.createDataFrame([("s1", "x", "SP")], "vendeur_id string, ville string, etat string")
    fact = spark.createDataFrame([
        ("o1", 1, "c1", "p1", "s1", 1, 10.0, 1.0, 11.0, 4.0, 2.0),
        ("o1", 1, "c9", "p1", "s9", 1, None, None, 11.0, 6.0, 2.0),   # dup PK; 2 orphans; 2 nulls; score > 5
        ("o2", 1, None, "p3", "s1", 9, 5.0, 0.5, None, 0.0, None),    # null FK (not an orphan); 2 orphans
    ], FACT)
    return {"DIM_TEMPS": temps, "DIM_CLIENT": clients, "DIM_PRODUIT": produits, "DIM_VENDEUR": vendeurs,
            "FAIT_VENTES": fact}


def _as_dict(df):
    return {(r.table_name, r.check_name): r.nb_violations for r in df.collect()}


def test_q1_primary_keys(spark):
    got = _as_dict(quality.primary_key_duplicates(_tables(spark)))
    assert got == {("DIM_TEMPS", "pk_temps_id"): 1, ("DIM_CLIENT", "pk_client_id"): 0,
                   ("DIM_PRODUIT", "pk_produit_id"): 0, ("DIM_VENDEUR", "pk_vendeur_id"): 0,
                   ("FAIT_VENTES", "pk_commande_id_item_id"): 1}


def test_q2_foreign_keys_null_passes(spark):
    got = _as_dict(quality.foreign_key_orphans(_tables(spark)))
    assert got == {("FAIT_VENTES", "fk_client_id_DIM_CLIENT"): 1, ("FAIT_VENTES", "fk_produit_id_DIM_PRODUIT"): 1,
                   ("FAIT_VENTES", "fk_vendeur_id_DIM_VENDEUR"): 1, ("FAIT_VENTES", "fk_temps_id_DIM_TEMPS"): 1}


def test_q3_ranges_null_passes(spark):
    got = _as_dict(quality.range_violations(_tables(spark)))
    assert got == {("DIM_TEMPS", "range_jour"): 1, ("DIM_TEMPS", "range_mois"): 1,
                   ("DIM_TEMPS", "range_trimestre"): 1, ("FAIT_VENTES", "range_score_satisfaction"): 2}


def test_q4_not_null(spark):
    got = _as_dict(quality.null_violations(_tables(spark)))
    assert got[("DIM_TEMPS", "not_null_date_achat")] == 1 and got[("DIM_TEMPS", "not_null_date_str")] == 1
    assert got[("DIM_CLIENT", "not_null_etat")] == 1 and got[("DIM_CLIENT", "not_null_client_id")] == 0
    assert got[("DIM_PRODUIT", "not_null_categorie")] == 1
    assert got[("FAIT_VENTES", "not_null_client_id")] == 1
    assert got[("FAIT_VENTES", "not_null_prix_unitaire")] == 1 and got[("FAIT_VENTES", "not_null_frais_livraison")] == 1
    assert sum(got.values()) == 7


def test_q5_defaults_fill_only_declared_columns(spark):
    t = _tables(spark)
    f = quality.apply_defaults(t["FAIT_VENTES"], "FAIT_VENTES").filter("client_id = 'c9'").first()
    assert (f.prix_unitaire, f.frais_livraison) == (0.0, 0.0)
    p = {r.produit_id: r for r in quality.apply_defaults(t["DIM_PRODUIT"], "DIM_PRODUIT").collect()}
    assert p["p2"].categorie == "unknown" and p["p2"].poids_g is None
    assert quality.apply_defaults(t["FAIT_VENTES"], "FAIT_VENTES").filter("montant_total IS NULL").count() == 1


def test_q6_counts(spark):
    got = {r.table_name: r.nb for r in quality.table_counts(_tables(spark)).collect()}
    assert got == {"DIM_TEMPS": 3, "DIM_CLIENT": 2, "DIM_PRODUIT": 2, "DIM_VENDEUR": 1, "FAIT_VENTES": 3}
