"""Jobs: CSV sources, ETL written to Parquet, reports over the written warehouse."""

from __future__ import annotations

import tempfile

from helpers import SF_SMALL

from etoile.plans import jobs
from etoile.plans.registry import QUERIES
from etoile.sources.csv import read_raw_csv
from etoile.sources.testdata import raw_from_testdata

CSV = {
    "orders": "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
              "order_delivered_customer_date,order_estimated_delivery_date\n"
              "o1,c1,delivered,2018-01-05 10:00:00,x,2018-01-07 10:00:00,2018-01-20 00:00:00\n"
              "o2,c1,delivered,garbage,x,2018-01-07 10:00:00,2018-01-20 00:00:00\n",
    "items": "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
             "o1,1,p1,s1,2018-01-06,10.5,1.25\n",
    "customers": "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
                 "c1,u1,1000,sao paulo,SP\n",
    "products": "product_id,product_category_name,product_weight_g\np1,beleza,300\n",
    "sellers": "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,1,campinas,SP\n",
    "reviews": 'review_id,order_id,review_score,review_comment_message\n'
               'r1,o1,4,"line one\nline two, with comma"\nr2,o1,5,""\n',
    "translation": "product_category_name,product_category_name_english\nbeleza,health_beauty\n",
    "payments": "order_id,payment_sequential,payment_type,payment_value\no1,1,credit_card,11.75\n",
}


def test_csv_sources_to_star(spark):
    d = tempfile.mkdtemp(prefix="etoile-csv-", dir="/tmp")
    for name, text in CSV.items():
        with open(f"{d}/{name}.csv", "w") as fh:
            fh.write(text)
    raw = read_raw_csv(spark, d)
    assert raw["reviews"].count() == 2          # the quoted newline stays inside one record
    wh = f"{d}/warehouse"
    jobs.run_etl(spark, raw, wh)
    frames = jobs.reports(spark, wh, ["fait_ventes", "dim_produit", "kpi1_ca_mensuel_region"])
    f = frames["fait_ventes"].collect()
    assert len(f) == 1 and f[0].score_satisfaction == 4.5 and f[0].montant_total == 11.75
    assert f[0].delai_livraison_jours == 2.0
    assert frames["dim_produit"].first().categorie == "health_beauty"
    k1 = frames["kpi1_ca_mensuel_region"].first()
    assert (k1.region, k1.ca_total, k1.nb_commandes) == ("Sudeste", 11.75, 1)


def test_warehouse_reports_equal_lazy_reports(spark):
    wh = tempfile.mkdtemp(prefix="etoile-wh-", dir="/tmp") + "/warehouse"
    jobs.run_etl(spark, raw_from_testdata(spark, SF_SMALL), wh)
    names = ["kpi1_ca_mensuel_region", "kpi6_ca_trimestriel", "dq_pk", "dq_fk", "dash_headline", "client_profile"]
    written = jobs.reports(spark, wh, names)
    for n in names:
        a = sorted(tuple(r) for r in written[n].collect())
        b = sorted(tuple(r) for r in QUERIES[n](spark, SF_SMALL).collect())
        assert a == b, n


def test_quality_is_clean_on_test_data(spark):
    for name in ("dq_pk", "dq_fk", "dq_ranges", "dq_not_null"):
        bad = [tuple(r) for r in QUERIES[name](spark, SF_SMALL).collect() if r.nb_violations]
        assert bad == [], name


def test_dashboard_frames_equal_single_reports(spark):
    wh = tempfile.mkdtemp(prefix="etoile-dash-", dir="/tmp") + "/warehouse"
    jobs.run_etl(spark, raw_from_testdata(spark, SF_SMALL), wh)
    frames = jobs.dashboard(spark, wh, "Sudeste")
    single = jobs.reports(spark, wh, ["dash_ca", "dash_headline", "dash_delai_region_sudeste", "dash_regions"])
    same = {"dash_ca": "dash_ca", "dash_headline": "dash_headline", "dash_delai_region": "dash_delai_region_sudeste",
            "dash_regions": "dash_regions"}
    for mine, ref in same.items():
        assert sorted(tuple(r) for r in frames[mine].collect()) == sorted(tuple(r) for r in single[ref].collect())
    plan = frames["dash_ca_region"]._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryTableScan" in plan          # the region filter reads the cached aggregate


def test_a_failed_load_leaves_the_tables_before_it(spark, monkeypatch):
    import pytest
    from etoile.sources.warehouse import read_star
    wh = tempfile.mkdtemp(prefix="etoile-wh-", dir="/tmp") + "/warehouse"
    raw = raw_from_testdata(spark, SF_SMALL)
    jobs.run_etl(spark, raw, wh)
    before = read_star(spark, wh)["FAIT_VENTES"].count()

    def broken(name, df):
        if name == "FAIT_VENTES":
            raise RuntimeError("lost")
        return df
    monkeypatch.setattr(jobs, "layout_for_write", broken)
    with pytest.raises(RuntimeError):
        jobs.run_etl(spark, {**raw, "orders": raw["orders"].limit(10)}, wh)
    tables = read_star(spark, wh)
    assert tables["FAIT_VENTES"].count() == before and tables["DIM_TEMPS"].count() > 10


def test_later_loads_replace_and_old_ones_go(spark):
    import os
    from etoile.sources.warehouse import KEEP_LOADS, read_star
    wh = tempfile.mkdtemp(prefix="etoile-wh-", dir="/tmp") + "/warehouse"
    raw = raw_from_testdata(spark, SF_SMALL)
    for n in (5, 6, 7):
        jobs.run_etl(spark, {**raw, "sellers": raw["sellers"].limit(n)}, wh)
    assert read_star(spark, wh)["DIM_VENDEUR"].count() == 7
    assert sum(x.startswith("load-") for x in os.listdir(wh)) == KEEP_LOADS


def test_submitted_settings_survive_and_a_cluster_needs_a_shared_folder():
    import os
    import subprocess
    import sys
    code = ("from etoile.session import build_session, checkpoint_root\n"
            "s = build_session()\n"
            "print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'))\n")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.sql.shuffle.partitions=64 --conf spark.ui.enabled=false pyspark-shell", "PYTHONPATH": root}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120)
    assert "GOT local[2] 64" in out.stdout, out.stderr[-2000:]


def test_materialize_on_a_cluster_without_a_shared_folder_is_an_error():
    import pytest
    from etoile import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Spark:
        conf, sparkContext = Conf(), Context()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Spark())


def test_timestamps_are_read_alike_in_any_time_zone(spark):
    from etoile.functions.dates import parse_timestamp
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("2018-03-25 02:30:00",), ("2018-11-04 00:15:00",), ("nothing",)], "t string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        got = [r.t for r in df.select(parse_timestamp(F.col("t")).cast("string").alias("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == ["2018-03-25 02:30:00", "2018-11-04 00:15:00", None]
