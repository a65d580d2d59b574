"""CSV sources: file order as a column, first rows and date numbers by it, rejected records and cells."""

from __future__ import annotations

import pytest

from etoile.operators import star
from etoile.plans import jobs
from etoile.sources import csv


def write(folder, name, header, lines):
    (folder / name).write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")


@pytest.fixture
def small_blocks(spark):
    """Files in blocks of some hundred bytes, several blocks a task."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{k}")


def test_position_is_the_order_of_the_lines(spark, tmp_path, small_blocks):
    folder = tmp_path / "customers.csv"
    folder.mkdir()
    ids = [f"c{i * 7919 % 1000:04d}" for i in range(1000)]
    for part in range(4):
        write(folder, f"part-{part}.csv", "customer_id,customer_city,customer_state", [f"{c},town {i},SP" for i, c in enumerate(ids[part * 250:part * 250 + 250])])
    df = csv.read_csv_table(spark, str(folder), "customers", position=True)
    assert df.rdd.getNumPartitions() > 8
    assert [r.customer_id for r in df.repartition(5).orderBy(csv.POSITION).collect()] == ids


def test_first_line_of_a_key_and_first_appearance_of_a_date(spark, tmp_path, small_blocks):
    write(tmp_path, "customers.csv", "customer_id,customer_city,customer_state",
          [line for i in range(200) for line in (f"c{i % 50},zz {i},SP", f"c{i % 50},aa {i},RJ")] + [",nobody,SP", ",somebody,RJ"])
    days = [f"2018-{1 + i * 5 % 12:02d}-{1 + i * 11 % 28:02d}" for i in range(150)]
    write(tmp_path, "orders.csv", "order_id,customer_id,order_status,order_purchase_timestamp,order_delivered_customer_date,order_estimated_delivery_date",
          [f"o{i},c1,{'delivered' if i % 4 else 'shipped'},{d} 10:00:00,,{d}" for i, d in enumerate(days)])
    client = star.dim_client(csv.read_csv_table(spark, f"{tmp_path}/customers.csv", "customers", position=True))
    assert {(r.client_id, r.ville) for r in client.collect()} == {(f"c{i}", f"zz {i}") for i in range(50)} | {(None, "nobody")}
    assert client.columns == ["client_id", "ville", "etat", "region"]
    temps = star.dim_temps(star.delivered_orders(csv.read_csv_table(spark, f"{tmp_path}/orders.csv", "orders", position=True)))
    first = list(dict.fromkeys(d for i, d in enumerate(days) if i % 4))
    assert [r.date_str for r in temps.orderBy("temps_id").collect()] == first and [r.temps_id for r in temps.orderBy("temps_id").collect()] == list(range(1, len(first) + 1))


def test_products_go_by_their_line_then_by_the_translations(spark, tmp_path):
    write(tmp_path, "products.csv", "product_id,product_category_name,product_weight_g", ["p1,z,5", "p1,a,4", "p2,t,1", "p3,,2"])
    write(tmp_path, "translation.csv", "product_category_name,product_category_name_english", ["t,Zed", "t,Ada", "z,Last"])
    p, t = (csv.read_csv_table(spark, f"{tmp_path}/{n}.csv", n, position=True) for n in ("products", "translation"))
    assert sorted(map(tuple, star.dim_produit(p, t).collect())) == [("p1", "Last", 5.0), ("p2", "Zed", 1.0), ("p3", "unknown", 2.0)]


def test_rejected_records_and_cells(spark, tmp_path):
    write(tmp_path, "items.csv", "order_id,order_item_id,product_id,seller_id,price,freight_value,shipping_note",
          ["o1,1,p,s,10.5,1.0,ok", "o2,one,p,s,x,1.0,ok", "o3,1,p,s", "o4,1,p,s,1.0,2.0,ok,more", "o5,1,p,s,,,", 'o6,1,p,s,"3,5",1,"a ""b"", c"'])
    got = sorted((r.column_name or "", r.reason, r.value) for r in csv.rejected(spark, f"{tmp_path}/items.csv", "items").collect())
    assert got == [("", "fields", "o3,1,p,s"), ("", "fields", "o4,1,p,s,1.0,2.0,ok,more"), ("order_item_id", "cast", "one"), ("price", "cast", "3,5"), ("price", "cast", "x")]
    counts = {(r.table_name, r.column_name, r.reason): r.nb for r in csv.reject_counts(csv.rejected(spark, f"{tmp_path}/items.csv", "items")).collect()}
    assert counts == {("items", None, "fields"): 2, ("items", "order_item_id", "cast"): 1, ("items", "price", "cast"): 2}


def test_rejects_of_multi_line_reviews_and_of_an_empty_file(spark, tmp_path):
    write(tmp_path, "reviews.csv", "order_id,review_score,comment", ['o1,5,"two\nlines, one record"', "o2,five,x", "o3,4", 'o4,,"a\n\nb"'])
    got = sorted((r.column_name or "", r.value) for r in csv.rejected(spark, f"{tmp_path}/reviews.csv", "reviews").collect())
    assert got == [("", "o3,4"), ("review_score", "five")]
    write(tmp_path, "sellers.csv", "seller_id,seller_city,seller_state", [])
    assert csv.rejected(spark, f"{tmp_path}/sellers.csv", "sellers").count() == 0


def test_the_job_writes_the_rejects_of_all_sources(spark, tmp_path):
    data = {"orders": ("order_id,customer_id,order_status,order_purchase_timestamp,order_delivered_customer_date,order_estimated_delivery_date",
                       ["o1,c1,delivered,2018-01-02 10:00:00,2018-01-05 10:00:00,2018-02-01", "o2,c1,delivered,soon,,"]),
            "items": ("order_id,order_item_id,product_id,seller_id,price,freight_value", ["o1,1,p1,s1,10.0,1.0"]),
            "customers": ("customer_id,customer_city,customer_state", ["c1,b,SP", "c1,a,RJ"]), "products": ("product_id,product_category_name,product_weight_g", ["p1,t,heavy"]),
            "sellers": ("seller_id,seller_city,seller_state", ["s1,x,SP"]), "reviews": ("order_id,review_score", ["o1,4"]),
            "translation": ("product_category_name,product_category_name_english", ["t,T"]), "payments": ("order_id,payment_value", ["o1,11.0", "o1,much"])}
    for name, (header, lines) in data.items():
        write(tmp_path, f"{name}.csv", header, lines)
    jobs.run_etl(spark, csv.read_raw_csv(spark, str(tmp_path)), f"{tmp_path}/wh")
    rejects = csv.rejected_of_all(spark, str(tmp_path))
    assert sorted((r.table_name, r.column_name) for r in rejects.collect()) == [
        ("orders", "order_purchase_timestamp"), ("payments", "payment_value"), ("products", "product_weight_g")]
    star_tables = jobs.read_star(spark, f"{tmp_path}/wh")
    assert [tuple(r) for r in star_tables["DIM_CLIENT"].collect()] == [("c1", "b", "SP", "Sudeste")]
    assert star_tables["FAIT_VENTES"].count() == 1
