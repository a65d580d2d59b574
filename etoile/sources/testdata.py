"""Adapter: the driver's TPC-H-like parquet tables -> the eight raw source tables.

The mapping (documented in FIXTURES.md §3) gives every source column a deterministic
value derived from the given tables, so that every operator downstream reads data whose
volume grows with the scale factor. All of it is built-in expressions, aggregates and
order-keyed joins. Keys are renamed before anything is grouped or numbered by them, so that the item numbering's
exchange on ``order_id`` also serves the fact join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Fixed values of the test mapping: state code by nation key 0..24 (XX has no region).
STATE_BY_NATION = ["SP", "RJ", "MG", "ES", "RS", "SC", "PR", "BA", "PE", "CE", "MA", "PB", "RN",
                   "AL", "SE", "PI", "GO", "MT", "MS", "DF", "AM", "PA", "RO", "AC", "XX"]
# Fixed values of the test mapping: order status letter -> source status text.
STATUS_BY_LETTER = {"F": "delivered", "O": "shipped", "P": "processing"}
UNDELIVERED_EVERY = 50      # orders whose key is a multiple of this have no delivery date
UNREVIEWED_EVERY = 10       # orders whose key is a multiple of this have no review
SECOND_REVIEW_EVERY = 7     # ... and a multiple of this a second review
UNCATEGORISED_EVERY = 25    # parts whose key is a multiple of this have no category
TRANSLATED_BRANDS = 20      # brands numbered up to this have an English name
ESTIMATED_DAYS = 30         # promised delivery = purchase + this many days
# Item numbering order inside an order (line numbers repeat in the test data).
ITEM_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
              "l_shipdate", "l_discount", "l_tax"]


def load_test_tables(spark: SparkSession, sf_dir: str, names=TEST_TABLES) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names}


def _state(nation_key: Column) -> Column:
    return F.try_element_at(F.array(*[F.lit(s) for s in STATE_BY_NATION]), nation_key + F.lit(1))


def _status(letter: Column) -> Column:
    expr = None
    for k, v in STATUS_BY_LETTER.items():
        expr = (F.when(letter == k, F.lit(v)) if expr is None else expr.when(letter == k, F.lit(v)))
    return expr


def adapt_orders(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    last_ship = lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    o = orders.join(last_ship, orders.o_orderkey == last_ship.l_orderkey, "left")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        _status(F.col("o_orderstatus")).alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.when(F.col("o_orderkey") % UNDELIVERED_EVERY == 0, F.lit(None))
         .otherwise(F.col("last_ship")).alias("order_delivered_customer_date"),
        (F.col("o_orderdate") + F.make_interval(days=F.lit(ESTIMATED_DAYS)))
        .alias("order_estimated_delivery_date"),
    )


def adapt_items(lineitem: DataFrame) -> DataFrame:
    """Items with ``order_item_id`` = position inside the order (the test data repeats line numbers).

    A window partitioned by order: fine for orders of a few lines, as here; an order holding a
    large share of all lines would be one large (spilling) task. Real sources carry
    ``order_item_id`` and need no numbering.
    """
    w = Window.partitionBy("order_id").orderBy(*ITEM_ORDER)
    lineitem = lineitem.withColumnRenamed("l_orderkey", "order_id")
    freight = F.round(F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_tax").cast("decimal(4,2)"), 2)
    return lineitem.select(
        "order_id",
        F.row_number().over(w).alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_extendedprice").alias("price"),
        freight.cast("double").alias("freight_value"),
    )


def adapt_reviews(orders: DataFrame) -> DataFrame:
    reviewed = orders.filter(F.col("o_orderkey") % UNREVIEWED_EVERY != 0)
    digit = F.substring("o_orderpriority", 1, 1).cast("int")
    first = reviewed.select(F.col("o_orderkey").alias("order_id"), digit.alias("review_score"))
    second = (reviewed.filter(F.col("o_orderkey") % SECOND_REVIEW_EVERY == 0)
              .select(F.col("o_orderkey").alias("order_id"), (F.lit(1) + digit % 5).alias("review_score")))
    return first.unionByName(second)


def adapt_payments(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(F.col("l_orderkey").alias("order_id"), F.col("l_extendedprice").alias("payment_value"))


def adapt_products(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_partkey") % UNCATEGORISED_EVERY == 0, F.lit(None).cast("string"))
         .otherwise(F.col("p_brand")).alias("product_category_name"),
        (F.col("p_size") * 100).cast("double").alias("product_weight_g"),
    )


def adapt_translation(part: DataFrame) -> DataFrame:
    brand_no = F.substring_index(F.col("p_brand"), "#", -1).try_cast("int")
    return (part.select(F.col("p_brand")).distinct()
            .filter(brand_no <= TRANSLATED_BRANDS)
            .select(F.col("p_brand").alias("product_category_name"),
                    F.concat(F.lit("cat_"), brand_no.cast("string")).alias("product_category_name_english")))


def adapt_customers(customer: DataFrame) -> DataFrame:
    return customer.select(F.col("c_custkey").alias("customer_id"),
                           F.col("c_mktsegment").alias("customer_city"),
                           _state(F.col("c_nationkey")).alias("customer_state"))


def adapt_sellers(supplier: DataFrame) -> DataFrame:
    return supplier.select(F.col("s_suppkey").alias("seller_id"),
                           F.col("s_name").alias("seller_city"),
                           _state(F.col("s_nationkey")).alias("seller_state"))


def raw_from_testdata(spark: SparkSession, sf_dir: str, delivered_only: bool = False) -> dict[str, DataFrame]:
    """The eight sources. ``delivered_only``: orders without the others, for the star, which drops them anyway: the scan
    then filters on the status letter (the optimizer does not turn a filter on the mapped text into one)."""
    t = load_test_tables(spark, sf_dir, ("customer", "supplier", "part", "orders", "lineitem"))
    letter = next(k for k, v in STATUS_BY_LETTER.items() if v == "delivered")
    orders = t["orders"].filter(F.col("o_orderstatus") == letter) if delivered_only else t["orders"]
    return {
        "orders": adapt_orders(orders, t["lineitem"]),
        "items": adapt_items(t["lineitem"]),
        "customers": adapt_customers(t["customer"]),
        "products": adapt_products(t["part"]),
        "sellers": adapt_sellers(t["supplier"]),
        "reviews": adapt_reviews(t["orders"]),
        "translation": adapt_translation(t["part"]),
        "payments": adapt_payments(t["lineitem"]),
    }
