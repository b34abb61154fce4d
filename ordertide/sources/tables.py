"""The driver's parquet tables and the order events derived from them.

An order event is one row of ``orders`` with its ``lineitem`` rows as products
and the customer's nation as market. Two shapes are offered:

* ``order_facts``: scalars only (count, total, null-price count). The lines are
  pre-aggregated per order with a partial (map-side) aggregate, so even an
  order holding a huge share of all lines never becomes one array or one task.
  The analytic queries use this shape.
* ``order_events``: the reference's record shape with a ``products`` array,
  for small inputs (tests, direct ingest of a few orders).
* ``order_line_events``: the same events at a fixed grain, one product per
  record, so no record or group grows with an order's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.schema import MONEY

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: In the variant with gaps, parts whose key this divides have no price.
NO_PRICE_MOD = 97


#: In the variant with unnamed parts, those whose key this divides have no name.
NO_NAME_MOD = 89


def product_lines(spark: SparkSession, sf_dir: str, gaps: bool = False, unnamed: bool = False) -> DataFrame:
    """One row per line: order key and the product struct fields (exact money). With
    ``gaps`` the price is null for parts with a key divisible by NO_PRICE_MOD, with
    ``unnamed`` the name for those divisible by NO_NAME_MOD."""
    price = F.col("l_extendedprice").cast(MONEY)
    if gaps:
        price = F.when(F.col("l_partkey") % NO_PRICE_MOD != 0, price)
    name = F.concat(F.lit("part "), F.col("l_partkey").cast("string"))
    if unnamed:
        name = F.when(F.col("l_partkey") % NO_NAME_MOD != 0, name)
    return read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"),
        F.col("l_partkey").cast("string").alias("product_id"),
        name.alias("product_name"),
        price.alias("product_price"),
    )


def _order_heads(spark: SparkSession, sf_dir: str, with_market: bool = True) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    if not with_market:
        # Catalyst cannot drop an unused left join (it does not know the
        # customer key is unique), so callers that never read the market say so.
        return orders.select(
            F.col("o_orderkey").cast("string").alias("id"),
            F.col("o_orderkey").alias("seq"),
            F.col("o_orderkey").alias("orderkey"),
            F.col("o_custkey").cast("string").alias("customerId"),
            F.col("o_orderdate").alias("ts"),
        )
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # customer grows with the data: a plain equi-join, Catalyst broadcasts it
    # only while its statistics stay under autoBroadcastJoinThreshold.
    return orders.join(customer, orders.o_custkey == customer.c_custkey, "left").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_orderkey").alias("orderkey"),
        F.col("o_custkey").cast("string").alias("customerId"),
        F.col("c_nationkey").cast("string").alias("marketId"),
        F.col("o_orderdate").alias("ts"),
    )


def order_facts(spark: SparkSession, sf_dir: str, with_market: bool = True, gaps: bool = False) -> DataFrame:
    """id, seq, ts, customerId, marketId, n_products, total, n_null_price.

    ``total`` is the exact decimal(18,2) sum of the line prices (0 for an order
    without lines, like a fold from zero over an empty list). Without
    ``with_market`` the market column (and the customer join) is left out.
    """
    per_order = product_lines(spark, sf_dir, gaps).groupBy("orderkey").agg(
        F.count(F.lit(1)).cast("int").alias("n_products"),
        F.sum("product_price").cast(MONEY).alias("total"),
        (F.count(F.lit(1)) - F.count("product_price")).cast("int").alias("n_null_price"),
    )
    heads = _order_heads(spark, sf_dir, with_market)
    market = ["marketId"] if with_market else []
    return (
        heads
        .join(per_order, "orderkey", "left")
        .select(
            "id", "seq", "ts", "customerId", *market,
            F.coalesce("n_products", F.lit(0)).alias("n_products"),
            F.coalesce("total", F.lit(0).cast(MONEY)).alias("total"),
            F.coalesce("n_null_price", F.lit(0)).alias("n_null_price"),
        )
    )


def _product_struct() -> Column:
    return F.struct(
        F.col("product_id").alias("id"),
        F.col("product_name").alias("name"),
        F.col("product_price").alias("price"),
    )


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, seq, ts, customerId, marketId, products (array sorted by the whole struct)."""
    products = product_lines(spark, sf_dir).groupBy("orderkey").agg(
        F.array_sort(F.collect_list(_product_struct())).alias("products"))
    return (
        _order_heads(spark, sf_dir)
        .join(products, "orderkey", "left")
        .select(
            "id", "seq", "ts", "customerId", "marketId",
            F.coalesce("products", F.array().cast("array<struct<id:string,name:string,price:decimal(18,2)>>"))
            .alias("products"),
        )
    )


def order_line_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, seq, ts, customerId, marketId, products: the order's lines as records of one
    product each, and one record with an empty list for an order without lines. ``seq``
    names the event, so its records can be put together again however many there are."""
    product = F.when(F.col("product_id").isNotNull(), F.array(_product_struct()))
    empty = F.array().cast("array<struct<id:string,name:string,price:decimal(18,2)>>")
    return (_order_heads(spark, sf_dir).join(product_lines(spark, sf_dir), "orderkey", "left")
            .select("id", "seq", "ts", "customerId", "marketId", F.coalesce(product, empty).alias("products")))
