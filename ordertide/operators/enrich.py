"""Enrichment of orders.

The outcome of a row is carried in one nullable ``error`` column: null means
success. The split into success and error branches (B1) is two filters on the
same plan, see ``routing.split``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide import schema as S
from ordertide.config import Limits
from ordertide.functions import orders as fo

FULL_COLUMNS = ["id", "marketId", "customerId", "productCount", "price", "products", "status", "source"]
PARTIAL_COLUMNS = ["id", "productCount", "price", "products"]


def _passthrough(df: DataFrame, drop: set[str]) -> list[str]:
    return [c for c in df.columns if c not in drop]


def enrich(orders: DataFrame, limits: Limits) -> DataFrame:
    """P1 + E1 + E2: OrderEvent rows -> OrderFullEvent rows with an ``error`` column.

    Expects ``id, marketId, customerId, products``; an optional boolean
    ``value_null`` marks a tombstone (null record). Other columns (key, ts,
    seq, ...) pass through unchanged.
    """
    value_null = F.col("value_null") if "value_null" in orders.columns else F.lit(False)
    products = F.col("products")
    count = fo.product_count(products)
    error = fo.enrichment_error(
        value_null, products.isNull(), count,
        fo.has_null_product(products), fo.has_null_price(products), limits)
    keep = _passthrough(orders, {"id", "marketId", "customerId", "products", "value_null"})
    ok = error.isNull()
    return orders.select(
        *keep,
        "id", "marketId", "customerId",
        F.when(ok, count).cast("int").alias("productCount"),
        F.when(ok, fo.order_total(products)).alias("price"),
        products.alias("products"),
        F.when(ok, F.lit(S.NEW)).alias("status"),
        F.lit(None).cast("string").alias("source"),
        error.alias("error"),
    )


def enrich_plain(orders: DataFrame, limits: Limits) -> DataFrame:
    """The same enrichment without the injected fault (used by direct ingest)."""
    return enrich(orders, limits.with_(fault_count=None))


FLAG_COLUMNS = ("value_null", "products_null", "n_null_product")


def enrich_facts(facts: DataFrame, limits: Limits) -> DataFrame:
    """P1 on pre-aggregated order facts (n_products, total, n_null_price).

    Gives the same scalar columns as ``enrich`` without materialising the
    product arrays; used on large tables. Optional flags ``value_null``,
    ``products_null`` and ``n_null_product`` feed the same error rule.
    """
    def flag(c: str, test):
        return test(F.col(c)) if c in facts.columns else F.lit(False)

    count = F.col("n_products")
    error = fo.enrichment_error(flag("value_null", lambda c: c), flag("products_null", lambda c: c), count,
                                flag("n_null_product", lambda c: c > 0), F.col("n_null_price") > 0, limits)
    keep = _passthrough(facts, {"n_products", "total", "n_null_price", *FLAG_COLUMNS})
    ok = error.isNull()
    return facts.select(
        *keep,
        F.when(ok, count).cast("int").alias("productCount"),
        F.when(ok, F.col("total")).alias("price"),
        F.when(ok, F.lit(S.NEW)).alias("status"),
        F.lit(None).cast("string").alias("source"),
        error.alias("error"),
    )


def partial(full: DataFrame) -> DataFrame:
    """P5: OrderFullEvent -> OrderPartialEvent (drops market, customer, status, source)."""
    cols = [c for c in PARTIAL_COLUMNS if c in full.columns]
    extra = [c for c in ("key", "ts", "seq") if c in full.columns]
    return full.select(*extra, *cols)


def event_facts(records: DataFrame, event: str = "seq") -> DataFrame:
    """Decoded records -> one row of order facts per event.

    The records of one event share ``event``, its identity; two events of one order
    id stay apart. Each record is folded on its own array (size, price, null checks)
    and the records are combined with grouped sums, which Spark aggregates partially
    before the shuffle. An event of one record gives exactly what ``enrich`` does.
    """
    products = F.col("products")
    per_record = records.select(
        event, "id", "key", "ts", "marketId", "customerId", "value_null",
        products.isNull().alias("products_null"),
        F.coalesce(fo.product_count(products), F.lit(0)).alias("n"),
        F.aggregate(F.filter(products, lambda p: p.isNotNull() & p["price"].isNotNull()),
                    F.lit(0).cast(S.MONEY), lambda acc, p: (acc + p["price"]).cast(S.MONEY)).alias("t"),
        F.coalesce(F.size(F.filter(products, lambda p: p.isNull())), F.lit(0)).alias("np"),
        F.coalesce(F.size(F.filter(products, lambda p: p.isNotNull() & p["price"].isNull())),
                   F.lit(0)).alias("nq"),
    )
    return per_record.groupBy(event).agg(
        F.max("id").alias("id"), F.max("key").alias("key"), F.min("ts").alias("ts"),
        F.max("marketId").alias("marketId"), F.max("customerId").alias("customerId"),
        F.max(F.col("value_null").cast("int")).cast("boolean").alias("value_null"),
        F.max(F.col("products_null").cast("int")).cast("boolean").alias("products_null"),
        F.sum("n").cast("int").alias("n_products"),
        F.sum("t").cast(S.MONEY).alias("total"),
        F.sum("np").cast("int").alias("n_null_product"),
        F.sum("nq").cast("int").alias("n_null_price"),
    )
