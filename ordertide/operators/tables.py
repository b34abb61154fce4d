"""Orders as relational rows (S6) and the NOT NULL check on them.

One parent ``event`` row per written order and one ``product`` row per line.
The child keeps name and price, not the product id. Ids are deterministic
(derived from the write's identity) instead of a database serial, so a
replayed write produces the same ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.operators import commits

EVENT_NOT_NULL = ("market_id", "customer_id", "product_count", "price")
PRODUCT_NOT_NULL = ("name", "price", "event_id")


def event_id(*parts: Column) -> Column:
    return F.concat_ws(":", *[p.cast("string") for p in parts])


def event_rows(orders: DataFrame, write_id: Column) -> DataFrame:
    """Parent rows: event_id, market_id, customer_id, product_count, price."""
    return orders.select(
        write_id.alias("event_id"),
        F.col("marketId").alias("market_id"),
        F.col("customerId").alias("customer_id"),
        F.col("productCount").alias("product_count"),
        F.col("price"),
    )


def product_rows_from_array(orders: DataFrame, write_id: Column) -> DataFrame:
    """Child rows from an order's ``products`` array (topic-record path)."""
    return orders.select(write_id.alias("event_id"), F.explode("products").alias("p")).select(
        F.col("p.name").alias("name"), F.col("p.price").alias("price"), "event_id")


def product_rows_from_lines(events: DataFrame, lines: DataFrame) -> DataFrame:
    """Child rows by joining written events to their order lines (table path).

    ``events`` has ``event_id`` and ``orderkey``; ``lines`` has ``orderkey``,
    ``product_name`` and ``product_price``. A shuffle join on the order key;
    no per-order array is ever built.
    """
    return events.select("event_id", "orderkey").join(lines, "orderkey").select(
        F.col("product_name").alias("name"), F.col("product_price").alias("price"), "event_id")


# Order columns that become the NOT NULL columns of the event row.
ORDER_COLUMNS_OF_EVENT = ("marketId", "customerId", "productCount", "price")


def order_saves_ok() -> Column:
    """S7 evaluated on the order itself: would its event row pass NOT NULL?"""
    cond = F.lit(True)
    for c in ORDER_COLUMNS_OF_EVENT:
        cond = cond & F.col(c).isNotNull()
    return cond


def not_null_ok(df: DataFrame, columns=EVENT_NOT_NULL) -> Column:
    """True when none of the NOT NULL columns is null."""
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(c).isNotNull()
    return cond


def violations(df: DataFrame, columns=EVENT_NOT_NULL) -> Column:
    """The names of the violated NOT NULL columns, as an array."""
    return F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]),
                    lambda x: x.isNotNull())


def checked_events(events: DataFrame, products: DataFrame) -> DataFrame:
    """S7 on whole transactions: ``events`` with ``violations``, the null columns of the
    event and of any of its product rows. The products' part is a partial aggregate per
    event and column, so an event of any size costs a row a task."""
    broken = products.select("event_id", F.explode(violations(products, PRODUCT_NOT_NULL)).alias("column")).where("column != 'event_id'")
    broken = broken.groupBy("event_id").agg(F.array_sort(F.collect_set(F.concat(F.lit("product."), "column"))).alias("_products"))
    own = violations(events, EVENT_NOT_NULL)
    return (events.join(broken, "event_id", "left")
            .withColumn("violations", F.concat(own, F.coalesce("_products", F.array().cast("array<string>")))).drop("_products"))


def write_event_tables(events: DataFrame, products: DataFrame, root: str, batch_id: int) -> bool:
    """S6 sink: the rows of both tables of one batch, or none. Events of which a row of
    either table breaks S7 are left out with all their products. The batch becomes
    visible in both tables at once, by its commit; a batch that is there already stays as
    it is (False)."""
    spark = events.sparkSession

    def write(folder: str) -> None:
        checked_events(events, products).where(F.size("violations") == 0).drop("violations").write.parquet(f"{folder}/event")
        ok = spark.read.schema(EVENT_SCHEMA).parquet(f"{folder}/event").select("event_id")
        products.join(ok, "event_id", "left_semi").write.parquet(f"{folder}/product")
    return commits.write_once(spark, root, "event-tables", commits.number(batch_id), write)


EVENT_SCHEMA = "event_id string, market_id string, customer_id string, product_count int, price decimal(18,2)"
PRODUCT_SCHEMA = "name string, price decimal(18,2), event_id string"


def read_event_tables(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Events and products of the same committed batches."""
    done = [commits.data_folder(root, "event-tables", b, a) for b, a in commits.committed(spark, root, "event-tables").items()]
    return tuple(spark.read.schema(schema).parquet(*[f"{d}/{t}" for d in done]) if done else spark.createDataFrame([], schema)
                 for t, schema in (("event", EVENT_SCHEMA), ("product", PRODUCT_SCHEMA)))


def event_table_sink(root: str, write_id: Callable[[DataFrame], Column] = lambda df: F.col("id")):
    """foreachBatch function: valuable orders with their products arrays -> both tables."""
    def run(batch: DataFrame, batch_id: int) -> None:
        named = batch.withColumn("_write", write_id(batch))
        write_event_tables(event_rows(named, F.col("_write")), product_rows_from_array(named, F.col("_write")), root, batch_id)
    return run
