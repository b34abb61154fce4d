"""Record schemas (explicit; JSON is never inferred) and fixed names."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

# Status and source names of the order events.
NEW, ACCEPT, REJECT, CONFIRMED, ROLLBACK = "NEW", "ACCEPT", "REJECT", "CONFIRMED", "ROLLBACK"
STATUSES = (NEW, ACCEPT, REJECT, CONFIRMED, ROLLBACK)
PAYMENT, STOCK = "PAYMENT", "STOCK"
SOURCES = (PAYMENT, STOCK)

# Topic names.
TOPIC_ORDERS = "orders"
TOPIC_ORDERS_FULL = "orders-full"
TOPIC_VALUABLE = "valuable-customer"
TOPIC_FULL_MINI = "full-mini-cart"
TOPIC_HALF_FULL = "half-full-cart"
TOPIC_PAYMENT = "payment-orders"
TOPIC_STOCK = "stock-orders"
TOPIC_ERROR = "error-topic"
TOPIC_TEST_1 = "topic-test-1"
TOPIC_TEST_2 = "topic-test-2"

# Route names of the cart-size split.
ROUTE_FULL = "full-cart"
ROUTE_HALF = "half-full-cart"
ROUTE_MINI = "mini-cart"

# Error texts kept verbatim from the reference.
MSG_DIV_ZERO = "/ by zero"
MSG_PRICE_HIGH = "Price is too high"
MSG_COUNT_HIGH = "Product Count is too high"
# Own stable texts for what the reference reports as null-pointer errors.
MSG_NULL_VALUE = "order is null"
MSG_NULL_PRODUCTS = "products is null"
MSG_NULL_PRODUCT = "product is null"
MSG_NULL_PRICE = "product price is null"
MSG_NULL_KEY = "null key"
MSG_NULL_STATUS = "null status"

PRODUCT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("price", MONEY),
])

ORDER_EVENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("marketId", T.StringType()),
    T.StructField("customerId", T.StringType()),
    T.StructField("products", T.ArrayType(PRODUCT)),
])

ORDER_FULL_EVENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("marketId", T.StringType()),
    T.StructField("customerId", T.StringType()),
    T.StructField("productCount", T.IntegerType()),
    T.StructField("price", MONEY),
    T.StructField("products", T.ArrayType(PRODUCT)),
    T.StructField("status", T.StringType()),
    T.StructField("source", T.StringType()),
])

ORDER_PARTIAL_EVENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("productCount", T.IntegerType()),
    T.StructField("price", MONEY),
    T.StructField("products", T.ArrayType(PRODUCT)),
])

ERROR = T.StructType([T.StructField("message", T.StringType())])

# Columns of a topic record (the columns of Spark's Kafka source).
ENVELOPE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

CORRUPT = "_corrupt_record"


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
