"""Column expressions of the order records (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ordertide import schema as S
from ordertide.config import Limits


def order_total(products: Column) -> Column:
    """Sum of product prices starting at 0; null if any price is null."""
    return F.aggregate(products, F.lit(0).cast(S.MONEY),
                       lambda acc, p: (acc + p["price"]).cast(S.MONEY))


def product_count(products: Column) -> Column:
    """Number of products (null for a null list)."""
    return F.size(products)


def has_null_product(products: Column) -> Column:
    return F.coalesce(F.exists(products, lambda p: p.isNull()), F.lit(False))


def has_null_price(products: Column) -> Column:
    return F.coalesce(F.exists(products, lambda p: p.isNotNull() & p["price"].isNull()), F.lit(False))


def enrichment_error(value_null: Column, products_null: Column, count: Column,
                     null_product: Column, null_price: Column, limits: Limits) -> Column:
    """E1 + E2: the message of the first failing check, null when the order is fine.

    Checks run in the reference's evaluation order: the record itself, the
    product list, the injected fault on the list size, then the price fold.
    """
    err = F.when(value_null, F.lit(S.MSG_NULL_VALUE)).when(products_null, F.lit(S.MSG_NULL_PRODUCTS))
    if limits.fault_count is not None:
        err = err.when(count == F.lit(limits.fault_count), F.lit(S.MSG_DIV_ZERO))
    return err.when(null_product, F.lit(S.MSG_NULL_PRODUCT)).when(null_price, F.lit(S.MSG_NULL_PRICE))


def cart_route(count: Column, limits: Limits) -> Column:
    """B2: ordered split, first match wins."""
    return (F.when(count >= limits.full_cart, F.lit(S.ROUTE_FULL))
            .when(count >= limits.half_full_cart, F.lit(S.ROUTE_HALF))
            .otherwise(F.lit(S.ROUTE_MINI)))


def is_valuable(price: Column, limits: Limits) -> Column:
    """strictly above the threshold."""
    return price > F.lit(limits.valuable_threshold).cast(S.MONEY)


def is_even_count(count: Column) -> Column:
    """Even product count -> transactional path."""
    return (count % 2) == 0


def to_double(c: Column) -> Column:
    return c.cast("double")
