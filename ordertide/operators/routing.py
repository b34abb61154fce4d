"""Filters and branches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide import schema as S
from ordertide.config import Limits
from ordertide.functions import orders as fo
from ordertide.operators.enrich import partial


def split(outcomes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """B1: (success rows without ``error``, error rows). Disjoint and total."""
    ok = outcomes.filter(F.col("error").isNull()).drop("error")
    bad = outcomes.filter(F.col("error").isNotNull())
    return ok, bad


def valuable(success: DataFrame, limits: Limits) -> DataFrame:
    """price strictly above the threshold."""
    return success.filter(fo.is_valuable(F.col("price"), limits))


def with_route(success: DataFrame, limits: Limits) -> DataFrame:
    """B2: ``route`` column from the ordered cart-size split."""
    return success.withColumn("route", fo.cart_route(F.col("productCount"), limits))


def full_mini_cart(success: DataFrame, limits: Limits) -> DataFrame:
    """Full and mini carts merged, projected to the partial event."""
    routed = with_route(success, limits)
    return partial(routed.filter(F.col("route").isin(S.ROUTE_FULL, S.ROUTE_MINI)))


def half_full_cart(success: DataFrame, limits: Limits) -> DataFrame:
    """Half-full carts, unchanged."""
    routed = with_route(success, limits)
    return routed.filter(F.col("route") == S.ROUTE_HALF).drop("route")


def with_path(valuable_rows: DataFrame) -> DataFrame:
    """Even product count -> 'transactional', odd -> 'plain'."""
    return valuable_rows.withColumn(
        "path", F.when(fo.is_even_count(F.col("productCount")), F.lit("transactional"))
        .otherwise(F.lit("plain")))


def replies(reserved: DataFrame) -> DataFrame:
    """F2 + loop guard (Q1): successful ACCEPT/REJECT answers to NEW orders."""
    return reserved.filter(
        F.col("error").isNull()
        & F.col("status").isin(S.ACCEPT, S.REJECT)
        & (F.col("in_status") == S.NEW))


def topics_of(limits: Limits) -> Column:
    """The topics one success row is written to, as an array.

    Exploding this array fans a single pass over the success rows out to all
    sinks (one write partitioned by topic) instead of one scan per sink.
    """
    route = fo.cart_route(F.col("productCount"), limits)
    return F.filter(
        F.array(
            F.lit(S.TOPIC_ORDERS_FULL),
            F.when(fo.is_valuable(F.col("price"), limits), F.lit(S.TOPIC_VALUABLE)),
            F.when(route == S.ROUTE_HALF, F.lit(S.TOPIC_HALF_FULL)).otherwise(F.lit(S.TOPIC_FULL_MINI)),
        ),
        lambda t: t.isNotNull(),
    )
