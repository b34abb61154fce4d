"""Enrichment stage as topic records: one explode fans every outcome out to
all the topics it belongs to (S5), so all sinks are fed by a single pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide import schema as S
from ordertide.config import Limits
from ordertide.operators import enrich as en
from ordertide.operators import routing as rt
from ordertide.sources import topics as tp


def route_records(outcomes: DataFrame, lim: Limits) -> DataFrame:
    """Enrichment outcomes (with ``key``, ``ts``, ``seq``, ``error``) -> topic records.

    orders-full and valuable-customer get the full event, full-mini-cart the
    partial event, half-full-cart the full event, error-topic the error.
    """
    topics = F.when(F.col("error").isNull(), rt.topics_of(lim)).otherwise(F.array(F.lit(S.TOPIC_ERROR)))
    x = outcomes.withColumn("_t", F.explode(topics))
    full = F.to_json(F.struct(*en.FULL_COLUMNS))
    part = F.to_json(F.struct(*en.PARTIAL_COLUMNS))
    err = F.to_json(F.struct(F.col("error").alias("message")))
    value = (F.when(F.col("_t") == S.TOPIC_ERROR, err)
             .when(F.col("_t") == S.TOPIC_FULL_MINI, part)
             .otherwise(full))
    return tp.envelope(x, F.col("_t"), value, key="key")


def reply_records(reserved: DataFrame, topic: str) -> tuple[DataFrame, DataFrame]:
    """Reservation outcomes -> (reply records keyed by order id, error records
    keyed by the reservation key)."""
    ok = rt.replies(reserved)
    value = F.to_json(F.struct(*en.FULL_COLUMNS))
    replies = tp.envelope(ok, topic, value, key="id")
    errs = reserved.filter(F.col("error").isNotNull())
    return replies, errs
