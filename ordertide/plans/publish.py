"""The whole order flow as one batch job over the tables, outputs written.

Writes, under ``out_root``: enriched orders with their routes, the error
topic, both reservation logs, the decisions, and the settled balances of
customers and markets, as parquet tables. Each stage is read from the previous
one's written table (lineage cut at every hand-off, like the topics between
the services), so a lost executor only recomputes the current stage.

Usage: python -m ordertide.plans.publish <sf_dir> <out_root>
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.config import Limits, TABLE_LIMITS
from ordertide.functions.orders import cart_route, is_valuable
from ordertide.operators import errors as er
from ordertide.operators import reservation as rv
from ordertide.operators import routing as rt
from ordertide.plans import saga
from ordertide.plans.queries import enriched


def _write(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def run_batch(spark: SparkSession, sf_dir: str, out_root: str, lim: Limits = TABLE_LIMITS) -> dict[str, str]:
    out = out_root.rstrip("/")
    paths = {name: f"{out}/{name}" for name in (
        "orders_full", "errors", "payment", "stock", "decisions", "credit_balance", "stock_balance")}
    outcomes = enriched(spark, sf_dir, lim).withColumns({
        "route": F.when(F.col("error").isNull(), cart_route(F.col("productCount"), lim)),
        "valuable": F.coalesce(is_valuable(F.col("price"), lim), F.lit(False)),
    })
    outcomes = _write(outcomes, f"{out}/_outcomes")
    ok, _ = rt.split(outcomes)
    orders_full = _write(ok, paths["orders_full"])
    r = saga.run(orders_full.drop("route", "valuable"), lim, stored=True)
    pay = _write(r.payment, paths["payment"])
    stk = _write(r.stock, paths["stock"])
    r.with_stages(payment=pay, stock=stk)            # later stages read the written folds
    decisions = _write(r.decisions, paths["decisions"])
    r.with_stages(decisions=decisions)
    _write(r.settled(rv.payment_side(lim)), paths["credit_balance"])
    _write(r.settled(rv.stock_side(lim)), paths["stock_balance"])
    _write(er.union_errors(
        er.error_rows(outcomes, "enrich", "id"),
        er.error_rows(pay, "payment", "customerId"),
        er.error_rows(stk, "stock", "marketId"),
        er.error_rows(decisions, "decision", "id"),
    ), paths["errors"])
    return paths


if __name__ == "__main__":
    from ordertide.session import local_session
    session = local_session()
    for name, path in run_batch(session, sys.argv[1], sys.argv[2]).items():
        print(name, path)
    session.stop()
