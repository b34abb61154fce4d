"""The saga with settlements that take part in later decisions.

Orders are cut into slices of time. Within a slice both services reserve in order of
time, from the balances that the slice before left; its replies are joined and decided,
and the decisions settle both balances before the next slice begins. So a release opens
room for orders of later slices, as in the live system, where a decision comes back some
time after its order. The slices are the schedule: the finer, the sooner a settlement
counts. ``plans.saga`` is the case of one slice.

The driver holds the slices' numbers. Orders are written once, partitioned by slice, and
each slice reads its own; folds, decisions and balances of each slice are tables too, so
a lost executor repeats work of one slice at most.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide.config import Limits
from ordertide.operators import decision as dc
from ordertide.operators import reservation as rv
from ordertide.operators import routing as rt
from ordertide.operators.reservation_split import END, reserve_split
from ordertide.plans.saga import PAYMENT_DELAY_MOD, STOCK_DELAY_MOD, with_reply_times

#: Slice of orders without a time: before all others.
NO_TIME = -(2**31)


def _balances_after(before: DataFrame | None, folded: DataFrame, decided: DataFrame, side: rv.Side) -> DataFrame:
    """Key, available, reserved and settled (in all) after a slice."""
    now = rv.balances(folded, side)
    if before is not None:
        kept = before.select(side.key, "available", "reserved").join(now.select(side.key), side.key, "left_anti")
        now = now.unionByName(kept)
    done = rv.settle(now, rv.settlement_deltas(decided, side), side)
    if before is None:
        return done
    settled = done.schema["settled"].dataType
    earlier = before.select(side.key, F.col("settled").alias("_earlier"))
    return (done.join(earlier, side.key, "left")
            .select(side.key, "available", "reserved", (F.col("settled") + F.coalesce("_earlier", F.lit(0))).cast(settled).alias("settled")))


def run_interleaved(orders_full: DataFrame, lim: Limits, slice_of: Column, folder: str,
                    delays: tuple[int, int] | None = (PAYMENT_DELAY_MOD, STOCK_DELAY_MOD)) -> dict[str, DataFrame]:
    """``orders_full``: successful enriched orders with ``ts`` and ``seq``; ``slice_of``: their
    slice, a whole number that grows with time (null: before all others); ``folder``: for
    the tables, shared by driver and executors. Returns ``decisions`` (with ``slice``),
    ``payment`` and ``stock`` rows (with ``slice``), and the last ``payment_balance`` and
    ``stock_balance``."""
    spark = orders_full.sparkSession
    sides = (rv.payment_side(lim), rv.stock_side(lim))

    def write(df: DataFrame, path: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{path}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{path}")

    def both(fn) -> list[DataFrame]:
        """The two services at once; their jobs don't depend on each other."""
        with ThreadPoolExecutor(max_workers=2) as pool:
            return list(pool.map(inheritable_thread_target(spark)(fn), (0, 1)))
    numbered = orders_full.withColumn("slice", F.coalesce(slice_of.cast("int"), F.lit(NO_TIME)))
    numbered.write.mode("overwrite").partitionBy("slice").parquet(f"{folder}/orders")
    orders = spark.read.schema(numbered.schema).parquet(f"{folder}/orders")
    slices = sorted(r.slice for r in orders.select("slice").distinct().collect())
    folds: tuple[list, list] = ([], [])
    decided: list[DataFrame] = []
    balances: list[DataFrame | None] = [None, None]
    for k in slices:
        rows = orders.where(F.col("slice") == k).drop("slice")
        pair = both(lambda i: write(reserve_split(rows, sides[i], start=balances[i], idle=True, ends=True), f"{sides[i].name}/{k}"))
        replies = with_reply_times(rt.replies(pair[0]), rt.replies(pair[1]), delays)
        decisions = write(dc.decisions(*replies, lim), f"decisions/{k}")
        ok, _ = rt.split(decisions)
        balances = both(lambda i: write(_balances_after(balances[i], pair[i], ok, sides[i]), f"{sides[i].name}-balance/{k}"))
        decided.append(decisions.withColumn("slice", F.lit(k)))
        for f, df in zip(folds, pair, strict=True):
            f.append(df.drop(END).withColumn("slice", F.lit(k)))

    def union(parts: list[DataFrame]) -> DataFrame:
        whole = parts[0]
        for p in parts[1:]:
            whole = whole.unionByName(p)
        return whole
    if not slices:  # no orders: the same columns without rows
        r = [rv.reserve(orders.drop("slice"), s) for s in sides]
        none = dc.decisions(*with_reply_times(rt.replies(r[0]), rt.replies(r[1]), delays), lim)
        folds, decided = ([r[0].withColumn("slice", F.lit(0))], [r[1].withColumn("slice", F.lit(0))]), [none.withColumn("slice", F.lit(0))]
        balances = [_balances_after(None, r[i], none, sides[i]) for i in (0, 1)]
    return {"decisions": union(decided), "payment": union(folds[0]), "stock": union(folds[1]),
            "payment_balance": balances[0], "stock_balance": balances[1]}
