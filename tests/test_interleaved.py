"""Settlements between slices of time."""

from decimal import Decimal

from conftest import full_df
from pyspark.sql import functions as F

from ordertide import REFERENCE_LIMITS as R
from ordertide.operators import reservation as rv
from ordertide.plans import saga
from ordertide.plans.interleaved import run_interleaved


def orders(spark):
    # the market has 5 items and the customer 100; each slice lasts 100 seconds
    return full_df(spark, [("a", "m", "c", 3, 60, "NEW", None, 0), ("b", "m", "c", 4, 30, "NEW", None, 10),   # b: stock rejects, credit is held
                           ("c", "m", "c", 1, 40, "NEW", None, 110), ("d", "m", "d", 9, 1, "NEW", None, 120),
                           ("e", "m2", "c", 1, 50, "NEW", None, 205)])


LIM = R.with_(initial_credit=100, initial_items=5)


def test_a_release_opens_later_accepts(spark, scratch):
    r = run_interleaved(orders(spark), LIM, F.floor(F.unix_timestamp("ts") / 100), scratch, delays=None)
    found = {d.id: (d.slice, d.status, d.source) for d in r["decisions"].collect()}
    # b is rolled back after the first slice, so its 30 are there for c
    assert found == {"a": (0, "CONFIRMED", None), "b": (0, "ROLLBACK", "STOCK"), "c": (1, "CONFIRMED", None),
                     "d": (1, "ROLLBACK", "STOCK"), "e": (2, "ROLLBACK", "PAYMENT")}
    assert {(x.customerId, x.available, x.reserved, x.settled) for x in r["payment_balance"].collect()} == \
        {("c", Decimal(0), Decimal(0), Decimal(100)), ("d", Decimal(100), Decimal(0), Decimal(0))}
    assert {(x.marketId, x.available, x.reserved, x.settled) for x in r["stock_balance"].collect()} == {("m", 1, 0, 4), ("m2", 5, 0, 0)}


def test_one_slice_is_the_plain_saga(spark, scratch):
    r = run_interleaved(orders(spark), LIM, F.lit(7), scratch, delays=None)
    plain = saga.run(orders(spark), LIM, delays=None)
    cols = ["id", "status", "source", "error"]
    assert sorted(map(str, r["decisions"].select(cols).collect())) == sorted(map(str, plain.decisions.select(cols).collect()))
    for side in (rv.payment_side(LIM), rv.stock_side(LIM)):
        assert sorted(map(str, r[f"{side.name}_balance"].collect())) == sorted(map(str, plain.settled(side).collect()))


def test_orders_without_a_time_and_none_at_all(spark, scratch):
    some = orders(spark).withColumn("ts", F.when(F.col("id") != "a", F.col("ts")))
    r = run_interleaved(some, LIM, F.floor(F.unix_timestamp("ts") / 100), f"{scratch}/1", delays=None)
    assert {x.slice for x in r["payment"].collect()} == {-2**31, 0, 1, 2}
    r = run_interleaved(orders(spark).limit(0), LIM, F.lit(1), f"{scratch}/2", delays=None)
    assert all(df.count() == 0 for df in r.values())
