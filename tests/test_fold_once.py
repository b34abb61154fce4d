"""The range-split fold shuffles its rows once, and balances read few of them."""

from decimal import Decimal

from conftest import full_df
from pyspark.sql import functions as F

from ordertide import REFERENCE_LIMITS as R
from ordertide.operators import reservation as rv
from ordertide.operators.reservation_split import Pieces, reserve_split

LIM = R.with_(initial_credit=100, initial_items=50)


def orders(spark):
    # every third price is over the guard, so some keys end with an error row; n: no key
    rows = [(f"o{i}", "m", None if i % 11 == 0 else f"c{i % 5}", 1 + i % 3, R.price_guard if i % 3 == 0 else 1 + i % 40, "NEW", None, i) for i in range(200)]
    return full_df(spark, rows)


def test_rows_are_not_shuffled_after_the_ranges(spark):
    for side in (rv.payment_side(LIM), rv.stock_side(LIM)):
        plan = reserve_split(orders(spark), side, partitions=6)._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_balances_from_marked_rows(spark):
    start = spark.createDataFrame([("c1", Decimal(60), Decimal(40)), ("idle", Decimal(7), Decimal(93))], "customerId string, available decimal(18,2), reserved decimal(18,2)")
    side = rv.payment_side(LIM)
    for first in (None, start):
        plain = rv.reserve(orders(spark), side, start=first)
        marked = reserve_split(orders(spark), side, partitions=6, start=first, idle=True, ends=True)
        n = marked.where("is_end").count()
        assert 5 <= n <= 40 and "is_end" not in reserve_split(orders(spark), side, partitions=6, start=first).columns
        assert sorted(map(str, rv.balances(marked, side).collect())) == sorted(map(str, rv.balances(plain, side).collect()))
        cols = ["id", "status", "error", "available", "reserved", "is_last"]
        assert sorted(map(str, marked.select(cols).collect())) == sorted(map(str, plain.select(cols).collect()))


def test_a_spent_balance_changes_nothing():
    p = Pieces(100)
    for a in (60, 30, 20, 50):
        p.new(a)
    lo, off = p.lo, p.off
    most = max(b - int(off[lo.searchsorted(b, "right") - 1]) for b in range(101))
    p.new(most + 1)
    assert p.most == most and p.lo is lo and p.off is off  # not computed again
    p.release(5)
    assert p.most == most + 5 and p(100) == 100 - int(off[lo.searchsorted(100, "right") - 1]) + 5
