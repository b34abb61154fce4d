"""Reservation fold, guards, settlement under both rollback policies."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import full_df
from ordertide import REFERENCE_LIMITS as L
from ordertide import schema as S
from ordertide.operators import reservation as rv
from ordertide.operators.reservation_split import reserve_split


def _rows(df):
    return sorted(df.collect(), key=lambda r: r.seq)


def test_credit_accept_twice(spark):
    df = full_df(spark, [("o1", "m", "c1", 1, 30000, "NEW", None, 0),
                         ("o2", "m", "c1", 1, 10000, "NEW", None, 1)])
    out = rv.reserve(df, rv.payment_side(L))
    assert [r.status for r in _rows(out)] == ["ACCEPT", "ACCEPT"]
    bal = rv.balances(out, rv.payment_side(L)).first()
    assert (bal.available, bal.reserved) == (Decimal("10000.00"), Decimal("40000.00"))


def test_credit_reject_and_guard(spark):
    df = full_df(spark, [("o1", "m", "c1", 1, 60000, "NEW", None, 0),
                         ("o2", "m", "c2", 1, 100000, "NEW", None, 0)])
    rows = {r.id: r for r in rv.reserve(df, rv.payment_side(L)).collect()}
    assert rows["o1"].status == "REJECT" and rows["o1"].available == Decimal("50000.00")
    assert rows["o2"].error == S.MSG_PRICE_HIGH
    assert rows["o2"].available == Decimal("50000.00") and rows["o2"].reserved == Decimal("0.00")


def test_stock_cases(spark):
    df = full_df(spark, [("o1", "m1", "c", 5, 1, "NEW", None, 0),
                         ("o2", "m1", "c", 2, 1, "NEW", None, 1),
                         ("o3", "m2", "c", 1500, 1, "NEW", None, 0),
                         ("o4", "m3", "c", 2500, 1, "NEW", None, 0)])
    side = rv.stock_side(L)
    rows = {r.id: r for r in rv.reserve(df, side).collect()}
    assert rows["o2"].status == "ACCEPT" and (rows["o2"].available, rows["o2"].reserved) == (993, 7)
    assert rows["o3"].status == "REJECT" and rows["o3"].available == 1000
    assert rows["o4"].error == S.MSG_COUNT_HIGH


def test_null_key_and_status(spark):
    df = full_df(spark, [("o1", "m", None, 1, 5, "NEW", None, 0),
                         ("o2", "m", "c", 1, 5, None, None, 0)])
    rows = {r.id: r for r in rv.reserve(df, rv.payment_side(L)).collect()}
    assert rows["o1"].error == S.MSG_NULL_KEY
    assert rows["o2"].error == S.MSG_NULL_STATUS


@pytest.mark.parametrize("policy,expected", [
    # ROLLBACK names STOCK (stock rejected, payment holds 100):
    ("release_holder", (Decimal("50000.00"), Decimal("0.00"))),
    ("as_coded", (Decimal("49900.00"), Decimal("100.00"))),
])
def test_rollback_policies(spark, policy, expected):
    lim = L.with_(rollback_policy=policy)
    df = full_df(spark, [("o1", "m", "c", 1, 100, "NEW", None, 0),
                         ("o1", "m", "c", 1, 100, "ROLLBACK", "STOCK", 5)])
    out = rv.reserve(df, rv.payment_side(lim))
    last = rv.balances(out, rv.payment_side(lim)).first()
    assert (last.available, last.reserved) == expected


def test_confirmed_settles(spark):
    df = full_df(spark, [("o1", "m", "c", 1, 100, "NEW", None, 0),
                         ("o1", "m", "c", 1, 100, "CONFIRMED", None, 5)])
    last = rv.balances(rv.reserve(df, rv.payment_side(L)), rv.payment_side(L)).first()
    assert (last.available, last.reserved) == (Decimal("49900.00"), Decimal("0.00"))


def test_fold_crosses_arrow_batches(spark):
    """Few keys, tiny Arrow batches: the carried balance must match a plain fold."""
    from ordertide.plans import queries as Q
    from ordertide.operators import routing as rt
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        ok, _ = rt.split(Q.enriched(spark, "/root/testdata/sf0.01"))
        ok = ok.withColumn("marketId", (F.col("seq") % 3).cast("string"))
        side = rv.stock_side(Q.LIM.with_(initial_items=12000))
        out = rv.reserve(ok, side, partitions=2).select("id", "seq", "marketId", "status", "available").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    src = ok.select("id", "seq", "ts", "marketId", "productCount").collect()
    # brute force: plain Python per key in (ts, seq) order
    expect = {}
    for k in {r.marketId for r in src}:
        avail = 12000
        for r in sorted([r for r in src if r.marketId == k], key=lambda r: (r.ts, r.seq)):
            if r.productCount <= avail:
                avail -= r.productCount
                expect[r.id] = ("ACCEPT", avail)
            else:
                expect[r.id] = ("REJECT", avail)
    got = {r.id: (r.status, r.available) for r in out}
    assert got == expect
    assert sum(1 for v in expect.values() if v[0] == "REJECT") > 0


def test_settlement_invariant(spark):
    """release_holder: available + reserved + settled = initial for every key."""
    from ordertide.plans import queries as Q
    r = Q.saga_of(spark, "/root/testdata/sf0.001", persist=False)
    for side in (rv.payment_side(Q.LIM), rv.stock_side(Q.LIM)):
        s = r.settled(side)
        bad = s.filter(F.col("available") + F.col("reserved") + F.col("settled") != F.lit(side.initial))
        assert bad.count() == 0


def test_guarded_only_key_has_no_balance(spark):
    """An error row stores nothing, so a key with nothing else has no balance."""
    lim = L
    side = rv.payment_side(lim)
    df = full_df(spark, [("1", "m", "c1", 1, lim.price_guard, "NEW", None, 1), ("2", "m", "c2", 1, 10, "NEW", None, 2),
                         ("3", "m", "c2", 1, lim.price_guard, "NEW", None, 3)])
    for folded in (rv.reserve(df, side), reserve_split(df, side, 2)):
        got = [(r.customerId, int(r.available), int(r.reserved)) for r in rv.balances(folded, side).collect()]
        assert got == [("c2", lim.initial_credit - 10, 10)]


def test_equal_times_fold_by_id(spark):
    """Rows of one key with equal time and offset fold in the order of their ids,
    whatever order they come in."""
    lim = L
    side = rv.payment_side(lim)
    rows = [(str(i), "m", "c", 1, 20000 + i, "NEW", None, 5) for i in range(4)]
    seen = set()
    for some in (rows, rows[::-1]):
        df = full_df(spark, some).withColumn("seq", F.lit(7).cast("long"))
        seen.add(tuple(sorted((r.id, r.status) for r in rv.reserve(df, side).collect())))
    assert seen == {(("0", "ACCEPT"), ("1", "ACCEPT"), ("2", "REJECT"), ("3", "REJECT"))}
