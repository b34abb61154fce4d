"""The range-split fold equals the per-key stream fold, hot keys included."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ordertide.operators import reservation as rv
from ordertide.operators import routing as rt
from ordertide.operators.reservation_split import Pieces, carry_bounds, carry_state, reserve_split
from ordertide.plans import queries as Q

COLS = ["id", "status", "error", "available", "reserved", "is_last"]


@pytest.fixture(scope="module")
def orders(spark):
    ok, _ = rt.split(Q.enriched(spark, "/root/testdata/sf0.001"))
    return ok.cache()


def _same(a, b):
    pa = a.select(*COLS).toPandas().sort_values("id").reset_index(drop=True)
    pb = b.select(*COLS).toPandas().sort_values("id").reset_index(drop=True)
    return pa.equals(pb)


def test_many_keys(spark, orders):
    side = rv.payment_side(Q.LIM)
    assert _same(rv.reserve(orders, side), reserve_split(orders, side, partitions=8))


def test_one_hot_key_spans_partitions(spark, orders):
    hot = orders.withColumn("marketId", F.lit("M"))
    side = rv.stock_side(Q.LIM.with_(initial_items=3000))
    out = reserve_split(hot, side, partitions=8)
    assert _same(rv.reserve(hot, side), out)
    assert out.filter("is_last").count() == 1
    statuses = {r.status for r in out.select("status").distinct().collect()}
    assert {"ACCEPT", "REJECT"} <= statuses


def test_hot_money_key(spark, orders):
    hot = orders.withColumn("customerId", F.when(F.col("seq") % 2 == 0, F.lit("H")).otherwise(F.col("customerId")))
    side = rv.payment_side(Q.LIM.with_(initial_credit=20000000))
    plain = rv.reserve(hot, side)
    assert _same(plain, reserve_split(hot, side, partitions=8))


@pytest.mark.parametrize("policy", ["release_holder", "as_coded"])
def test_mixed_statuses(spark, orders, policy):
    mix = (orders
           .withColumn("status", F.when(F.col("seq") % 5 == 0, "CONFIRMED")
                       .when(F.col("seq") % 7 == 0, "ROLLBACK").otherwise("NEW"))
           .withColumn("source", F.when(F.col("seq") % 2 == 0, "PAYMENT").otherwise("STOCK"))
           .withColumn("marketId", (F.col("seq") % 2).cast("string")))
    side = rv.stock_side(Q.LIM.with_(initial_items=500, rollback_policy=policy))
    assert _same(rv.reserve(mix, side), reserve_split(mix, side, partitions=8))


def test_result_survives_union(spark, orders):
    side = rv.stock_side(Q.LIM)
    a = rv.reserve(orders, side).select(*COLS)
    b = reserve_split(orders, side, partitions=8).select(*COLS)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_pieces_match_scalar_fold():
    import random
    rnd = random.Random(7)
    prices = [rnd.randint(1, 40) for _ in range(300)]
    p = Pieces(upper=200)
    for a in prices:
        p.new(a)
    for b in range(0, 201):
        bal = b
        for a in prices:
            if a <= bal:
                bal -= a
        assert p(b) == bal


def test_state_is_carried_over_partitions():
    cols = ["key", "pid", "tail", "whole", "conf", "end", "bound_end", "lo", "off"]
    parts = pd.DataFrame([("b", 2, False, False, 0, None, None, None, None),
                          ("b", 1, False, True, 0, None, 995, [0, 5], [0, 5]),
                          ("b", 0, True, False, 0, 990, None, None, None)], columns=cols)
    assert carry_bounds(parts.assign(open_a=None, open_conf=None), 1000) == [(1, 990)]
    assert carry_state(parts.assign(open_a=None, open_conf=None), 1000) == [(0, None, None, None, True), (1, "b", 990, 10, True), (2, "b", 985, 15, False)]


def test_many_pieces(spark):
    """A hot money key whose balance lasts: hundreds of pieces in a partition."""
    from conftest import full_df
    rows = [(f"o{i}", "m", "H", 1, 1 + (i * 7919) % 997, "NEW", None, i) for i in range(2400)]
    df = full_df(spark, rows)
    side = rv.payment_side(Q.LIM.with_(initial_credit=600_000))
    assert _same(rv.reserve(df, side), reserve_split(df, side, partitions=6))
    p = Pieces(600_000 * 100)
    for r in rows[400:800]:
        p.new(r[4] * 100)
    assert len(p.lo) > 256


def test_edge_inputs(spark):
    from conftest import full_df
    side = rv.payment_side(Q.LIM)
    empty = full_df(spark, [("o1", "m", "c", 1, 5, "NEW", None, 0)]).limit(0)
    assert reserve_split(empty, side, partitions=4).count() == 0
    nulls = full_df(spark, [("o1", "m", None, 1, 5, "NEW", None, 0), ("o2", "m", None, 1, 6, "NEW", None, 1)])
    out = reserve_split(nulls, side, partitions=4).collect()
    assert {r.error for r in out} == {"null key"} and not any(r.is_last for r in out)
    one = full_df(spark, [("o1", "m", "c", 1, 5, "NEW", None, 0)])
    assert _same(rv.reserve(one, side), reserve_split(one, side, partitions=16))


@pytest.mark.parametrize("policy", ["release_holder", "as_coded"])
@pytest.mark.parametrize("fold", [rv.reserve, reserve_split])
def test_starts_from_balances(spark, orders, policy, fold):
    """The second half folded from the balances of the first equals the whole fold."""
    mix = (orders.withColumn("status", F.when(F.col("seq") % 5 == 0, "CONFIRMED").when(F.col("seq") % 7 == 0, "ROLLBACK").otherwise("NEW"))
           .withColumn("source", F.when(F.col("seq") % 2 == 0, "PAYMENT").otherwise("STOCK"))
           .withColumn("marketId", F.when(F.col("seq") % 10 != 0, "hot").otherwise(F.concat(F.lit("m"), F.col("seq") % 7))))
    cut = mix.approxQuantile("seq", [0.4], 0.0)[0]
    mix = mix.withColumn("ts", F.timestamp_seconds("seq").cast("timestamp_ntz"))
    side = rv.stock_side(Q.LIM.with_(initial_items=900, rollback_policy=policy))
    whole = rv.reserve(mix, side).where(F.col("seq") > cut)
    start = rv.balances(rv.reserve(mix.where(F.col("seq") <= cut), side), side)
    later = fold(mix.where(F.col("seq") > cut), side, partitions=8, start=start)
    assert _same(whole, later)


def test_hot_key_starts_in_all_tasks(spark, orders):
    """A market with nine tenths of a batch: its rows are dealt over all partitions."""
    hot = orders.withColumn("marketId", F.when(F.col("seq") % 10 != 0, "hot").otherwise(F.col("marketId")))
    start = spark.createDataFrame([("hot", 700, 300), ("gone", 1, 2)], "marketId string, available long, reserved long")
    staged = rv.stage(hot, rv.stock_side(Q.LIM))
    opened = rv.opening_rows(start, staged, rv.stock_side(Q.LIM))
    assert [(r._k, r._amt, r._in_source) for r in opened.collect()] == [("hot", 700, "300")]
    small = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "64"}
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():  # small partitions aren't put together again
        spark.conf.set(k, v)
    out = reserve_split(hot, rv.stock_side(Q.LIM), partitions=8, start=start)
    rows = [r.n for r in out.groupBy(F.spark_partition_id(), "marketId").agg(F.count("*").alias("n")).where("marketId = 'hot'").collect()]
    for k, v in before.items():
        spark.conf.set(k, v)
    assert len(rows) >= 7 and max(rows) <= 2 * sorted(rows)[len(rows) // 2]
