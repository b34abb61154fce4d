"""Facts measured independently at sf0.01 (FIXTURES.md §2), recomputed with our operators."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from ordertide.operators import routing as rt
from ordertide.plans import queries as Q
from ordertide.plans import saga
from ordertide.sources.tables import order_facts


def test_order_facts(spark):
    facts = order_facts(spark, SF_MID)
    assert facts.count() == 15000
    assert facts.filter("n_products = 0").count() == 257
    assert facts.filter("n_products = 4").count() == 3024
    other = facts.filter("n_products != 4")
    assert other.filter("n_products >= 10").count() == 97
    assert other.filter("n_products >= 5 AND n_products < 10").count() == 5418
    assert other.filter("n_products < 5").count() == 6461
    assert facts.filter(F.col("total") > 200000).count() == 7394
    assert facts.agg(F.max("total")).first()[0] == Decimal("753168.05")


@pytest.mark.parametrize("items,expected", [
    (1000, {("ACCEPT", "ACCEPT"): 6379, ("ACCEPT", "REJECT"): 5209,
            ("REJECT", "ACCEPT"): 11, ("REJECT", "REJECT"): 377}),
    (2000, {("ACCEPT", "ACCEPT"): 11124, ("ACCEPT", "REJECT"): 464,
            ("REJECT", "ACCEPT"): 295, ("REJECT", "REJECT"): 93}),
])
def test_reply_pairs_without_guard_or_window(spark, items, expected):
    ok, _ = rt.split(Q.enriched(spark, SF_MID))
    lim = Q.LIM.with_(price_guard=10 ** 12, count_guard=10 ** 9, initial_items=items)
    r = saga.run(ok, lim, delays=None)
    p = r.payment.select("id", F.col("status").alias("p"))
    s = r.stock.select("id", F.col("status").alias("s"))
    got = {(x.p, x.s): x["count"] for x in p.join(s, "id").groupBy("p", "s").count().collect()}
    assert got == expected


@pytest.mark.parametrize("seconds,expected", [(10, 0), (600, 13), (3600, 62)])
def test_click_purchase_pairs(spark, seconds, expected):
    from ordertide.operators import decision as dc
    from ordertide.sources.tables import read_table
    ev = read_table(spark, SF_MID, "events")
    clicks = ev.filter("event_type = 'click'").select("user_id", F.col("ts").alias("c_ts"))
    buys = ev.filter("event_type = 'purchase'").select("user_id", F.col("ts").alias("p_ts"))
    assert dc.window_join(clicks, buys, "user_id", "c_ts", "p_ts", seconds).count() == expected
