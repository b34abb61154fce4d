"""Enrichment and routing: the reference's topology cases plus edge cases."""

from decimal import Decimal

from pyspark.sql import functions as F

from conftest import orders_df
from ordertide import REFERENCE_LIMITS as L
from ordertide import schema as S
from ordertide.operators import enrich as en
from ordertide.operators import routing as rt


def _by_id(df):
    return {r["id"]: r for r in df.collect()}


def test_reference_cases(spark):
    df = orders_df(spark, [
        ("o1", "m", "c", [2000]),
        ("o2", "m", "c", [15000, 5000]),
        ("o3", "m", "c", [2000] * 5),
        ("o4", "m", "c", [2000] * 4),
    ])
    out = en.enrich(df, L)
    rows = _by_id(out)
    assert (rows["o1"]["productCount"], rows["o1"]["price"], rows["o1"]["status"]) == (1, Decimal("2000.00"), "NEW")
    assert rows["o2"]["price"] == Decimal("20000.00")
    assert rows["o3"]["price"] == Decimal("10000.00")
    assert rows["o4"]["error"] == S.MSG_DIV_ZERO and rows["o4"]["status"] is None
    ok, bad = rt.split(out)
    assert {r.id for r in rt.valuable(ok, L).collect()} == {"o2", "o3"}
    assert {r.id for r in rt.full_mini_cart(ok, L).collect()} == {"o1", "o2"}
    assert {r.id for r in rt.half_full_cart(ok, L).collect()} == {"o3"}
    assert [(r.key, r.error) for r in bad.collect()] == [("o4", S.MSG_DIV_ZERO)]


def test_edge_cases(spark):
    df = orders_df(spark, [
        ("full", "m", "c", [1] * 10),
        ("exact", "m", "c", [4000]),
        ("empty", "m", "c", []),
        ("nullp", "m", "c", None),
        ("nullprice", "m", "c", [1, None]),
        ("nullelem", "m", "c", [1, "NULL"]),
        ("nine", "m", "c", [1] * 9),
    ])
    rows = _by_id(en.enrich(df, L))
    assert rows["empty"]["price"] == Decimal("0.00") and rows["empty"]["productCount"] == 0
    assert rows["nullp"]["error"] == S.MSG_NULL_PRODUCTS
    assert rows["nullprice"]["error"] == S.MSG_NULL_PRICE
    assert rows["nullelem"]["error"] == S.MSG_NULL_PRODUCT
    ok, _ = rt.split(en.enrich(df, L))
    routed = {r.id: r.route for r in rt.with_route(ok, L).collect()}
    assert routed["full"] == S.ROUTE_FULL and routed["nine"] == S.ROUTE_HALF
    assert routed["empty"] == S.ROUTE_MINI
    assert "exact" not in {r.id for r in rt.valuable(ok, L).collect()}  # strictly above


def test_fault_rule_can_be_disabled(spark):
    df = orders_df(spark, [("o4", "m", "c", [2000] * 4)])
    row = en.enrich_plain(df, L).first()
    assert row.error is None and row.productCount == 4


def test_partial_projection(spark):
    ok, _ = rt.split(en.enrich(orders_df(spark, [("o1", "m", "c", [5])]), L))
    cols = en.partial(ok).columns
    assert "marketId" not in cols and "status" not in cols
    assert [c for c in cols if c in en.PARTIAL_COLUMNS] == en.PARTIAL_COLUMNS


def test_routes_partition_success_rows(spark):
    from ordertide.plans import queries as Q
    ok, _ = rt.split(Q.enriched(spark, "/root/testdata/sf0.001"))
    routed = rt.with_route(ok, Q.LIM)
    n = ok.count()
    assert routed.groupBy("route").count().agg(F.sum("count")).first()[0] == n


def test_even_odd_path(spark):
    ok, _ = rt.split(en.enrich(orders_df(spark, [("a", "m", "c", [1, 2]), ("b", "m", "c", [1])]), L))
    paths = {r.id: r.path for r in rt.with_path(ok).collect()}
    assert paths == {"a": "transactional", "b": "plain"}


def _facts_of(records):
    from ordertide.sources import topics as tp
    recs = tp.envelope(records, "orders", tp.encode(records, ["id", "marketId", "customerId", "products"]), key="id")
    return en.event_facts(tp.skip_malformed(tp.decode(recs)))


def test_line_records_equal_whole_records(spark):
    """Orders spread over records of one product each enrich exactly like whole ones."""
    from ordertide.plans import queries as Q
    from ordertide.sources.tables import order_events, order_line_events
    sf = "/root/testdata/sf0.001"
    got = en.enrich_facts(_facts_of(order_line_events(spark, sf)), Q.LIM)
    want = en.enrich(order_events(spark, sf), Q.LIM)
    cols = ["id", "productCount", "price", "status", "error"]
    a = got.select(*cols).toPandas().sort_values("id").reset_index(drop=True)
    b = want.select(*cols).toPandas().sort_values("id").reset_index(drop=True)
    assert a.equals(b)


def test_events_of_one_id_stay_apart(spark):
    """Two events of one order id are two orders, and equal lines spread like others."""
    df = orders_df(spark, [("a", "m", "c", [1, 2]), ("a", "m", "c", [5, 6]), ("b", "m", "c", [3] * 5000)])
    lines = df.withColumn("products", F.explode(F.transform("products", lambda p: F.array(p))))
    got = sorted((r.id, r.n_products, r.total) for r in _facts_of(lines).collect())
    assert [(i, n, int(t)) for i, n, t in got] == [("a", 2, 3), ("a", 2, 11), ("b", 5000, 15000)]


def test_event_facts_null_rules(spark):
    df = orders_df(spark, [("a", "m", "c", [1, None]), ("b", "m", "c", [1, "NULL"]), ("c", "m", "c", None),
                           ("d", "m", "c", [3, 4])])
    # split every order into one record per product
    from pyspark.sql import functions as G
    per = df.select("key", "id", "marketId", "customerId", "ts", "seq",
                    G.explode_outer(G.coalesce(G.transform("products", lambda p: G.array(p)),
                                               G.array(G.lit(None).cast(df.schema["products"].dataType))))
                    .alias("products"), G.lit(False).alias("value_null"))
    got = {r.id: (r.error, r.price) for r in en.enrich_facts(en.event_facts(per), L).collect()}
    want = {r.id: (r.error, r.price) for r in en.enrich(df, L).collect()}
    assert got == want
