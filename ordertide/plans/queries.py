"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's whole tables; money is exact decimal inside and
DOUBLE in the final projection (the oracle does the same).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide import schema as S
from ordertide.config import Limits, TABLE_LIMITS
from ordertide.functions.orders import cart_route, is_valuable, to_double
from ordertide.operators import decision as dc
from ordertide.operators import enrich as en
from ordertide.operators import routing as rt
from ordertide.operators import errors as er
from ordertide.operators import latest as lt
from ordertide.operators import quarantine as qr
from ordertide.operators import reservation as rv
from ordertide.operators import tables as tb
from ordertide.plans import saga
from ordertide.plans.interleaved import run_interleaved
from ordertide.session import checkpoint_dir
from ordertide.sources import topics as tp
from ordertide.sources.tables import order_facts, order_line_events, product_lines, read_table

LIM: Limits = TABLE_LIMITS


def enriched(spark: SparkSession, sf_dir: str, lim: Limits = LIM, with_market: bool = True) -> DataFrame:
    return en.enrich_facts(order_facts(spark, sf_dir, with_market), lim)


def q_enriched_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched(spark, sf_dir).select(
        "id", "customerId", "marketId", "productCount",
        to_double(F.col("price")).alias("price"), "status", "error")


def q_route_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = enriched(spark, sf_dir, with_market=False)
    route = F.when(F.col("error").isNotNull(), F.lit("error")).otherwise(cart_route(F.col("productCount"), LIM))
    valuable = F.col("error").isNull() & is_valuable(F.col("price"), LIM)
    return (out.select(route.alias("route"), "price", valuable.alias("valuable"))
            .groupBy("route")
            .agg(F.count(F.lit(1)).alias("n_orders"),
                 to_double(F.coalesce(F.sum("price"), F.lit(0).cast(S.MONEY))).alias("revenue"),
                 F.count_if("valuable").cast("bigint").alias("n_valuable")))


def q_valuable_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok, _ = rt.split(enriched(spark, sf_dir))
    return rt.valuable(ok, LIM).select(
        "id", "customerId", "marketId", "productCount", to_double(F.col("price")).alias("price"))


def q_full_mini_cart(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok, _ = rt.split(enriched(spark, sf_dir, with_market=False))
    return rt.full_mini_cart(ok, LIM).select("id", "productCount", to_double(F.col("price")).alias("price"))


def q_half_full_cart(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok, _ = rt.split(enriched(spark, sf_dir))
    return rt.half_full_cart(ok, LIM).select(
        "id", "customerId", "marketId", "productCount", to_double(F.col("price")).alias("price"), "status")


def q_topic_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per topic record counts of one fan-out pass (success routes + error topic)."""
    out = enriched(spark, sf_dir, with_market=False)
    topics = F.when(F.col("error").isNotNull(), F.array(F.lit(S.TOPIC_ERROR))).otherwise(rt.topics_of(LIM))
    return (out.select(F.explode(topics).alias("topic"))
            .groupBy("topic").agg(F.count(F.lit(1)).alias("n_records")))


def q_product_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B5 on the valuable-customer rows: even/odd product count paths."""
    ok, _ = rt.split(enriched(spark, sf_dir, with_market=False))
    return (rt.with_path(rt.valuable(ok, LIM)).groupBy("path")
            .agg(F.count(F.lit(1)).alias("n_orders"), to_double(F.sum("price")).alias("revenue")))


# --------------------------------------------------------------------------
# Reservation, decision, settlement.


def saga_of(spark: SparkSession, sf_dir: str, lim: Limits = LIM, persist: bool = False,
            with_market: bool = True) -> "saga.SagaResult":
    ok, _ = rt.split(enriched(spark, sf_dir, lim, with_market))
    return saga.run(ok, lim, persist=persist)


def q_credit_reservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = saga_of(spark, sf_dir, with_market=False)
    return r.payment.select("id", "customerId", "status", "error",
                            to_double(F.col("available")).alias("available"),
                            to_double(F.col("reserved")).alias("reserved"))


def q_stock_reservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = saga_of(spark, sf_dir)
    return r.stock.select("id", "marketId", "status", "error", "available", "reserved")


def q_credit_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = saga_of(spark, sf_dir, with_market=False).payment_balance()
    return b.select("customerId", to_double(F.col("available")).alias("available"),
                    to_double(F.col("reserved")).alias("reserved"))


def q_stock_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return saga_of(spark, sf_dir).stock_balance()


def q_order_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = saga_of(spark, sf_dir).decisions
    return d.select("id", "customerId", "marketId", "productCount",
                    to_double(F.col("price")).alias("price"), "status", "source", "error", "ts")


def _settled(spark: SparkSession, sf_dir: str, lim: Limits, payment: bool) -> DataFrame:
    r = saga_of(spark, sf_dir, lim)
    side = rv.payment_side(lim) if payment else rv.stock_side(lim)
    s = r.settled(side)
    if payment:
        return s.select("customerId", *[to_double(F.col(c)).alias(c) for c in ("available", "reserved", "settled")])
    return s


def q_settled_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _settled(spark, sf_dir, LIM, True)


def q_settled_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _settled(spark, sf_dir, LIM, False)


AS_CODED = LIM.with_(rollback_policy="as_coded")


def q_settled_credit_as_coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _settled(spark, sf_dir, AS_CODED, True)


def q_settled_stock_as_coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _settled(spark, sf_dir, AS_CODED, False)


def q_error_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error rows of all four stages in one frame (key, stage, message)."""
    return _error_topic(enriched(spark, sf_dir), LIM)


def _error_topic(out: DataFrame, lim: Limits) -> DataFrame:
    out = saga.materialize(out)
    ok, _ = rt.split(out)
    r = saga.run(ok, lim, stored=True).prepare_both()
    return er.union_errors(
        er.error_rows(out, "enrich", "id"),
        er.error_rows(r.payment, "payment", "customerId"),
        er.error_rows(r.stock, "stock", "marketId"),
        er.error_rows(r.decisions, "decision", "id"),
    )


#: Years of a slice of the interleaved saga.
SLICE_YEARS = 2


def _interleaved(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    ok, _ = rt.split(enriched(spark, sf_dir))
    folder = f"{checkpoint_dir(spark)}/interleaved-{uuid.uuid4().hex}"
    return run_interleaved(ok, LIM, F.floor(F.year("ts") / SLICE_YEARS), folder)


def q_interleaved_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions where the settlements of earlier slices count."""
    d = _interleaved(spark, sf_dir)["decisions"]
    return d.select("id", "customerId", "marketId", "slice", "status", "source", "error", "ts")


def q_interleaved_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both services' balances after the last slice."""
    r = _interleaved(spark, sf_dir)
    money = ("available", "reserved", "settled")
    pay = r["payment_balance"].select(F.lit("payment").alias("side"), F.col("customerId").alias("key"), *[F.col(c).cast("double") for c in money])
    return pay.unionByName(r["stock_balance"].select(F.lit("stock").alias("side"), F.col("marketId").alias("key"), *[F.col(c).cast("double") for c in money]))


def q_click_purchase_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1's window on a key that repeats: per user and hour, clicks and the pairs of a click
    and a purchase at most an hour apart."""
    ev = read_table(spark, sf_dir, "events").select("user_id", "ts", "event_type")
    clicks, purchases = (ev.where(F.col("event_type") == t) for t in ("click", "purchase"))
    by = {"user_id": F.col("user_id"), "hour": F.date_trunc("hour", "ts")}
    found = dc.window_pair_counts(clicks, purchases, "user_id", "ts", "ts", 3600, by)
    return found.select("user_id", F.col("hour").cast("timestamp_ntz").alias("hour"), F.col("n_left").alias("n_clicks"), "n_pairs")


def q_late_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6: orders that get no decision, as one service did not answer or both answers lie
    too far apart; what each held."""
    r = saga_of(spark, sf_dir).prepare_both()
    pay, stk = saga.with_reply_times(rt.replies(r.payment), rt.replies(r.stock),
                                     (saga.PAYMENT_DELAY_MOD, saga.STOCK_DELAY_MOD))
    return dc.undecided(pay, stk, LIM).select("id", "p_status", "s_status", "apart", "reason")


# --------------------------------------------------------------------------
# Latest per key (K1-K3).


def _order_records(spark: SparkSession, sf_dir: str, with_market: bool = True) -> DataFrame:
    market = ["marketId"] if with_market else []
    return order_facts(spark, sf_dir, with_market).select(
        "id", "customerId", *market, "ts", "seq",
        F.col("n_products").alias("productCount"), F.col("total").alias("price"))


def latest_order_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lt.latest(_order_records(spark, sf_dir, with_market=False), key="customerId")


def q_latest_order_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = latest_order_per_customer(spark, sf_dir)
    return t.select("customerId", "id", "ts", "productCount", to_double(F.col("price")).alias("price"))


def q_latest_event_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select(
        "user_id", "event_id", "ts", "event_type", "value")
    return lt.latest(ev, key="user_id", order=("ts", "event_id"))


def q_current_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lt.scan(lt.latest(_order_records(spark, sf_dir), key="id"))
    return t.select("id", "customerId", "marketId", "productCount", to_double(F.col("price")).alias("price"))


def q_customer_order_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: every customer looked up in the latest-order table; found or not."""
    requested = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("customerId"))
    found = lt.lookup(requested, latest_order_per_customer(spark, sf_dir), key="customerId")
    return found.select("customerId", "found", "id", to_double(F.col("price")).alias("price"))


# --------------------------------------------------------------------------
# Relational writes.


def _valuable(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    ok, _ = rt.split(en.enrich_facts(order_facts(spark, sf_dir, gaps=gaps), LIM))
    return rt.valuable(ok, LIM)


def q_event_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 parent rows: one per valuable order that passes S7."""
    ev = tb.event_rows(_valuable(spark, sf_dir), F.col("id"))
    return ev.filter(tb.not_null_ok(ev)).select(
        "event_id", "market_id", "customer_id", "product_count", to_double(F.col("price")).alias("price"))


def q_product_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 child rows: the lines of every written event (a join, no arrays)."""
    recs = _valuable(spark, sf_dir)
    events = recs.filter(tb.order_saves_ok()).select(F.col("id").alias("event_id"), F.col("seq").alias("orderkey"))
    rows = tb.product_rows_from_lines(events, product_lines(spark, sf_dir))
    return rows.select("event_id", "name", to_double(F.col("price")).alias("price"))


def q_event_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NOT NULL check of every event row a consumer would write."""
    ev = tb.event_rows(_valuable(spark, sf_dir), F.col("id"))
    return ev.select("event_id", tb.not_null_ok(ev).alias("ok"),
                     F.concat_ws(",", tb.violations(ev)).alias("violations"))


def q_product_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 on product rows, on lines with price gaps: rows that fail, by what is null."""
    rows = product_lines(spark, sf_dir, gaps=True).select(
        F.col("product_name").alias("name"), F.col("product_price").alias("price"),
        F.col("orderkey").cast("string").alias("event_id"))
    return (rows.select(F.concat_ws(",", tb.violations(rows, tb.PRODUCT_NOT_NULL)).alias("violations"))
            .groupBy("violations").agg(F.count(F.lit(1)).alias("n_rows")))


def _unnamed_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Event and product rows of the valuable orders, where some parts have no name."""
    recs = _valuable(spark, sf_dir)
    keys = recs.select(F.col("id").alias("event_id"), F.col("seq").alias("orderkey"))
    return (tb.event_rows(recs, F.col("id")), tb.product_rows_from_lines(keys, product_lines(spark, sf_dir, unnamed=True)))


def q_event_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 on whole transactions: an event with a product that has no name fails."""
    checked = tb.checked_events(*_unnamed_events(spark, sf_dir))
    return checked.select("event_id", (F.size("violations") == 0).alias("ok"), F.concat_ws(",", "violations").alias("violations"))


def q_committed_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 and S7 through the sink: two batches (even and odd orders) written to both
    tables in the shared folder and read from there; products with their events."""
    root = f"{checkpoint_dir(spark)}/events-{uuid.uuid4().hex}"
    events, products = _unnamed_events(spark, sf_dir)
    for batch in (0, 1):
        tb.write_event_tables(events.where(F.col("event_id").cast("long") % 2 == batch),
                              products.where(F.col("event_id").cast("long") % 2 == batch), root, batch)
    events, products = tb.read_event_tables(spark, root)
    return (products.withColumnRenamed("price", "product_price").join(events, "event_id")
            .select("event_id", "market_id", "customer_id", "product_count", to_double(F.col("price")).alias("price"),
                    "name", to_double(F.col("product_price")).alias("product_price")))


# --------------------------------------------------------------------------
# Branches that the usual limits never reach.

#: Guards low enough for the tables' orders.
GUARDED = LIM.with_(count_guard=9, decision_price_guard=300000)


def q_error_topic_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6 with the low guards: the stock and decision steps have error rows too."""
    return _error_topic(enriched(spark, sf_dir, GUARDED), GUARDED)


def q_credit_balance_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4 with a low price guard: a customer with guarded orders only has no balance."""
    lim = LIM.with_(price_guard=150000)
    b = saga_of(spark, sf_dir, lim, with_market=False).payment_balance()
    return b.select("customerId", to_double(F.col("available")).alias("available"),
                    to_double(F.col("reserved")).alias("reserved"))


def q_enriched_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrichment where some products have no price (NO_PRICE_MOD)."""
    out = en.enrich_facts(order_facts(spark, sf_dir, gaps=True), LIM)
    return out.select("id", "productCount", to_double(F.col("price")).alias("price"), "status", "error")


def q_half_full_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 with customers that aren't found: the latest half-full-cart order of each."""
    ok, _ = rt.split(enriched(spark, sf_dir, with_market=False))
    half = rt.half_full_cart(ok, LIM).select("customerId", "id", "ts", "seq", "price")
    requested = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("customerId"))
    found = lt.lookup(requested, lt.latest(half, key="customerId"), key="customerId")
    return found.select("customerId", "found", "id", to_double(F.col("price")).alias("price"))


# --------------------------------------------------------------------------
# Topic codec on whole tables (S1, S3, S4 with the array path of P1-P3).


ORDER_FIELDS = ["id", "marketId", "customerId", "products"]


def q_decoded_enriched_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders serialised to topic records (JSON, one product per record), decoded with
    the explicit schema, malformed ones skipped, folded per record from the products
    arrays and combined per event."""
    ev = order_line_events(spark, sf_dir)
    recs = tp.envelope(ev, S.TOPIC_ORDERS, tp.encode(ev, ORDER_FIELDS), key="id")
    out = en.enrich_facts(en.event_facts(tp.skip_malformed(tp.decode(recs))), LIM)
    return out.select("id", "productCount", to_double(F.col("price")).alias("price"), "status", "error")


def q_ingested_plain_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written to the orders topic in the shared folder, read from
    there and enriched without the injected fault."""
    root = f"{checkpoint_dir(spark)}/ingest-{uuid.uuid4().hex}"
    tp.ingest_orders(order_line_events(spark, sf_dir), root)
    decoded = tp.skip_malformed(tp.decode(tp.read_topic(spark, root, S.TOPIC_ORDERS)))
    out = en.enrich_facts(en.event_facts(decoded), LIM.with_(fault_count=None))
    return out.select("id", "productCount", to_double(F.col("price")).alias("price"), "status", "error")


#: In the mixed topic, orders whose key this divides carry a status that doesn't exist.
BAD_STATUS_MOD = 11


def _mixed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of enriched orders, some with an unknown status, of texts that are no JSON at
    all, and of the events' ``props``, which decode."""
    ok, _ = rt.split(enriched(spark, sf_dir))
    status = F.when(F.col("seq") % BAD_STATUS_MOD == 0, F.lit("SHIPPED")).otherwise(F.col("status"))
    ok = ok.withColumn("status", status)
    full = tp.envelope(ok, "order", tp.encode(ok, ["id", "marketId", "customerId", "productCount", "price", "status", "source"]), key="id")
    docs = read_table(spark, sf_dir, "documents").withColumn("ts", F.lit(None).cast("timestamp"))
    texts = tp.envelope(docs, "text", F.col("text"), key="doc_id", seq="doc_id")
    events = read_table(spark, sf_dir, "events")
    props = tp.envelope(events, "props", F.col("props"), key="event_id", seq="event_id")
    return full.unionByName(texts).unionByName(props)


def q_malformed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: records and drops of the mixed records by kind."""
    decoded = tp.decode(_mixed_records(spark, sf_dir), S.ORDER_FULL_EVENT)
    return (decoded.groupBy(F.col("topic").alias("kind"))
            .agg(F.count(F.lit(1)).alias("n_records"), F.count(F.col(S.CORRUPT)).alias("n_dropped")))


def q_replayed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 with its quarantine: the mixed records' malformed ones kept, those with an unknown
    status replayed as NEW, and what is open or back afterwards, by kind and reason."""
    root = f"{checkpoint_dir(spark)}/replay-{uuid.uuid4().hex}"
    qr.keep_malformed(tp.decode(_mixed_records(spark, sf_dir), S.ORDER_FULL_EVENT), root, "mixed-0")

    def as_new(open_: DataFrame) -> DataFrame:
        return open_.withColumn("value", F.replace("value", F.lit('"SHIPPED"'), F.lit('"NEW"')))
    for job in (0, 1):  # the second finds only what can't be mended
        qr.reingest(spark, root, as_new, job, S.ORDER_FULL_EVENT)
    back = tp.decode(tp.read_log(spark, root).select(*S.ENVELOPE.fieldNames()), S.ORDER_FULL_EVENT)
    back = back.groupBy(F.col("topic").alias("kind")).agg(F.count(F.lit(1)).alias("n_back"), F.countDistinct("key").alias("n_keys"))
    kept = qr.quarantined(spark, root).groupBy(F.col("topic").alias("kind"), "reason").agg(
        F.count(F.lit(1)).alias("n_kept"), F.count_if("replayed").cast("bigint").alias("n_replayed"))
    return kept.join(back, "kind", "left").select("kind", "reason", "n_kept", "n_replayed", F.coalesce("n_back", F.lit(0)).alias("n_back"),
                                                  F.coalesce("n_keys", F.lit(0)).alias("n_keys"))


def q_reply_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 + P7: the replies of both reservation services, re-keyed by order id,
    with their reply times."""
    r = saga_of(spark, sf_dir).prepare_both()
    pay, stk = saga.with_reply_times(rt.replies(r.payment), rt.replies(r.stock),
                                     (saga.PAYMENT_DELAY_MOD, saga.STOCK_DELAY_MOD))
    return (pay.select(F.lit(S.TOPIC_PAYMENT).alias("topic"), F.col("id").alias("key"), "status", "ts")
            .unionByName(stk.select(F.lit(S.TOPIC_STOCK).alias("topic"), F.col("id").alias("key"),
                                    "status", "ts")))


def q_decision_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions per (status, source, error): orders and revenue."""
    d = saga_of(spark, sf_dir).decisions
    return (d.groupBy("status", "source", "error")
            .agg(F.count(F.lit(1)).alias("n_orders"), to_double(F.sum("price")).alias("revenue")))

