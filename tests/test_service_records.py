"""What services keep beside their results: quarantine, counts, replies without a partner."""

import time

from conftest import SF_SMALL
from pyspark.sql import functions as F

from ordertide import REFERENCE_LIMITS as R
from ordertide import TABLE_LIMITS as L
from ordertide import schema as S
from ordertide.operators import decision as dc
from ordertide.operators import quarantine as qr
from ordertide.sources import topics as tp
from ordertide.sources.tables import order_events
from ordertide.streaming import saga as ss
from ordertide.streaming.enrichment import start_enrichment
from ordertide.streaming.late import unmatched_stream
from ordertide.streaming.metrics import ObservedCounts, observed

GOOD = '{"id":"%s","marketId":"m","customerId":"c","products":[{"id":"1","name":"a","price":2000}]}'


def put(spark, root, batch, rows):
    recs = spark.createDataFrame([(k, v, "orders", 0, i, None) for i, (k, v) in enumerate(rows)], S.ENVELOPE)
    tp.write_records(recs.withColumn("timestamp", F.timestamp_seconds("offset")), root, batch)


def test_quarantine_and_replay(spark, scratch):
    root, ck = f"{scratch}/topics", f"{scratch}/ck"
    put(spark, root, "in-0", [("a", GOOD % "a"), ("b", "{broken " + GOOD % "b"), ("c", "hopeless"), ("d", None)])
    start_enrichment(spark, root, ck, L).awaitTermination()
    kept = qr.quarantined(spark, root)
    assert {(r.key, r.offset, r.value, r.reason, r.replayed) for r in kept.collect()} == {
        ("b", 1, "{broken " + GOOD % "b", "unreadable", False), ("c", 2, "hopeless", "unreadable", False)}

    def correct(open_):
        return open_.withColumn("value", F.regexp_replace("value", r"^\{broken ", ""))
    assert qr.reingest(spark, root, correct, 0) and not qr.reingest(spark, root, correct, 0)
    qr.reingest(spark, root, correct, 1)  # nothing is left to mend
    orders = tp.read_topic(spark, root, S.TOPIC_ORDERS)
    assert sorted((r.key, r.offset) for r in orders.collect()) == [("a", 0), ("b", 1), ("b", 1), ("c", 2), ("d", 3)]
    assert {r.key: r.replayed for r in qr.quarantined(spark, root).collect()} == {"b": True, "c": False}
    for _ in range(2):
        start_enrichment(spark, root, ck, L).awaitTermination()
        assert sorted(r.key for r in tp.read_topic(spark, root, S.TOPIC_ORDERS_FULL).collect()) == ["a", "b"]
        assert qr.quarantined(spark, root).count() == 2


def test_counts_of_all_services_are_kept(spark, scratch):
    root, ck, counts = f"{scratch}/topics", f"{scratch}/ck", f"{scratch}/counts"
    ev = order_events(spark, SF_SMALL)
    tp.ingest_orders(ev, root, "ingest-0")
    put(spark, root, "bad-0", [("x", "test"), ("y", "test")])
    listener = ObservedCounts(spark, counts)
    spark.streams.addListener(listener)
    ss.run_rounds(spark, root, ck, L, rounds=1)
    found = {}
    for _ in range(50):  # the listener hears of a batch a little later
        found = {(r.service, r.observation, r.metric): r.value for r in
                 observed(spark, counts).groupBy("service", "observation", "metric").agg(F.sum("value").alias("value")).collect()}
        if len({s for s, _, _ in found}) == 4:
            break
        time.sleep(0.2)
    spark.streams.removeListener(listener)
    assert found["enrich", "decode", "records"] == ev.count() + 2 and found["enrich", "decode", "malformed"] == 2
    full = tp.read_topic(spark, root, S.TOPIC_ORDERS_FULL)
    new = tp.decode(full, S.ORDER_FULL_EVENT).where("status = 'NEW'").count()
    assert found["payment", "decode-orders-full", "records"] == found["stock", "decode-orders-full", "records"] == new
    for topic in (S.TOPIC_PAYMENT, S.TOPIC_STOCK):
        assert found["decide", f"decode-{topic}", "records"] == tp.read_topic(spark, root, topic).count()
        assert found["decide", f"decode-{topic}", "malformed"] == 0


def test_replies_without_a_partner_stream_equals_batch(spark, scratch):
    rows = {S.TOPIC_PAYMENT: [("in", "ACCEPT", 100), ("edge", "ACCEPT", 200), ("late", "ACCEPT", 300), ("never", "REJECT", 400),
                              ("twice", "ACCEPT", 500), ("twice", "ACCEPT", 530)],
            S.TOPIC_STOCK: [("in", "ACCEPT", 103), ("edge", "REJECT", 210), ("late", "ACCEPT", 311), ("other", "ACCEPT", 410), ("twice", "REJECT", 505)]}
    root, found = f"{scratch}/topics", []

    def frame(data):
        return spark.createDataFrame(data, "id string, status string, t long").withColumn("ts", F.timestamp_seconds("t"))

    def send(topic, data, n):
        df = frame(data).withColumn("seq", F.col("t"))
        tp.write_records(tp.envelope(df, topic, F.to_json(F.struct("id", "status")), key="id"), root, f"{topic}-{n}")

    def side(topic):
        return tp.skip_malformed(tp.decode(tp.read_topic_stream(spark, root, topic), S.ORDER_FULL_EVENT))

    def run():
        q = (unmatched_stream(side(S.TOPIC_PAYMENT), side(S.TOPIC_STOCK), R, "1 hour").writeStream
             .foreachBatch(lambda b, n: found.extend((r.id, r.side, r.status, r.ts) for r in b.collect()))
             .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())
        q.awaitTermination()
    for i, t in enumerate((S.TOPIC_PAYMENT, S.TOPIC_STOCK, S.TOPIC_PAYMENT, S.TOPIC_STOCK)):  # partners come in other batches
        send(t, rows[t][:3] if i < 2 else rows[t][3:], i)
        run()
    for i, end in enumerate((10_000, 20_000)):  # time passes: timers fire in the batch after
        for t in rows:
            send(t, [(f"end{i}", "ACCEPT", end)], 9 + i)
        run()
    want = dc.unmatched_replies(frame(rows[S.TOPIC_PAYMENT]), frame(rows[S.TOPIC_STOCK]), R)
    want = sorted((r.id, r.side, r.status, r.ts) for r in want.collect())
    assert sorted(found) == want
    assert [(i, s) for i, s, _, _ in want] == [("late", "PAYMENT"), ("late", "STOCK"), ("never", "PAYMENT"), ("other", "STOCK"), ("twice", "PAYMENT")]
