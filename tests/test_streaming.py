"""Streams equal batch on the same input; restarts leave outputs unchanged."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ordertide import TABLE_LIMITS as L
from ordertide import schema as S
from ordertide.operators import enrich as en
from ordertide.operators import reservation as rv
from ordertide.operators import routing as rt
from ordertide.plans import saga
from ordertide.sources import topics as tp
from ordertide.sources.tables import order_events
from ordertide.streaming import saga as ss
from ordertide.streaming.enrichment import start_enrichment


def _ingest(spark, root, parts=3):
    ev = order_events(spark, SF_SMALL)
    for i in range(parts):
        tp.ingest_orders(ev.filter(F.pmod("seq", F.lit(parts)) == i), root, f"ingest-{i}")
    return ev


def test_enrichment_stream_equals_batch_and_restart(spark, scratch):
    root, ck = f"{scratch}/topics", f"{scratch}/ck"
    ev = _ingest(spark, root)
    start_enrichment(spark, root, f"{ck}/enrich", L).awaitTermination()
    batch_ok, _ = rt.split(en.enrich(ev, L))
    got = tp.read_topic(spark, root, S.TOPIC_ORDERS_FULL).select("key")
    assert got.count() == batch_ok.count()
    assert got.exceptAll(batch_ok.select(F.col("id").alias("key"))).count() == 0
    before = tp.read_topic(spark, root, S.TOPIC_VALUABLE).count()
    # restart from the checkpoint: nothing new, nothing duplicated
    start_enrichment(spark, root, f"{ck}/enrich", L).awaitTermination()
    assert tp.read_topic(spark, root, S.TOPIC_VALUABLE).count() == before
    assert tp.read_topic(spark, root, S.TOPIC_ORDERS_FULL).count() == got.count()


def test_a_replayed_batch_reserves_once(spark, scratch):
    """The enrichment's last commit is lost and its batch replayed; the payment
    service, run again, sends no second reply and reserves nothing twice."""
    import glob
    import os
    root, ck = f"{scratch}/topics", f"{scratch}/ck"
    _ingest(spark, root)
    pay = rv.payment_side(L)

    def run_both():
        start_enrichment(spark, root, f"{ck}/enrich", L).awaitTermination()
        q = ss.start_reservation(spark, root, f"{ck}/payment", pay, S.TOPIC_PAYMENT)
        q.awaitTermination()
        replies = tp.read_topic(spark, root, S.TOPIC_PAYMENT).select("key", "value").collect()
        return sorted(replies), sorted(ss.balances(spark, f"{ck}/payment", pay).collect())
    before = run_both()
    last = max((f for f in glob.glob(f"{ck}/enrich/commits/*") if os.path.basename(f).isdigit()), key=lambda f: int(os.path.basename(f)))
    for f in (last, os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc")):
        if os.path.exists(f):
            os.remove(f)
    assert run_both() == before and len(before[0]) == len({r.key for r in before[0]})


def test_malformed_and_tombstone(spark, scratch):
    root = f"{scratch}/topics"
    recs = spark.createDataFrame(
        [("x", "test", "orders", 0, 1, None), ("y", None, "orders", 0, 2, None),
         ("z", '{"id":"z","marketId":"m","customerId":"c","products":[{"id":"1","name":"a","price":2000}]}',
          "orders", 0, 3, None)], S.ENVELOPE).withColumn("timestamp", F.current_timestamp())
    tp.write_records(recs, root, "ingest-0")
    start_enrichment(spark, root, f"{scratch}/ck", L).awaitTermination()
    assert [r.key for r in tp.read_topic(spark, root, S.TOPIC_ORDERS_FULL).collect()] == ["z"]
    errs = [(r.key, r.value) for r in tp.read_topic(spark, root, S.TOPIC_ERROR).collect()]
    assert errs == [("y", '{"message":"order is null"}')]


def test_stream_saga_equals_batch_saga(spark, scratch):
    root, ck = f"{scratch}/topics", f"{scratch}/ck"
    ev = _ingest(spark, root)
    ss.run_rounds(spark, root, ck, L, rounds=2)
    ok, _ = rt.split(en.enrich(ev, L))
    b = saga.run(ok, L, delays=None)
    # decisions
    dec = tp.skip_malformed(tp.decode(tp.read_topic(spark, root, S.TOPIC_ORDERS_FULL), S.ORDER_FULL_EVENT))
    dec = dec.filter(F.col("status") != S.NEW).select("id", "status", "source")
    bd = rt.split(b.decisions)[0].select("id", "status", "source")
    assert dec.count() == bd.count() and dec.exceptAll(bd).count() == 0
    # another round after the fixed point writes nothing new
    sizes = {t: tp.read_topic(spark, root, t).count() for t in (S.TOPIC_ORDERS_FULL, S.TOPIC_PAYMENT, S.TOPIC_STOCK)}
    ss.run_rounds(spark, root, ck, L, rounds=1)
    assert sizes == {t: tp.read_topic(spark, root, t).count() for t in sizes}
    # settled balances read from the stream's state store
    for side, name in ((rv.payment_side(L), "payment"), (rv.stock_side(L), "stock")):
        stream_bal = ss.balances(spark, f"{ck}/{name}", side)
        batch_bal = b.settled(side).select(side.key, "available", "reserved")
        assert stream_bal.count() == batch_bal.count()
        assert stream_bal.exceptAll(batch_bal).count() == 0


def test_decision_stream_window(spark, scratch):
    """J1 on streams: in window, on the 10 s boundary, 15 s apart, other key."""
    from ordertide import REFERENCE_LIMITS as R
    from ordertide.operators.enrich import FULL_COLUMNS
    from ordertide.streaming.decision import decisions_stream
    root = f"{scratch}/topics"

    def replies(topic, rows):
        df = spark.createDataFrame(rows, "id string, status string, t long")
        df = (df.withColumn("marketId", F.lit("m")).withColumn("customerId", F.lit("c"))
              .withColumn("productCount", F.lit(1)).withColumn("price", F.lit(10).cast("decimal(18,2)"))
              .withColumn("products", F.array().cast("array<struct<id:string,name:string,price:decimal(18,2)>>"))
              .withColumn("source", F.lit(None).cast("string"))
              .withColumn("ts", F.timestamp_seconds("t")).withColumn("seq", F.col("t")))
        tp.write_records(tp.envelope(df, topic, F.to_json(F.struct(*FULL_COLUMNS)), key="id"), root, topic)

    replies(S.TOPIC_PAYMENT, [("in", "ACCEPT", 100), ("edge", "ACCEPT", 200), ("out", "ACCEPT", 300),
                              ("one", "ACCEPT", 400)])
    replies(S.TOPIC_STOCK, [("in", "ACCEPT", 103), ("edge", "REJECT", 210), ("out", "ACCEPT", 315),
                            ("two", "ACCEPT", 400)])

    def side(topic):
        return tp.skip_malformed(tp.decode(tp.read_topic_stream(spark, root, topic), S.ORDER_FULL_EVENT))

    got = {}

    def sink(batch, batch_id):
        for r in batch.collect():
            got[r.id] = (r.status, r.source)

    q = (decisions_stream(side(S.TOPIC_PAYMENT), side(S.TOPIC_STOCK), R).writeStream.foreachBatch(sink)
         .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    assert got == {"in": (S.CONFIRMED, None), "edge": (S.ROLLBACK, S.STOCK)}


def test_hot_market_stream_equals_batch_and_restarts(spark, scratch):
    """R1/R2 with a market that has nine tenths of each micro-batch: rows and balances as
    in batch, in the table as of each batch, and after a lost commit."""
    import glob
    import os
    from ordertide.operators.enrich import FULL_COLUMNS
    root, ck, state = f"{scratch}/topics", f"{scratch}/ck", f"{scratch}/state"
    side = rv.stock_side(L.with_(initial_items=2500))
    ok, _ = rt.split(en.enrich(order_events(spark, SF_SMALL), L))
    hot = ok.withColumn("marketId", F.when(F.col("seq") % 10 != 0, "hot").otherwise(F.col("marketId"))).withColumn("source", F.lit(None).cast("string"))
    hot = hot.withColumn("ts", F.timestamp_seconds("seq"))  # batches come in order of time
    cuts = [0, *hot.approxQuantile("seq", [0.3, 0.6], 0.0), 10**9]
    parts = [hot.where((F.col("seq") > a) & (F.col("seq") <= b)) for a, b in zip(cuts, cuts[1:])]
    table = ss.balance_table(state, side)
    done = None

    def run():
        ss.start_split_reservation(spark, root, ck, side, S.TOPIC_STOCK, state).awaitTermination()
        replies = tp.skip_malformed(tp.decode(tp.read_topic(spark, root, S.TOPIC_STOCK), S.ORDER_FULL_EVENT))
        return sorted(tuple(r) for r in replies.select("id", "status").collect()), sorted(tuple(r) for r in table.read(spark).collect())
    for i, part in enumerate(parts):
        tp.write_records(tp.envelope(part, S.TOPIC_ORDERS_FULL, F.to_json(F.struct(*FULL_COLUMNS)), key="id"), root, i)
        done = part if done is None else done.unionByName(part)
        found = run()
        want = rv.reserve(done.withColumn("ts", F.col("ts").cast("timestamp_ntz")), side)
        assert found[0] == sorted(tuple(r) for r in rt.replies(want).select("id", "status").collect())
        assert found[1] == sorted(tuple(r) for r in rv.balances(want, side).select("marketId", "available", "reserved").collect())
        assert {"ACCEPT", "REJECT"} <= {s for _, s in found[0]} or i == 0
    history = {r.batch: r.available for r in table.history(spark).where("marketId = 'hot'").collect()}
    assert list(sorted(history)) == [0, 1, 2] and history[0] > history[1] >= history[2]
    last = max((f for f in glob.glob(f"{ck}/commits/*") if os.path.basename(f).isdigit()), key=lambda f: int(os.path.basename(f)))
    for f in (last, os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc")):
        if os.path.exists(f):
            os.remove(f)
    assert run() == found


def test_split_stream_saga_equals_batch_saga(spark, scratch):
    root, ck, state = f"{scratch}/topics", f"{scratch}/ck", f"{scratch}/state"
    ev = _ingest(spark, root, parts=1)
    ss.run_rounds(spark, root, ck, L, rounds=2, state=state)
    ok, _ = rt.split(en.enrich(ev, L))
    b = saga.run(ok, L, delays=None)
    for side in (rv.payment_side(L), rv.stock_side(L)):
        found = ss.balance_table(f"{state}/{side.name}", side).read(spark).select(side.key, "available", "reserved")
        want = b.settled(side).select(side.key, "available", "reserved")
        assert found.count() == want.count() and sorted(map(str, found.collect())) == sorted(str(r) for r in want.select(side.key, *[F.col(c).cast(found.schema[c].dataType) for c in ("available", "reserved")]).collect())
