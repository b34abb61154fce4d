"""Observation counts, streaming latest table, relational sink."""

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from conftest import orders_df
from ordertide import REFERENCE_LIMITS as L
from ordertide.operators import enrich as en
from ordertide.operators import commits
from ordertide.operators import tables as tb
from ordertide.operators.observe import observe
from ordertide.streaming.latest import latest_stream


def test_observe_counts(spark):
    df, obs = observe(spark.range(17).toDF("x"), "points")
    assert df.filter("x > 3").count() == 13
    assert obs.get["rows"] == 17


def test_latest_stream(spark, scratch):
    src = f"{scratch}/src"
    spark.createDataFrame([("a", "v1", 1, 1), ("b", "w", 1, 2)], "key string, value string, ts long, seq long") \
        .write.parquet(f"{src}/0")
    spark.createDataFrame([("a", "v2", 2, 3)], "key string, value string, ts long, seq long").write.parquet(f"{src}/1")
    stream = spark.readStream.schema("key string, value string, ts long, seq long") \
        .option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(src)
    out = latest_stream(stream)
    rows = {}

    def sink(batch, batch_id):
        for r in batch.collect():
            rows[r.key] = r.value

    q = (out.writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    assert rows == {"a": "v2", "b": "w"}


def test_event_tables_sink(spark, scratch):
    orders = orders_df(spark, [("o1", "m", "c", [10, 20]), ("o2", None, "c", [5])])
    full = en.enrich(orders, L)
    wid = F.col("id")
    events = tb.event_rows(full, wid)
    products = tb.product_rows_from_array(full, wid)
    assert tb.write_event_tables(events, products, scratch, 0)
    assert not tb.write_event_tables(events, products, scratch, 0)  # replay: nothing is written again
    ev, pr = tb.read_event_tables(spark, scratch)
    assert [r.event_id for r in ev.collect()] == ["o1"]
    assert sorted(float(r.price) for r in pr.collect()) == [10.0, 20.0]
    assert set(pr.columns) >= {"name", "price", "event_id"} and "id" not in pr.columns


def test_a_null_product_name_leaves_neither_row(spark, scratch):
    """The whole transaction fails with one of its rows."""
    events = spark.createDataFrame([("e1", "m", "c", 2, 5), ("e2", "m", "c", 1, 5), ("e3", "m", None, 0, 5)],
                                   "event_id string, market_id string, customer_id string, product_count int, price int").withColumn("price", F.col("price").cast("decimal(18,2)"))
    products = spark.createDataFrame([("a", 2, "e1"), (None, 3, "e1"), ("b", 5, "e2")], "name string, price int, event_id string")
    products = products.withColumn("price", F.col("price").cast("decimal(18,2)"))
    found = {r.event_id: r.violations for r in tb.checked_events(events, products).collect()}
    assert found == {"e1": ["product.name"], "e2": [], "e3": ["customer_id"]}
    tb.write_event_tables(events, products, scratch, 3)
    ev, pr = tb.read_event_tables(spark, scratch)
    assert [r.event_id for r in ev.collect()] == ["e2"] and [r.event_id for r in pr.collect()] == ["e2"]


@pytest.mark.parametrize("killed_at", ["event", "product", "commit"])
def test_a_kill_between_the_writes_leaves_neither_table(spark, scratch, monkeypatch, killed_at):
    orders = en.enrich(orders_df(spark, [("o1", "m", "c", [10, 20]), ("o2", "m", "c", [5])]), L)
    events, products = tb.event_rows(orders, F.col("id")), tb.product_rows_from_array(orders, F.col("id"))
    tb.write_event_tables(events.limit(0), products.limit(0), scratch, 0)

    class Killed(Exception):
        pass
    def dying(*_):
        raise Killed
    if killed_at == "commit":
        monkeypatch.setattr(commits, "commit", dying)
    else:  # at the write of one table
        whole = DataFrameWriter.parquet
        monkeypatch.setattr(DataFrameWriter, "parquet", lambda w, path, *a, **k: dying() if path.endswith(killed_at) else whole(w, path, *a, **k))
    with pytest.raises(Killed):
        tb.write_event_tables(events, products, scratch, 1)
    monkeypatch.undo()
    assert [t.count() for t in tb.read_event_tables(spark, scratch)] == [0, 0]
    assert tb.write_event_tables(events, products, scratch, 1)  # the batch is run again
    assert [t.count() for t in tb.read_event_tables(spark, scratch)] == [2, 3]


def test_event_tables_as_a_stream(spark, scratch):
    """Valuable orders of a topic into both tables; a restart writes nothing twice."""
    from ordertide import schema as S
    from ordertide.operators.enrich import FULL_COLUMNS
    from ordertide.sources import topics as tp
    root = f"{scratch}/topics"
    for i in range(3):
        full = en.enrich(orders_df(spark, [(f"o{i}{j}", "m" if j else None, "c", [10, 20]) for j in range(3)]), L).withColumn("source", F.lit(None).cast("string"))
        tp.write_records(tp.envelope(full, S.TOPIC_VALUABLE, F.to_json(F.struct(*FULL_COLUMNS)), key="id"), root, i)
        src = tp.skip_malformed(tp.decode(tp.read_topic_stream(spark, root, S.TOPIC_VALUABLE), S.ORDER_FULL_EVENT))
        (src.writeStream.foreachBatch(tb.event_table_sink(f"{scratch}/tables")).option("checkpointLocation", f"{scratch}/ck")
         .trigger(availableNow=True).start().awaitTermination())
        ev, pr = tb.read_event_tables(spark, f"{scratch}/tables")
        assert (ev.count(), ev.distinct().count(), pr.count()) == (2 * (i + 1), 2 * (i + 1), 4 * (i + 1))


def test_publish_batch_job(spark, scratch):
    """The whole flow as one batch job; outputs agree with the registered queries."""
    from ordertide.plans import queries as Q
    from ordertide.plans.publish import run_batch
    sf = "/root/testdata/sf0.001"
    paths = run_batch(spark, sf, scratch)
    dec = spark.read.parquet(paths["decisions"])
    assert dec.count() == Q.q_order_decisions(spark, sf).count()
    bal = spark.read.parquet(paths["stock_balance"]).select("marketId", "available", "reserved", "settled")
    want = Q.q_settled_stock(spark, sf)
    assert bal.exceptAll(want).count() == 0 and want.exceptAll(bal).count() == 0
    errs = spark.read.parquet(paths["errors"])
    assert errs.count() == Q.q_error_topic(spark, sf).count()


def test_unknown_names_are_malformed(spark):
    from ordertide import schema as S
    from ordertide.sources import topics as tp
    values = ['{"id": "1", "status": "NEW"}', '{"id": "2", "status": "SHIPPED"}', '{"id": "3", "status": "ROLLBACK", "source": "BANK"}',
              "no json", None]
    recs = spark.createDataFrame([(str(i), v, "t", 0, i, None) for i, v in enumerate(values)], S.ENVELOPE)
    decoded = tp.decode(recs, S.ORDER_FULL_EVENT)
    assert sorted(r.key for r in tp.malformed(decoded).collect()) == ["1", "2", "3"]
    assert sorted(r.key for r in tp.skip_malformed(decoded).collect()) == ["0", "4"]


def test_a_replayed_batch_is_left_in_place(spark, scratch):
    import glob

    from ordertide import schema as S
    from ordertide.sources import topics as tp
    recs = spark.createDataFrame([("k", "v", "t", 0, 1, None)], S.ENVELOPE)
    tp.write_records(recs, scratch, "w-0")
    files = sorted(glob.glob(f"{scratch}/log/**/*.parquet", recursive=True))
    tp.write_records(recs, scratch, "w-0")
    assert files and sorted(glob.glob(f"{scratch}/log/**/*.parquet", recursive=True)) == files
    assert tp.read_topic(spark, scratch, "t").count() == 1


def test_served_latest_table_with_deletes(spark, scratch):
    from ordertide import schema as S
    from ordertide.sources import topics as tp
    from ordertide.streaming.latest import served, start_latest

    def put(batch, rows):
        recs = spark.createDataFrame([(k, v, "t", 0, i, None) for i, k, v in rows], S.ENVELOPE)
        tp.write_records(recs.withColumn("timestamp", F.timestamp_seconds("offset")), scratch, batch)
        stream = tp.read_topic_stream(spark, scratch, "t").select(
            "key", "value", F.col("timestamp").alias("ts"), F.col("offset").alias("seq"), F.col("value").isNull().alias("value_null"))
        start_latest(stream, f"{scratch}/latest", f"{scratch}/ck").awaitTermination()
        return sorted((r.key, r.value) for r in served(spark, f"{scratch}/latest").collect())
    assert put("0", [(1, "a", "1"), (2, "b", "2"), (3, "a", "3")]) == [("a", "3"), ("b", "2")]
    assert put("1", [(4, "a", None), (5, "c", "5")]) == [("b", "2"), ("c", "5")]
    assert put("2", [(6, "a", "6")]) == [("a", "6"), ("b", "2"), ("c", "5")]
