"""Topics on files: commits, the streaming source, restarts."""

import os

import pytest
from pyspark.sql import functions as F

from ordertide import schema as S
from ordertide.operators import commits
from ordertide.sources import topics as tp
from ordertide.sources.topic_log import TopicLogReader, writer_of


def records(spark, rows, topic="t"):
    df = spark.createDataFrame(rows, "k string, v string, seq long").withColumn("ts", F.timestamp_seconds("seq"))
    return tp.envelope(df, topic, F.col("v"), key="k")


def consume(spark, root, out, ck, **kw):
    """Everything that is there, as the sink gets it: batch id -> values."""
    seen = {}

    def sink(batch, n):
        seen[n] = sorted(r.value for r in batch.collect())
        batch.write.mode("overwrite").parquet(f"{out}/n={n}")
    q = tp.read_topic_stream(spark, root, "t", **kw).writeStream.foreachBatch(sink).option("checkpointLocation", ck)
    q.trigger(availableNow=True).start().awaitTermination()
    return seen


def test_rows_arrive_once_over_restarts(spark, scratch):
    root, ck = f"{scratch}/root", f"{scratch}/ck"
    tp.write_records(records(spark, [("a", "1", 1), ("b", "2", 2)]), root, "w-0")
    tp.write_records(records(spark, [("a", "x", 1)], topic="other"), root, "w-1")
    assert list(consume(spark, root, scratch, ck).values()) == [["1", "2"]]
    assert [v for v in consume(spark, root, scratch, ck).values() if v] == []
    tp.write_records(records(spark, [("a", "3", 3)]), root, "v-0")  # another writer
    tp.write_records(records(spark, [("c", "4", 4)]), root, "w-10")
    assert not tp.write_records(records(spark, [("c", "5", 4)]), root, "w-10")  # replayed
    assert [v for v in consume(spark, root, scratch, ck).values() if v] == [["3", "4"]]
    stream = tp.read_topic(spark, root, "t")
    assert sorted(r.value for r in stream.collect()) == ["1", "2", "3", "4"] and stream.schema == S.ENVELOPE
    parts = {r.key: r.partition for r in stream.collect()}
    assert set(parts.values()) <= set(range(tp.PARTITIONS))
    assert {r.n for r in stream.groupBy("key").agg(F.countDistinct("partition").alias("n")).collect()} == {1}


def test_uncommitted_and_aborted_batches_are_never_read(spark, scratch, monkeypatch):
    root = f"{scratch}/root"

    def lost(*_):
        raise KeyboardInterrupt  # the driver dies: nothing is tidied up
    with monkeypatch.context() as m:
        m.setattr(commits, "commit", lost)
        with pytest.raises(KeyboardInterrupt):
            tp.write_records(records(spark, [("a", "1", 1)]), root, "w-0")
    assert os.listdir(f"{root}/log") and tp.read_topic(spark, root, "t").count() == 0
    bad = records(spark, [("a", "1", 1)]).withColumn("value", F.raise_error(F.lit("no")))
    with pytest.raises(Exception, match="no"):
        tp.write_records(bad, root, "w-1")
    assert len(os.listdir(f"{root}/log")) == 1  # an aborted batch leaves nothing
    assert [v for v in consume(spark, root, scratch, f"{scratch}/ck").values() if v] == []
    assert tp.write_records(records(spark, [("a", "2", 1)]), root, "w-0")
    assert [v for v in consume(spark, root, scratch, f"{scratch}/ck").values() if v] == [["2"]]


def test_positions_and_admission(spark, scratch):
    for w, n in (("w", 0), ("w", 1), ("w", 2), ("v", 5), ("", 3)):
        tp.write_records(records(spark, [("a", f"{w}{n}", 1)]), scratch, f"{w}-{n:04d}" if w else n)
    reader = TopicLogReader(scratch, "t", 1)
    assert reader.latestOffset() == {"": 3, "v": 5, "w": 2}  # where it stands isn't known yet
    reader = TopicLogReader(scratch, "t", 1)
    reader.partitions({}, {"w": 0})
    assert reader.latestOffset() == {"": 3, "v": 5, "w": 1} and reader.latestOffset() == {"": 3, "v": 5, "w": 2}
    files = reader.partitions({"w": 0}, {"w": 2})
    assert sorted(v for p in files for b in reader.read(p) for v in b.column(1).to_pylist()) == ["w1", "w2"]
    assert writer_of("payment-00000007") == ("payment", 7) and writer_of("3") == ("", 3)
    assert writer_of("backfill") == ("backfill", 0)


def test_nothing_there(spark, scratch):
    assert tp.read_topic(spark, f"{scratch}/none", "t").collect() == []
    assert [v for v in consume(spark, f"{scratch}/none", scratch, f"{scratch}/ck").values() if v] == []
