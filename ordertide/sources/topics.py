"""Topics as DataFrames.

A topic record has the columns of Spark's Kafka source
(key, value, topic, partition, offset, timestamp). Without a broker the
topics live in a folder: each writing batch is a folder with one sub-folder per
topic, visible once the batch is committed (``operators.commits``). Batch jobs
read it with Spark's Parquet reader, streams through the data source of
``topic_log``; with a broker the same functions take the frame returned by
``read_kafka``.

Decoding always uses an explicit schema; JSON is never inferred. Within a key
records are ordered by (timestamp, offset); the decoded frames name these
``ts`` and ``seq``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertide import schema as S
from ordertide.operators import commits
from ordertide.sources.topic_log import TopicLog

#: Allowed names of enum-like fields.
ALLOWED = {"status": S.STATUSES, "source": S.SOURCES}
#: Partitions of a file-backed topic.
PARTITIONS = 3


LOG = "log"  # of commits and data of topic records


def read_log(spark: SparkSession, root: str) -> DataFrame:
    """Committed records of all file-backed topics, with the folder name of their ``batch``;
    a filter on ``_topic`` or ``batch`` prunes folders."""
    schema = T.StructType([*S.ENVELOPE.fields, T.StructField("batch", T.StringType()), T.StructField("_topic", T.StringType())])
    done = commits.committed(spark, root, LOG)
    if not done:
        return spark.createDataFrame([], schema)
    folders = [commits.data_folder(root, LOG, b, a) for b, a in done.items()]
    return spark.read.option("basePath", f"{root.rstrip('/')}/{LOG}").schema(schema).parquet(*folders)


def read_topic(spark: SparkSession, root: str, topic: str) -> DataFrame:
    """S1 (batch): all committed records of a file-backed topic, by Spark's own reader."""
    return read_log(spark, root).where(F.col("_topic") == topic).drop("batch", "_topic")


def read_topic_stream(spark: SparkSession, root: str, topic: str, batches_per_trigger: int | None = None) -> DataFrame:
    """S1 (stream): records of a file-backed topic as their batches are committed, by the
    data source of ``topic_log``."""
    spark.dataSource.register(TopicLog)
    r = spark.readStream.format(TopicLog.name()).option("path", root).option("topic", topic)
    if batches_per_trigger:
        r = r.option("batchesPerTrigger", str(batches_per_trigger))
    return r.load()


def read_kafka(spark: SparkSession, servers: str, topic: str, isolation: str = "read_committed",
               stream: bool = True) -> DataFrame:
    """S1 against a broker (needs the Kafka connector on the classpath).

    ``isolation`` maps to the consumer's ``isolation.level`` (X3).
    """
    r = spark.readStream if stream else spark.read
    return (r.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("kafka.isolation.level", isolation)
            .option("startingOffsets", "earliest")
            .load()
            .select(F.col("key").cast("string"), F.col("value").cast("string"), "topic",
                    "partition", "offset", "timestamp"))


def write_kafka(records: DataFrame, servers: str, checkpoint: str | None = None):
    """S4 against a broker: key/value records to the topic named in ``topic``.

    Spark's Kafka sink is at-least-once: a replayed micro-batch can write its
    records again, so readers de-duplicate on (key, offset of the source) or
    the idempotent file sink (``write_records``) is used instead.
    """
    out = records.select("key", "value", "topic")
    if out.isStreaming:
        return (out.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
                .option("checkpointLocation", checkpoint).start())
    out.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
    return None


def decode(records: DataFrame, schema=S.ORDER_EVENT) -> DataFrame:
    """Parse ``value`` with an explicit schema.

    Result: key, ts, seq, topic, partition, the schema's fields, ``value_null``
    (a tombstone) and the corrupt-record column (set for malformed values).
    """
    parsed = F.from_json("value", S.with_corrupt(schema),
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": S.CORRUPT})
    rows = records.select(
        "key", F.col("timestamp").alias("ts"), F.col("offset").alias("seq"), "topic", "partition", "value",
        F.col("value").isNull().alias("value_null"), parsed.alias("_r"),
    ).select("key", "ts", "seq", "topic", "partition", "value", "value_null", "_r.*")
    unknown = F.lit(False)  # a name outside the fixed values is malformed, like unreadable JSON
    for name, allowed in ALLOWED.items():
        if name in schema.fieldNames():
            unknown = unknown | (F.col(name).isNotNull() & ~F.col(name).isin(*allowed))
    return rows.withColumn(S.CORRUPT, F.when(unknown, F.col("value")).otherwise(F.col(S.CORRUPT))).drop("value")


def skip_malformed(decoded: DataFrame) -> DataFrame:
    """S3: drop records whose value did not parse (tombstones are kept)."""
    return decoded.filter(F.col(S.CORRUPT).isNull()).drop(S.CORRUPT)


def malformed(decoded: DataFrame) -> DataFrame:
    """S3: the records that ``skip_malformed`` drops."""
    return decoded.filter(F.col(S.CORRUPT).isNotNull())


def encode(df: DataFrame, fields: Sequence[str], key: Column | str = "key") -> Column:
    """The JSON value of a record made of ``fields``."""
    return F.to_json(F.struct(*fields))


def envelope(df: DataFrame, topic: str | Column, value: Column, key: Column | str = "key",
             ts: Column | str = "ts", seq: Column | str = "seq") -> DataFrame:
    """Rows -> topic records. A key's records are in one of the topic's partitions."""
    key_c = F.col(key) if isinstance(key, str) else key
    topic_c = F.lit(topic) if isinstance(topic, str) else topic
    ts_c = F.col(ts) if isinstance(ts, str) else ts
    seq_c = F.col(seq) if isinstance(seq, str) else seq
    return df.select(
        key_c.cast("string").alias("key"),
        value.alias("value"),
        topic_c.alias("topic"),
        F.pmod(F.xxhash64(key_c.cast("string")), F.lit(PARTITIONS)).cast("int").alias("partition"),
        seq_c.cast("long").alias("offset"),
        ts_c.cast("timestamp").alias("timestamp"),
    )


def write_records(records: DataFrame, root: str, batch_id: int | str) -> bool:
    """Write topic records of one batch, each to its topic's folder, in one job.

    The batch is visible in all its topics at once when it is committed (X7). A batch id
    that is there already is left as it is (False): a replayed batch has the same rows.
    ``batch_id``: a writer's name and a number that grows, like ``payment-00000007``;
    a number alone is a writer without a name."""
    named = records.withColumn("_topic", F.col("topic"))
    return commits.write_once(records.sparkSession, root, LOG, str(batch_id), named.write.partitionBy("_topic").parquet)


def ingest_orders(orders: DataFrame, root: str, batch_id: int | str = 0) -> None:
    """Write order rows (id, marketId, customerId, products, ts, seq) to
    the ``orders`` topic, key = order id."""
    value = encode(orders, ["id", "marketId", "customerId", "products"])
    write_records(envelope(orders, S.TOPIC_ORDERS, value, key="id"), root, batch_id)
