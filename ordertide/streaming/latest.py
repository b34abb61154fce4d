"""K1 on a stream: a streaming aggregation keeping one row per key.

``max_by`` runs as a stateful aggregate: the state store holds the latest
record per key, and update mode emits the keys changed by each micro-batch.
``start_latest`` puts them into a keyed table (base and deltas, merged by
bucket) and ``served`` reads it; tombstones delete.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertide.operators import commits
from ordertide.operators.keyed_table import BATCH, BUCKET, DELETED, KeyedTable


def latest_stream(records: DataFrame, key: str = "key", order: Sequence[str] = ("ts", "seq")) -> DataFrame:
    cols = [c for c in records.columns if c != key]
    return (records.groupBy(key)
            .agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("_latest"))
            .select(key, "_latest.*"))


def latest_table(schema: T.StructType, root: str, key: str = "key", buckets: int = 16, merge_every: int = 8) -> KeyedTable:
    """The served table of records of ``schema``."""
    return KeyedTable(root, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields), key, buckets, merge_every)


def start_latest(records: DataFrame, root: str, checkpoint: str, key: str = "key",
                 order: Sequence[str] = ("ts", "seq"), tombstone: str | None = "value_null", **table):
    """K1 as a service: the latest records of each micro-batch's keys are one delta of the
    table at ``root``; a tombstone takes its key out. A replayed batch changes nothing, a
    reader sees a batch whole or not at all, and the files stay bounded (``KeyedTable``)."""
    served_ = latest_table(records.schema, root, key, **table)

    def sink(batch: DataFrame, batch_id: int) -> None:
        if tombstone:
            batch = batch.withColumn(DELETED, F.coalesce(F.col(tombstone), F.lit(False)))
        served_.apply(batch.select(*records.columns, *([DELETED] if tombstone else [])), batch_id)
    return (latest_stream(records, key, order).writeStream.outputMode("update").foreachBatch(sink)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def served_table(spark: SparkSession, root: str, key: str = "key") -> KeyedTable:
    """The table at ``root``, its columns read from the newest batch."""
    there = commits.committed(spark, root, "delta")
    batch = max(there)
    schema = spark.read.parquet(commits.data_folder(root, "delta", batch, there[batch])).schema
    return latest_table(T.StructType([f for f in schema.fields if f.name not in (DELETED, BATCH, BUCKET)]), root, key)


def served(spark: SparkSession, root: str, key: str = "key") -> DataFrame:
    """The current table: the latest row of each key, without the keys whose latest record
    is a tombstone."""
    return served_table(spark, root, key).read(spark)
