"""The whole order flow as streaming queries, driven in rounds.

Each service is its own query with its own checkpoint, reading and writing
file-backed topics (or a broker): enrichment, payment, stock, decision. With
``availableNow`` triggers a round runs every service until it has consumed
what is there; decisions written back to ``orders-full`` are consumed by the
reservation services in the next round (settlement). Because replies are only
sent for NEW orders (the loop guard), two rounds reach a fixed point.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ordertide import schema as S
from ordertide.config import Limits
from ordertide.operators import reservation as rv
from ordertide.operators import routing as rt
from ordertide.operators.enrich import FULL_COLUMNS
from ordertide.operators.keyed_table import KeyedTable
from ordertide.operators.reservation_split import reserve_split
from ordertide.sources import topics as tp
from ordertide.streaming.decision import decisions_stream
from ordertide.streaming.enrichment import start_enrichment
from ordertide.streaming.reservation import STATE_NAME, reserve_stream


def _full_events(spark: SparkSession, root: str, topic: str) -> DataFrame:
    decoded = tp.decode(tp.read_topic_stream(spark, root, topic), S.ORDER_FULL_EVENT)
    decoded = decoded.observe(f"decode-{topic}", F.count(F.lit(1)).alias("records"), F.count(F.col(S.CORRUPT)).alias("malformed"))
    return tp.skip_malformed(decoded)


def _error_records(errs: DataFrame, key: str) -> DataFrame:
    value = F.to_json(F.struct(F.col("error").alias("message")))
    return tp.envelope(errs, S.TOPIC_ERROR, value, key=key)


def start_reservation(spark: SparkSession, root: str, checkpoint: str, side: rv.Side,
                      reply_topic: str) -> StreamingQuery:
    folded = reserve_stream(_full_events(spark, root, S.TOPIC_ORDERS_FULL), side)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        replies = rt.replies(batch)
        value = F.to_json(F.struct(*FULL_COLUMNS))
        records = tp.envelope(replies, reply_topic, value, key="id").unionByName(
            _error_records(batch.filter(F.col("error").isNotNull()), side.key))
        tp.write_records(records, root, f"{side.name}-{batch_id:08d}")
        batch.unpersist()

    return (folded.writeStream.queryName(side.name).foreachBatch(sink).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def balance_table(state: str, side: rv.Side) -> KeyedTable:
    """R4 of ``start_split_reservation``: one row per key, changed by each micro-batch."""
    amount = "decimal(18,2)" if side.money else "int"
    return KeyedTable(state, f"{side.key} string, available {amount}, reserved {amount}", side.key)


def start_split_reservation(spark: SparkSession, root: str, checkpoint: str, side: rv.Side,
                            reply_topic: str, state: str) -> StreamingQuery:
    """R1/R2 on a stream where one key may hold most of a micro-batch: each micro-batch is
    folded by ``reserve_split``, which deals a key's rows over all tasks, from the
    balances that the batches before it left; the balances it changes are one delta of the
    keyed table. A replayed batch reads the table as of the batch before it and so folds
    to the same rows; both its outputs are written once."""
    table = balance_table(state, side)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        folded = reserve_split(batch, side, start=table.read(spark, before=batch_id))
        path = f"{state.rstrip('/')}/folded/{batch_id % 2}"  # read by the next two jobs only
        folded.write.mode("overwrite").parquet(path)
        folded = spark.read.schema(folded.schema).parquet(path)
        value = F.to_json(F.struct(*FULL_COLUMNS))
        records = tp.envelope(rt.replies(folded), reply_topic, value, key="id").unionByName(
            _error_records(folded.filter(F.col("error").isNotNull()), side.key))
        tp.write_records(records, root, f"{side.name}-{batch_id:08d}")
        table.apply(rv.balances(folded, side), batch_id)
        batch.unpersist()

    return (_full_events(spark, root, S.TOPIC_ORDERS_FULL).writeStream.queryName(side.name).foreachBatch(sink)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def start_decision(spark: SparkSession, root: str, checkpoint: str, lim: Limits,
                   watermark: str = "20 seconds") -> StreamingQuery:
    pay = _full_events(spark, root, S.TOPIC_PAYMENT)
    stk = _full_events(spark, root, S.TOPIC_STOCK)
    dec = decisions_stream(pay, stk, lim, watermark)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        ok = batch.filter(F.col("error").isNull())
        value = F.to_json(F.struct(*FULL_COLUMNS))
        records = tp.envelope(ok, S.TOPIC_ORDERS_FULL, value, key="id").unionByName(
            _error_records(batch.filter(F.col("error").isNotNull()), "id"))
        tp.write_records(records, root, f"decide-{batch_id:08d}")
        batch.unpersist()

    return (dec.writeStream.queryName("decide").foreachBatch(sink).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def run_rounds(spark: SparkSession, root: str, checkpoints: str, lim: Limits, rounds: int = 2,
               state: str | None = None) -> None:
    """Drive all services until the decisions have been settled. With ``state``, the
    reservations split hot keys and keep their balances in tables there."""
    pay, stk = rv.payment_side(lim), rv.stock_side(lim)

    def reserve(side: rv.Side, reply_topic: str) -> StreamingQuery:
        if state:
            return start_split_reservation(spark, root, f"{checkpoints}/{side.name}", side, reply_topic, f"{state}/{side.name}")
        return start_reservation(spark, root, f"{checkpoints}/{side.name}", side, reply_topic)
    services = (
        lambda: start_enrichment(spark, root, f"{checkpoints}/enrich", lim),
        lambda: reserve(pay, S.TOPIC_PAYMENT),
        lambda: reserve(stk, S.TOPIC_STOCK),
        lambda: start_decision(spark, root, f"{checkpoints}/decide", lim),
    )
    for _ in range(rounds):
        for start in services:   # one service at a time, each to the end of its input
            start().awaitTermination()


def balances(spark: SparkSession, checkpoint: str, side: rv.Side) -> DataFrame:
    """R4 on a stream: read the reservation state straight from the checkpoint."""
    st = spark.read.format("statestore").option("stateVarName", STATE_NAME).load(checkpoint)
    unit = rv.unit_of(side)

    def back(c):
        v = F.col(f"value.{c}")
        return (v.cast("decimal(20,0)") / F.lit(unit)).cast(S.MONEY) if side.money else v.cast("long")

    return st.select(F.col("key._k").alias(side.key), back("available").alias("available"),
                     back("reserved").alias("reserved"))
