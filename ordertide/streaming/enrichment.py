"""The enrichment service as a streaming query: orders topic -> decode ->
keep malformed ones in quarantine -> enrich -> one foreachBatch writing every
route."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ordertide import schema as S
from ordertide.config import Limits
from ordertide.operators import enrich as en
from ordertide.operators.quarantine import keep_malformed
from ordertide.plans.routes import route_records
from ordertide.sources import topics as tp


def start_enrichment(spark: SparkSession, root: str, checkpoint: str, lim: Limits,
                     available_now: bool = True) -> StreamingQuery:
    src = tp.read_topic_stream(spark, root, S.TOPIC_ORDERS)
    decoded = tp.decode(src).observe(
        "decode", F.count(F.lit(1)).alias("records"),
        F.count(F.col(S.CORRUPT)).alias("malformed"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # both writes read it
        tp.write_records(route_records(en.enrich(tp.skip_malformed(batch), lim), lim), root, f"enrich-{batch_id:08d}")
        keep_malformed(batch, root, f"enrich-{batch_id:08d}")
        batch.unpersist()
    w = decoded.writeStream.queryName("enrich").foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")
    return w.start()
