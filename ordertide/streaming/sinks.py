"""Idempotent micro-batch sinks.

``foreachBatch`` hands every micro-batch with its id; output goes to a folder
named by (writer, batch id), which appears by one rename when it is whole and is
never written again. A batch replayed after a failure (same id, same input thanks
to the checkpoint) finds its folder and leaves it, so a service that follows new
files downstream gets each record once. Spark's own Kafka
sink is at-least-once; consumers of a broker topic must de-duplicate on
(key, offset) or the writer must be transactional.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ordertide.sources import topics as tp


def topic_sink(root: str, writer: str, to_records: Callable[[DataFrame], DataFrame]):
    """foreachBatch function: records of the batch -> topic folders under root."""
    def run(batch: DataFrame, batch_id: int) -> None:
        tp.write_records(to_records(batch), root, f"{writer}-{batch_id:08d}")
    return run
