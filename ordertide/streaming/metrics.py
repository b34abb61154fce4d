"""P8 kept: the counts that the services observe, one row per batch and observation.

Spark reports what ``observe`` counted when a micro-batch ends. The listener writes it to a
small file named after service and batch, without a Spark job; a replayed batch
overwrites its file. The folder is a table.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = "service string, batch long, observation string, metric string, value long, at string"


class ObservedCounts(StreamingQueryListener):
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        rows = [{"service": p.name, "batch": p.batchId, "observation": name, "metric": metric, "value": value, "at": p.timestamp}
                for name, row in sorted(p.observedMetrics.items()) for metric, value in row.asDict().items()]
        if not rows or not p.numInputRows:
            return  # an idle trigger repeats nothing
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{p.name}-{p.batchId:012d}.json")
        out = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).create(path, True)
        out.write(bytearray("".join(json.dumps(r) + "\n" for r in rows).encode()))
        out.close()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def observed(spark: SparkSession, folder: str) -> DataFrame:
    """service, batch, observation, metric, value, at."""
    return spark.read.schema(SCHEMA).json(folder)
