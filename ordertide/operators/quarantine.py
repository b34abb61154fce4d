"""Malformed records kept (S3): where they came from, why they failed, and their replay.

What ``skip_malformed`` drops goes to a quarantine of committed batches beside the
topics, with topic, partition and offset. ``reingest`` puts corrected records back into
their topic at their old place; which ones are back is read from the topic itself, so a
record returns once, whatever fails in between.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide import schema as S
from ordertide.operators import commits
from ordertide.sources import topics as tp

KIND, REPLAY = "quarantine", "replay"
PLACE = ["topic", "partition", "offset"]
SCHEMA = "topic string, partition int, offset long, key string, timestamp timestamp, value string, reason string"


def quarantine_rows(decoded: DataFrame) -> DataFrame:
    """The malformed rows of ``decode``: their place, raw value and reason."""
    reason = F.lit("unreadable")
    for name, allowed in tp.ALLOWED.items():
        if name in decoded.columns:
            reason = F.when(F.col(name).isNotNull() & ~F.col(name).isin(*allowed), F.concat(F.lit(f"unknown {name}: "), F.col(name))).otherwise(reason)
    return tp.malformed(decoded).select("topic", "partition", F.col("seq").alias("offset"), "key", F.col("ts").alias("timestamp"),
                                        F.col(S.CORRUPT).alias("value"), reason.alias("reason"))


def keep_malformed(decoded: DataFrame, root: str, batch: str) -> bool:
    """Writes the malformed rows of a batch, once."""
    return commits.write_once(decoded.sparkSession, root, KIND, batch, quarantine_rows(decoded).write.parquet)


def quarantined(spark: SparkSession, root: str) -> DataFrame:
    """All records ever kept, and whether a corrected one is back in its topic."""
    done = [commits.data_folder(root, KIND, b, a) for b, a in commits.committed(spark, root, KIND).items()]
    kept = spark.read.schema(SCHEMA).parquet(*done) if done else spark.createDataFrame([], SCHEMA)
    back = tp.read_log(spark, root).where(F.col("batch").startswith(f"{REPLAY}-")).select(*PLACE).distinct()
    return kept.join(back.withColumn("_back", F.lit(True)), PLACE, "left").withColumn("replayed", F.coalesce("_back", F.lit(False))).drop("_back")


def reingest(spark: SparkSession, root: str, correct: Callable[[DataFrame], DataFrame], job: int, schema=S.ORDER_EVENT) -> bool:
    """Puts records that ``correct`` mends back into their topics. It gets the open rows and
    returns them with new values; those that are still malformed stay in quarantine.
    ``job`` names the run: a run that is there already does nothing (False)."""
    fixed = correct(quarantined(spark, root).where("not replayed").drop("replayed"))
    # of one place's records one returns
    fixed = fixed.groupBy(*PLACE).agg(F.min(F.struct("key", "value", "timestamp")).alias("r")).select("r.*", *PLACE)
    checked = tp.decode(fixed.withColumn("topic", F.col("topic")), schema)
    good = tp.skip_malformed(checked).where("not value_null").select(*PLACE[:2], F.col("seq").alias("offset"))
    records = fixed.join(good, PLACE, "left_semi").select(*S.ENVELOPE.fieldNames())
    return tp.write_records(records, root, f"{REPLAY}-{commits.number(job)}")
