"""Latest value per key as a table (K1), its scan (K2) and point lookups (K3).

K1 is ``max_by(record, (ts, seq))`` per key. ``max_by`` is a declarative
aggregate, so Spark aggregates partially before the shuffle: a hot key costs
one row per map task, never a whole group in one place. A null value (a
tombstone) wins like any record and then deletes the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(records: DataFrame, key: str = "key", order: Sequence[str] = ("ts", "seq"),
           tombstone: str | None = None) -> DataFrame:
    """K1: one row per key with the columns of its latest record.

    ``tombstone`` names a boolean column marking a deleting (null-valued)
    record; keys whose latest record is a tombstone are dropped.
    """
    cols = [c for c in records.columns if c != key]
    agg = records.groupBy(key).agg(
        F.max_by(F.struct(*cols), F.struct(*order)).alias("_latest"))
    table = agg.select(key, "_latest.*")
    if tombstone:
        table = table.filter(~F.col(tombstone)).drop(tombstone)
    return table


def scan(table: DataFrame) -> DataFrame:
    """K2: all current values (the table itself)."""
    return table


def lookup(requested: DataFrame, table: DataFrame, key: str = "key") -> DataFrame:
    """K3: requested keys LEFT JOIN the table, with an explicit ``found`` flag."""
    marked = table.withColumn("_found", F.lit(True))
    return (requested.select(key).join(marked, key, "left")
            .withColumn("found", F.coalesce(F.col("_found"), F.lit(False))).drop("_found"))
