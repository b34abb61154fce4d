"""The error topic (E6): one frame of (key, stage, message) from every stage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def error_rows(outcomes: DataFrame, stage: str, key: str = "key") -> DataFrame:
    """Error rows of one stage. ``key`` names the column the stage is keyed by."""
    return outcomes.filter(F.col("error").isNotNull()).select(
        F.col(key).cast("string").alias("key"),
        F.lit(stage).alias("stage"),
        F.col("error").alias("message"),
    )


def union_errors(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
