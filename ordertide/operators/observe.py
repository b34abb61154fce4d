"""Counts of rows passing a point (instead of per-row log lines)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def observe(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter; ``obs.get['rows']`` is set after the first action."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
