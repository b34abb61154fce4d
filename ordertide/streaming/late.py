"""Q6 on streams: replies that stay without a partner.

State holds an order's replies until no partner can come any more: event time has passed
them by the window. A timer then emits those that J1 never paired, each once, whether the
other reply came too late or never. ``operators.decision.unmatched_replies`` is the same
in batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ordertide import schema as S
from ordertide.config import Limits

REPLIES = "side string, status string, at long, matched boolean"
OUT = "id string, side string, status string, ts timestamp"


class WaitForPartner(StatefulProcessor):
    """One order id: its replies, in microseconds of event time, and whether each is paired."""

    def __init__(self, window_seconds: int):
        self.window = window_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.replies = handle.getListState("replies", REPLIES)

    def _wait(self, rows: list[list]) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if rows:
            self.replies.put([tuple(r) for r in rows])
            # the first millisecond after which the oldest can't be paired
            self.handle.registerTimer((min(r[2] for r in rows) + self.window) // 1000 + 1)
        else:
            self.replies.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = [list(r) for r in self.replies.get()]
        for pdf in rows:
            for side, status, at in zip(pdf["side"].tolist(), pdf["status"].tolist(), pdf["at"].tolist(), strict=True):
                new = [side, status, int(at), False]
                for other in held:
                    if other[0] != side and abs(other[2] - new[2]) <= self.window:
                        other[3] = new[3] = True
                held.append(new)
        self._wait(held)
        yield pd.DataFrame(columns=["id", "side", "status", "at"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        held = [list(r) for r in self.replies.get()]
        past = [r for r in held if r[2] + self.window < now]
        self._wait([r for r in held if r[2] + self.window >= now])
        out = [(key[0], r[0], r[1], r[2]) for r in past if not r[3]]
        yield pd.DataFrame(out, columns=["id", "side", "status", "at"])

    def close(self) -> None:
        pass


def unmatched_stream(payment: DataFrame, stock: DataFrame, lim: Limits, watermark: str = "20 seconds") -> DataFrame:
    """id, side, status and ts of each reply without a partner within the window."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.where("id is not null and ts is not null").select("id", F.lit(name).alias("side"), "status", "ts")
    both = side(payment, S.PAYMENT).unionByName(side(stock, S.STOCK)).withWatermark("ts", watermark)
    both = both.withColumn("at", F.unix_micros("ts"))
    found = both.groupBy("id").transformWithStateInPandas(
        WaitForPartner(lim.join_window_seconds), "id string, side string, status string, at long", "append", "EventTime")
    return found.select("id", "side", "status", F.timestamp_micros("at").alias("ts"))
