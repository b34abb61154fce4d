"""J1 on streams: a stream-stream inner join with watermarks on both sides.

The time bound of the join lets Spark evict buffered replies once the
watermark has passed them by more than the window. The default watermark
delay is 20 s (the 10 s window each way, no grace); replies later than that
may be dropped, matching the reference's no-grace window only approximately
(its late-drop is per task and per store segment).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ordertide.config import Limits
from ordertide.operators import decision as dc


def decisions_stream(payment: DataFrame, stock: DataFrame, lim: Limits,
                     watermark: str = "20 seconds") -> DataFrame:
    p = payment.withWatermark("ts", watermark)
    s = stock.withWatermark("ts", watermark)
    return dc.decisions(p, s, lim)
