"""R1/R2 on a stream: ``transformWithStateInPandas`` with one value state per key.

The processor reuses the batch fold's state machine (``fold_rows``). Rows of
one key inside a micro-batch are sorted by (ts, seq) first (Spark does not
order them); across micro-batches the order is arrival order. The rows held
at once are those of one key in one micro-batch, bounded by the trigger size
(``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``). State lives in the
configured state store (RocksDB provider) and is checkpointed.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ordertide.operators import reservation as rv

STATE_NAME = "balance"
STATE_SCHEMA = T.StructType([
    T.StructField("available", T.LongType()),
    T.StructField("reserved", T.LongType()),
])


class ReservationProcessor(StatefulProcessor):
    """Arrow/pandas processor: one key's rows of a micro-batch at a time."""

    def __init__(self, side: rv.Side, in_columns: list[str], out_columns: list[str]):
        self.side = side
        self.unit = rv.unit_of(side)
        self.in_columns = in_columns
        self.out_columns = out_columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState(STATE_NAME, STATE_SCHEMA)

    def handleInputRows(self, key, rows, timerValues):
        pdf = pd.concat(list(rows), ignore_index=True)
        if pdf.empty:
            return
        # PySpark renames columns starting with "_" by position here; the
        # frame follows the input schema, so restore the names by position.
        pdf.columns = self.in_columns
        pdf = pdf.sort_values([c for c in rv.ORDER if c in pdf.columns], na_position="first", kind="stable").reset_index(drop=True)
        k = key[0]
        if self.state.exists():
            avail, resv = self.state.get()
        else:
            avail, resv = self.side.initial * self.unit, 0
        carry = [k, avail, resv]
        amts = [None if pd.isna(v) else int(v) for v in pdf[rv._A].tolist()]
        statuses, errors, av, rs = rv.fold_rows(
            [k] * len(pdf), amts, rv._none_list(pdf[rv._ST]), rv._none_list(pdf[rv._SRC]),
            self.side, self.unit, carry)
        if k is not None and any(e is None for e in errors):  # an error row stores nothing
            self.state.update((int(carry[1]), int(carry[2])))
        out = pdf.assign(in_status=pdf[rv._ST], _out_status=statuses, error=errors, _avail=av, _resv=rs)
        yield out[self.out_columns]

    def close(self) -> None:
        pass


def reserve_stream(orders: DataFrame, side: rv.Side) -> DataFrame:
    """Streaming twin of ``reservation.reserve`` (no ``is_last`` column)."""
    staged = rv.stage(orders, side)
    fields = list(staged.schema.fields) + [f for f in rv.FOLD_FIELDS if f.name != "is_last"]
    out_schema = T.StructType(fields)
    proc = ReservationProcessor(side, staged.columns, [f.name for f in fields])
    folded = staged.groupBy(rv._K).transformWithStateInPandas(proc, out_schema, "append", "None")
    return rv.unstage(folded, orders.schema, side)
