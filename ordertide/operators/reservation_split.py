"""Skew-safe reservation fold: hot keys split across tasks, results exact.

The plain fold (``reservation.reserve``) streams each key through one task.
That is fine for many small keys, but there are only 25 markets, and one
customer may hold a large share of all orders. Here a key's rows may span
any number of tasks:

1. The rows are range-partitioned on the key and the row order, sorted, and
   checkpointed, so all passes see the same partitions. A hot key covers a run
   of consecutive partitions; every other boundary falls between keys.
2. Summary pass (parallel): one row per partition. Its last key, if it starts
   there, is folded plainly; a partition of a single key reports a bound on the
   balance that it leaves (below).
3. The summaries of one key, in partition order, carry that bound along, which
   gives a bound on each single-key partition's start balance.
4. Piece pass (parallel), only on single-key partitions whose key goes on: the
   effect on any start balance within its bound, as pieces
   ``[lo_i, lo_{i+1}) -> b - off_i`` (integer units). Pieces are as many as the
   rows make them; there is no limit.
5. The pieces of one key, in partition order, are evaluated one after the other,
   which gives every partition's start state.
6. Fold pass (parallel): every partition folds its rows from its start.

Steps 3 and 5 are grouped by key on the executors and handle one small row per
partition that the key spans; steps 4 and 6 get them by a broadcast join on the
partition number (a row per partition), so the rows are shuffled and sorted once, in
step 1. The Python passes get Arrow batches: columns that a pass doesn't need stay as
they are.

Only ``available`` is real state: ``available + reserved + confirmed`` stays
equal to the initial balance for every row (a NEW accept moves an amount from
available to reserved, CONFIRMED moves it from reserved to confirmed, a
release moves it back). So the reserved amount follows from the confirmed sum.

The bound: from any start <= U, a row of amount p leaves at most
max(min(U, p - 1), U - p), and a release of a adds a. Over a partition this
G(U) is monotone and 1-Lipschitz, so G(B) <= G(initial) + max(0, B - initial).
It collapses after a few hundred rows (the balance is spent), and pieces only
split below it, so they stay few even for money.
"""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertide import schema as S
from ordertide.operators import reservation as rv
from ordertide.session import checkpoint_dir

_INF = np.iinfo(np.int64).max
# Partition number stamped into the rows before the checkpoint. Read from the
# data, not from the task: later passes may deal partitions out differently.
_PID = "_pid"

# One row per partition. bound_end: bound after a single-key partition for starts up
# to the initial balance; last_end, conf_last: end of a last key that starts there;
# open_a, open_conf: available and confirmed of a first key that is opened there.
SUMMARY = ("pid int, first_key string, last_key string, single boolean, conf_first long, "
           "last_end long, conf_last long, bound_end long, open_a long, open_conf long")
_ARROW = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
_SUMMARY = pa.schema([(name, _ARROW[kind]) for name, kind in (c.split() for c in SUMMARY.split(", "))])
_PIECES = pa.schema([("pid", pa.int32()), ("lo", pa.list_(pa.int64())), ("off", pa.list_(pa.int64()))])
#: The last row without an error of its key and Arrow batch; a key's last one is among them.
END = "is_end"


class Pieces:
    """b -> b - off on [lo_i, lo_{i+1}); lo_0 = 0, the last piece is unbounded."""

    def __init__(self, upper: int):
        self.lo = np.zeros(1, dtype=np.int64)
        self.off = np.zeros(1, dtype=np.int64)
        self.upper = upper
        self.most = upper  # what is left of any start up to upper, at most

    def new(self, a: int) -> None:
        """A NEW row of amount a: accepted where b - off >= a."""
        if a > self.most:
            return
        t = self.off + a
        hi = np.empty_like(self.lo)
        hi[:-1] = self.lo[1:] - 1
        hi[-1] = _INF
        whole = t <= self.lo
        split = (t > self.lo) & (t <= hi) & (t <= self.upper)
        off = np.where(whole, self.off + a, self.off)
        if split.any():
            idx = np.nonzero(split)[0]
            lo = np.insert(self.lo, idx + 1, t[idx])
            off = np.insert(off, idx + 1, self.off[idx] + a)
            keep = lo <= self.upper
            self.lo, self.off = lo[keep], off[keep]
        else:
            self.off = off
        self.most = int((np.append(self.lo[1:] - 1, self.upper) - self.off).max())

    def release(self, a: int) -> None:
        self.off = self.off - a
        self.most += a

    def __call__(self, b: int) -> int:
        return evaluate(self.lo, self.off, b)


def evaluate(lo, off, b: int) -> int:
    i = int(np.searchsorted(np.asarray(lo, dtype=np.int64), b, side="right")) - 1
    return int(b - off[i])


def _row_effect(side: rv.Side, unit: int):
    """Classify a row: ('new', a) / ('release', a) / ('confirm', a) / ('open', a, reserved) /
    None (no state change)."""
    guard = side.guard * unit

    def effect(k, a, st, src):
        if st == rv.OPEN:
            return ("open", a, int(src))
        if k is None or st is None or a is None or a >= guard:
            return None
        if st == S.NEW:
            return ("new", a)
        if st == S.CONFIRMED:
            return ("confirm", a)
        if st == S.ROLLBACK and rv._releases(side.policy, side.source, src):
            return ("release", a)
        return None
    return effect


def _columns(rows: pa.RecordBatch) -> list[list]:
    return [rows.column(c).to_pylist() for c in (rv._K, rv._A, rv._ST, rv._SRC)]


def _by_partition(batches):
    """(partition number, its rows) in order; a partition may come in several parts."""
    for batch in batches:
        if batch.num_rows:
            pid = batch.column(_PID).to_numpy()
            for a, b in pairwise([0, *(np.flatnonzero(np.diff(pid)) + 1).tolist(), len(pid)]):
                yield int(pid[a]), batch.slice(a, b - a)


def _summarize(side: rv.Side, unit: int):
    """Rows sorted by (partition, key, order) -> SUMMARY rows."""
    effect = _row_effect(side, unit)
    initial = side.initial * unit

    def run(batches):
        out = None
        for pid, rows in _by_partition(batches):
            keys, amts, sts, srcs = _columns(rows)
            if out is not None and out["pid"] != pid:
                yield pa.RecordBatch.from_pylist([out], schema=_SUMMARY)
                out = None
            if out is None:
                out = {"pid": pid, "first_key": keys[0], "last_key": None, "single": True, "conf_first": 0,
                       "last_end": None, "conf_last": 0, "bound_end": initial, "open_a": None, "open_conf": None}
                carry = [object(), 0, 0]   # plain fold of the last key's rows
            start = 0
            if keys[0] == out["first_key"] and sts[0] == rv.OPEN and out["open_a"] is None:
                out["open_a"], out["open_conf"] = amts[0], initial - amts[0] - int(srcs[0])
            if out["single"]:
                while start < len(keys) and keys[start] == out["first_key"]:
                    e = effect(keys[start], amts[start], sts[start], srcs[start])
                    start += 1
                    if e is None or e[0] == "open":
                        continue
                    if e[0] == "new":
                        out["bound_end"] = max(min(out["bound_end"], e[1] - 1), out["bound_end"] - e[1], 0)
                    elif e[0] == "release":
                        out["bound_end"] += e[1]
                    else:
                        out["conf_first"] += e[1]
                out["single"] = start == len(keys)
            if start < len(keys):
                # only the last key matters, from its first row here on
                j = len(keys) - 1
                while j > start and keys[j - 1] == keys[-1]:
                    j -= 1
                if keys[j] != carry[0]:
                    carry[0] = object()
                    out["conf_last"] = 0
                for row in zip(keys[j:], amts[j:], sts[j:], srcs[j:], strict=True):
                    e = effect(*row)
                    if e is not None and e[0] == "confirm":
                        out["conf_last"] += e[1]
                    elif e is not None and e[0] == "open":
                        out["conf_last"] = initial - e[1] - e[2]
                rv.fold_rows(keys[j:], amts[j:], sts[j:], srcs[j:], side, unit, carry)
                out["last_end"] = int(carry[1])
            out["last_key"] = keys[-1]
        if out is not None:
            yield pa.RecordBatch.from_pylist([out], schema=_SUMMARY)
    return run


def _pieces(side: rv.Side, unit: int):
    """Rows of single-key partitions with the bound on their start -> their pieces."""
    effect = _row_effect(side, unit)

    def run(batches):
        pid = pieces = None

        def row():
            return pa.RecordBatch.from_pylist([{"pid": pid, "lo": pieces.lo.tolist(), "off": pieces.off.tolist()}], schema=_PIECES)
        for at, rows in _by_partition(batches):
            if at != pid:
                if pid is not None:
                    yield row()
                pid, pieces = at, Pieces(rows.column("bound")[0].as_py())
            for values in zip(*_columns(rows), strict=True):
                e = effect(*values)
                if e is not None and e[0] == "new":
                    pieces.new(e[1])
                elif e is not None and e[0] == "release":
                    pieces.release(e[1])
        if pid is not None:
            yield row()
    return run


def parts_of_keys(summaries: DataFrame) -> DataFrame:
    """SUMMARY rows -> one row per key and partition that it starts in (``tail``) or
    comes into; ``whole``: the partition holds nothing else."""
    head = summaries.where("first_key is not null").select(
        F.col("first_key").alias("key"), "pid", F.lit(False).alias("tail"), F.col("single").alias("whole"),
        F.col("conf_first").alias("conf"), F.lit(None).cast("long").alias("end"), "bound_end", "open_a", "open_conf")
    tail = summaries.where("not single and last_key is not null").select(
        F.col("last_key").alias("key"), "pid", F.lit(True).alias("tail"), F.lit(False).alias("whole"),
        F.col("conf_last").alias("conf"), F.col("last_end").alias("end"), F.lit(None).cast("long").alias("bound_end"),
        F.lit(None).cast("long").alias("open_a"), F.lit(None).cast("long").alias("open_conf"))
    return head.unionByName(tail)


def carry_bounds(parts: pd.DataFrame, initial: int) -> list[tuple[int, int]]:
    """One key's parts in order -> (partition, bound on the start) where pieces are needed."""
    rows = parts.sort_values(["pid", "tail"]).to_dict("records")
    bound, out = initial, []
    for i, r in enumerate(rows):
        if r["tail"]:
            bound = int(r["end"])
            continue
        if not pd.isna(r["open_a"]):
            bound = int(r["open_a"])
        if r["whole"] and i + 1 < len(rows):
            out.append((r["pid"], bound))
            bound = int(r["bound_end"]) + max(0, bound - initial)
    return out


def carry_state(parts: pd.DataFrame, initial: int) -> list[tuple]:
    """One key's parts in order, with pieces -> (partition, key and its available and
    reserved units at the start or null, whether the key goes on after the partition)."""
    rows = parts.sort_values(["pid", "tail"]).to_dict("records")
    available, confirmed, out = initial, 0, []
    for i, r in enumerate(rows):
        more = i + 1 < len(rows)
        if r["tail"]:
            available, confirmed = int(r["end"]), int(r["conf"])
            out.append((r["pid"], None, None, None, more))
        else:
            if not pd.isna(r["open_a"]):
                available, confirmed = int(r["open_a"]), int(r["open_conf"])
            out.append((r["pid"], r["key"], available, initial - available - confirmed, more and r["whole"]))
            if r["whole"] and more:
                available, confirmed = evaluate(r["lo"], r["off"], available), confirmed + int(r["conf"])
    return out


def _fold_from_starts(side: rv.Side, unit: int, kept: list[str]):
    """Rows sorted by (partition, key, order), with their partition's start -> the columns
    ``kept`` as they are, FOLD_FIELDS and END."""
    def run(batches):
        carry = pending = pid = None

        def done() -> pa.RecordBatch:
            columns, last, _ = pending
            names = [*kept, *(f.name for f in rv.FOLD_FIELDS), END]
            columns = [*columns[:-1], pa.array(last, pa.bool_()), columns[-1]]
            return pa.RecordBatch.from_arrays(columns, names=names)
        for at, rows in _by_partition(batches):
            keys, amts, sts, srcs = _columns(rows)
            if at != pid:
                if pending is not None:
                    pending[1][-1] &= not continues
                    yield done()
                    pending = None
                start, a, r, more = (rows.column(c)[0].as_py() for c in ("_start_key", "_start_a", "_start_r", "_continues"))
                carry = [object(), 0, 0] if start is None else [start, a, r]
                continues, pid = more is True, at
            out_status, errors, avail, resv = rv.fold_rows(keys, amts, sts, srcs, side, unit, carry)
            last = [k is not None and k != after for k, after in zip(keys, [*keys[1:], None], strict=True)]
            ends, seen = [False] * len(keys), None
            for i in range(len(keys) - 1, -1, -1):
                if errors[i] is None and keys[i] != seen:
                    ends[i], seen = True, keys[i]
            if pending is not None:
                pending[1][-1] &= pending[2] != keys[0]
                yield done()
            columns = [*(rows.column(c) for c in kept), rows.column(rv._ST), pa.array(out_status, pa.string()), pa.array(errors, pa.string()),
                       pa.array(avail), pa.array(resv), pa.array(ends, pa.bool_())]
            pending = (columns, last, keys[-1])
        if pending is not None:
            pending[1][-1] &= not continues
            yield done()
    return run


def reserve_split(orders: DataFrame, side: rv.Side, partitions: int | None = None, start: DataFrame | None = None,
                  idle: bool = False, ends: bool = False) -> DataFrame:
    """R1/R2 in batch with hot keys spread over many tasks; same result as
    ``reservation.reserve``. ``start``: balances (side.key, available, reserved) that keys
    begin with; each becomes one row before its key's others, so a hot key's rows aren't
    joined with its balance. ``idle``: few keys of ``start`` have no orders, so all are
    taken without looking them up. ``ends``: add the column END, by which
    ``reservation.balances`` leaves out most rows."""
    spark = orders.sparkSession
    checkpoint_dir(spark)
    unit = rv.unit_of(side)
    initial = side.initial * unit
    staged = rv.stage(orders, side)
    if start is not None:
        staged = staged.unionByName(rv.opening_rows(start, staged, side, idle))
    order = [c for c in rv.ORDER if c in staged.columns]
    keys = (rv._K, *order)
    # Without an explicit count AQE may merge adjacent range partitions (they
    # stay contiguous in key order) to its advisory size.
    by_range = staged.repartitionByRange(partitions, *keys) if partitions else staged.repartitionByRange(*keys)
    ranged = by_range.withColumn(_PID, F.spark_partition_id()).sortWithinPartitions(_PID, *keys).checkpoint()
    narrow = ranged.select(_PID, rv._K, rv._A, rv._ST, rv._SRC)

    # one row per partition from here to the join
    parts = parts_of_keys(narrow.mapInArrow(_summarize(side, unit), SUMMARY).checkpoint())
    bounds = parts.groupBy("key").applyInPandas(
        lambda pdf: pd.DataFrame(carry_bounds(pdf, initial), columns=["pid", "bound"]), "pid int, bound long")
    # sorted as they were stored, which a broadcast join keeps
    long_ = ranged.join(F.broadcast(bounds.withColumnRenamed("pid", _PID)), _PID).sortWithinPartitions(_PID, *keys)
    pieces = long_.select(*narrow.columns, "bound").mapInArrow(_pieces(side, unit), "pid int, lo array<long>, off array<long>")
    starts = parts.join(pieces, "pid", "left").groupBy("key").applyInPandas(
        lambda pdf: pd.DataFrame(carry_state(pdf, initial), columns=["pid", "key", "a", "r", "more"]),
        "pid int, key string, a long, r long, more boolean")
    starts = starts.groupBy(F.col("pid").alias(_PID)).agg(
        F.max("key").alias("_start_key"), F.max("a").alias("_start_a"), F.max("r").alias("_start_r"),
        F.max("more").alias("_continues")).checkpoint()

    working = {_PID, rv._K, rv._A, rv._ST, rv._SRC, "status"}
    kept = [f for f in ranged.schema.fields if f.name not in working]
    out_schema = T.StructType([*kept, *rv.FOLD_FIELDS, T.StructField(END, T.BooleanType())])
    names = [f.name for f in kept]
    folded = ranged.join(F.broadcast(starts), _PID, "left").sortWithinPartitions(_PID, *keys)
    folded = folded.select(*names, *narrow.columns, "_start_key", "_start_a", "_start_r", "_continues")
    folded = folded.mapInArrow(_fold_from_starts(side, unit, names), out_schema)
    if start is not None:
        folded = folded.where(F.col("in_status").isNull() | (F.col("in_status") != rv.OPEN))
    return rv.unstage(folded if ends else folded.drop(END), orders.schema, side)
