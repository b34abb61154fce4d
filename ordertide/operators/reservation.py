"""Credit and stock reservation.

"Accept if it still fits" skips rejected rows, so the balance is not a prefix
sum and no window function expresses it. The batch plan is:

    repartition(key) -> sortWithinPartitions(key, ts, seq) -> mapInPandas(fold)

The fold walks each partition's sorted stream once, carrying the current key's
balance across Arrow batches, so memory per task is constant however many rows
a key has (the sort spills). The last row of every key is flagged so the
balance table (R4) is a filter on the same partitions, without another shuffle.

Money is folded as exact integer cents (decimal(18,2) * 100 fits a long) and
turned back into decimal(18,2) afterwards.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertide import schema as S
from ordertide.config import Limits


#: Status of the row that opens a key with the balance of earlier batches: its amount is
#: the available units, its source the reserved ones. Inside the folds only.
OPEN = "\x00open"
#: Order of a key's rows. Offsets repeat across topic partitions, so the order id
#: and the partition break ties of time and offset.
ORDER = ("ts", "seq", "id", "partition")


@dataclass(frozen=True)
class Side:
    """One reservation service: which key, which amount, which limits."""

    name: str          # stage name in the error topic
    source: str        # PAYMENT / STOCK
    key: str           # column the state is keyed by
    amount: str        # column reserved against the balance
    money: bool        # amount is decimal(18,2) money (folded as cents)
    initial: int       # R3: balance of an unseen key
    guard: int         # E3/E4: amount >= guard -> error, state change dropped
    guard_msg: str
    policy: str        # rollback policy, see Limits.rollback_policy


def payment_side(lim: Limits) -> Side:
    return Side("payment", S.PAYMENT, "customerId", "price", True,
                lim.initial_credit, lim.price_guard, S.MSG_PRICE_HIGH, lim.rollback_policy)


def stock_side(lim: Limits) -> Side:
    return Side("stock", S.STOCK, "marketId", "productCount", False,
                lim.initial_items, lim.count_guard, S.MSG_COUNT_HIGH, lim.rollback_policy)


_UNIT = 100  # cents per money unit (scale of decimal(18,2))

# Columns added by the fold.
_K, _A, _ST, _SRC = "_k", "_amt", "_in_status", "_in_source"
FOLD_FIELDS = [
    T.StructField("in_status", T.StringType()),
    T.StructField("_out_status", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("_avail", T.LongType()),
    T.StructField("_resv", T.LongType()),
    T.StructField("is_last", T.BooleanType()),
]


def _releases(policy: str, own: str, source) -> bool:
    """Q2: does a ROLLBACK naming ``source`` release this side's hold?"""
    if source is None:
        return False
    if policy == "as_coded":
        return source == own
    if policy == "release_holder":
        return source != own
    raise ValueError(f"unknown rollback policy {policy!r}")


def fold_rows(keys, amounts, statuses, sources, side: Side, unit: int, carry):
    """The per-key state machine over rows already sorted by (key, ts, seq).

    ``carry`` is [current_key, available, reserved] and is updated in place so
    the walk continues across batches. Returns per-row lists
    (out_status, error, available, reserved). A pure helper: tests call it
    directly as the brute-force reference.
    """
    n = len(keys)
    out_status: list = [None] * n
    errors: list = [None] * n
    avail_out = np.zeros(n, dtype=np.int64)
    resv_out = np.zeros(n, dtype=np.int64)
    initial = side.initial * unit
    guard = side.guard * unit
    own, policy, guard_msg = side.source, side.policy, side.guard_msg
    cur, avail, resv = carry
    for i in range(n):
        k = keys[i]
        st = statuses[i]
        out_status[i] = st
        if k is None:
            errors[i] = S.MSG_NULL_KEY
            continue
        if k != cur:
            cur, avail, resv = k, initial, 0
        a = amounts[i]
        if st == OPEN:
            avail, resv = a, int(sources[i])
        elif st is None:
            errors[i] = S.MSG_NULL_STATUS
        elif a is None:
            errors[i] = f"{side.amount} is null"
        else:
            new_avail, new_resv = avail, resv
            if st == S.NEW:
                if a <= avail:
                    new_avail, new_resv = avail - a, resv + a
                    out_status[i] = S.ACCEPT
                else:
                    out_status[i] = S.REJECT
            elif st == S.CONFIRMED:
                new_resv = resv - a
            elif st == S.ROLLBACK:
                if _releases(policy, own, sources[i]):
                    new_avail, new_resv = avail + a, resv - a
            if a >= guard:
                errors[i] = guard_msg      # the state change is not kept
            else:
                avail, resv = new_avail, new_resv
        avail_out[i] = avail
        resv_out[i] = resv
    carry[0], carry[1], carry[2] = cur, avail, resv
    return out_status, errors, avail_out, resv_out


def _none_list(s: pd.Series) -> list:
    return [None if v is None or (isinstance(v, float) and np.isnan(v)) else v for v in s.tolist()]


def _fold_partition(side: Side, unit: int):
    def run(batches):
        carry = [object(), 0, 0]
        pending = None
        for pdf in batches:
            if pdf.empty:
                continue
            keys = _none_list(pdf[_K])
            amts = [None if pd.isna(v) else int(v) for v in pdf[_A].tolist()]
            out_status, errors, avail, resv = fold_rows(
                keys, amts, _none_list(pdf[_ST]), _none_list(pdf[_SRC]), side, unit, carry)
            karr = np.array([("\x00null" if k is None else k) for k in keys], dtype=object)
            last = np.ones(len(keys), dtype=bool)
            last[:-1] = karr[1:] != karr[:-1]
            last &= np.array([k is not None for k in keys])
            out = pdf.assign(in_status=pdf[_ST], _out_status=out_status, error=errors,
                             _avail=avail, _resv=resv, is_last=last)
            if pending is not None:
                prev, prev_last_key = pending
                if prev_last_key is not None and prev_last_key == keys[0]:
                    prev.iloc[-1, prev.columns.get_loc("is_last")] = False
                yield prev
            pending = (out, keys[-1])
        if pending is not None:
            yield pending[0]
    return run


def _is_small_decimal(f: T.StructField) -> bool:
    return isinstance(f.dataType, T.DecimalType) and f.dataType.precision <= 18


def stage(orders: DataFrame, side: Side) -> DataFrame:
    """Add the fold's working columns: key as string, amount in integer units,
    incoming status and source. Decimal columns that only pass through are
    carried as their unscaled longs (cheap in Arrow/pandas) and restored by
    ``unstage``."""
    amount = F.col(side.amount)
    units = (amount * _UNIT).cast("long") if side.money else amount.cast("long")
    staged = orders.withColumns({
        _K: F.col(side.key).cast("string"),
        _A: units,
        _ST: F.col("status"),
        _SRC: F.col("source"),
    })
    carried = {f.name: (F.col(f.name) * F.lit(10 ** f.dataType.scale)).cast("long")
               for f in orders.schema.fields if _is_small_decimal(f)}
    if carried:
        staged = staged.withColumns(carried)
    return staged.drop("error") if "error" in staged.columns else staged


def _restore(f: T.StructField):
    if _is_small_decimal(f):
        t = f.dataType
        return (F.col(f.name).cast(T.DecimalType(t.precision, 0)) / F.lit(10 ** t.scale)).cast(t).alias(f.name)
    return F.col(f.name)


def unstage(folded: DataFrame, orders_schema: T.StructType, side: Side) -> DataFrame:
    """Fold output -> public columns (money back to decimal(18,2))."""
    def back(c: str):
        if side.money:
            return (F.col(c).cast(T.DecimalType(20, 0)) / F.lit(_UNIT)).cast(S.MONEY)
        return F.col(c).cast("int")

    extra = [c for c in ("is_last", "is_end") if c in folded.columns]
    return folded.select(
        *[_restore(f) for f in orders_schema.fields if f.name not in ("status", "error")],
        "in_status",
        F.col("_out_status").alias("status"),
        "error",
        back("_avail").alias("available"),
        back("_resv").alias("reserved"),
        *extra,
    )


def unit_of(side: Side) -> int:
    return _UNIT if side.money else 1


def opening_rows(start: DataFrame, staged: DataFrame, side: Side, idle: bool = False) -> DataFrame:
    """The balances of ``start`` (side.key, available, reserved) as rows that precede all
    others of their keys in ``staged``; keys without a row there are left out, but for
    ``idle``. Their order columns are null, which sorts first."""
    units = unit_of(side)

    def long(c: str):
        return (F.col(c) * F.lit(units)).cast("long")
    rows = start.select(F.col(side.key).cast("string").alias("_start"), long("available").alias("_a"), long("reserved").alias("_r"))
    if not idle:
        rows = rows.join(staged.select(F.col(_K).alias("_start")).where("_start is not null").distinct(), "_start", "left_semi")
    own = {_K: F.col("_start"), _A: F.col("_a"), _ST: F.lit(OPEN), _SRC: F.col("_r").cast("string")}
    return rows.select(*[own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in staged.schema.fields])


def reserve(orders: DataFrame, side: Side, partitions: int | None = None, start: DataFrame | None = None) -> DataFrame:
    """R1/R2 in batch: every row folded in ORDER within its key, from the balances of
    ``start`` (side.key, available, reserved) where it names the key.

    ``orders`` holds OrderFullEvent columns plus ``ts`` and ``seq``. The result
    keeps all input columns, with ``in_status`` (status before), ``status``
    (after), ``error``, ``available``/``reserved`` (the stored state after the
    row) and ``is_last`` (last row of its key).
    """
    staged = stage(orders, side)
    if start is not None:
        staged = staged.unionByName(opening_rows(start, staged, side))
    by_key = (staged.repartition(partitions, _K) if partitions else staged.repartition(_K))
    ordered = by_key.sortWithinPartitions(_K, *[c for c in ORDER if c in staged.columns])
    out_schema = T.StructType(list(ordered.schema.fields) + FOLD_FIELDS)
    folded = ordered.mapInPandas(_fold_partition(side, unit_of(side)), out_schema)
    if start is not None:
        folded = folded.where(F.col("in_status").isNull() | (F.col("in_status") != OPEN))
    return unstage(folded, orders.schema, side)


def balances(reserved: DataFrame, side: Side) -> DataFrame:
    """The state per key that its last row without an error stored. A key with
    error rows only stored nothing and has no balance. The maximum is aggregated
    partially, so a hot key costs one row per task. ``reserve_split`` can mark the rows
    among which those are."""
    kept = reserved.filter(F.col("error").isNull() & F.col(side.key).isNotNull())
    if "is_end" in reserved.columns:
        kept = kept.where("is_end")
    last = F.max_by(F.struct("available", "reserved"), F.struct(*[c for c in ORDER if c in reserved.columns]))
    return kept.groupBy(side.key).agg(last.alias("_last")).select(side.key, "_last.available", "_last.reserved")


def settlement_deltas(decisions: DataFrame, side: Side) -> DataFrame:
    """R5, order-independent part: per key, what CONFIRMED/ROLLBACK rows change.

    ``decisions`` holds decided orders (status CONFIRMED / ROLLBACK / REJECT,
    ``source``). Returns key, d_available, d_reserved, settled (amount leaving
    the balance for good). A plain grouped sum: partial aggregation before the
    shuffle, so a hot key costs one row per map task.
    """
    amt = F.col(side.amount)
    if side.policy == "as_coded":
        release = F.col("source") == side.source
    elif side.policy == "release_holder":
        release = F.col("source").isNotNull() & (F.col("source") != side.source)
    else:
        raise ValueError(side.policy)
    confirmed = F.col("status") == S.CONFIRMED
    rolled = (F.col("status") == S.ROLLBACK) & release
    zero = F.lit(0).cast(S.MONEY) if side.money else F.lit(0)
    guard_ok = amt < F.lit(side.guard)
    return (decisions.filter(F.col(side.key).isNotNull() & guard_ok)
            .groupBy(side.key)
            .agg(F.sum(F.when(rolled, amt).otherwise(zero)).alias("d_available"),
                 F.sum(F.when(confirmed | rolled, -amt).otherwise(zero)).alias("d_reserved"),
                 F.sum(F.when(confirmed, amt).otherwise(zero)).alias("settled")))


def settle(balance: DataFrame, deltas: DataFrame, side: Side) -> DataFrame:
    """Final balance = pass-1 balance + settlement deltas (keys seen in pass 1)."""
    typ = S.MONEY if side.money else T.LongType()
    zero = F.lit(0).cast(typ)
    j = balance.join(deltas, side.key, "left")
    return j.select(
        side.key,
        (F.col("available") + F.coalesce("d_available", zero)).cast(typ).alias("available"),
        (F.col("reserved") + F.coalesce("d_reserved", zero)).cast(typ).alias("reserved"),
        F.coalesce("settled", zero).cast(typ).alias("settled"),
    )
