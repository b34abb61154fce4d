"""Windowed join of the two replies and the decision.

J1 is an inner equi-join on the order id with a time-difference bound: Spark
plans it as a shuffle (sort-merge) join on ``id`` with the time condition as
a join filter; in streaming the same condition, with watermarks on both
sides, lets the state store drop buffered rows once they can no longer match.
Every matching pair is emitted (no silent de-duplication).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertide import schema as S
from ordertide.config import Limits

PAYMENT_COLUMNS = ["id", "marketId", "customerId", "productCount", "price", "products", "seq"]


def within(p_ts: Column, s_ts: Column, seconds: int) -> Column:
    w = F.expr(f"INTERVAL {int(seconds)} SECONDS")
    return (s_ts >= p_ts - w) & (s_ts <= p_ts + w)


def window_join(left: DataFrame, right: DataFrame, on: str, left_ts: str, right_ts: str,
                seconds: int) -> DataFrame:
    """J1 in general form: inner equi-join on ``on`` where the two times are at
    most ``seconds`` apart (either way). ``right``'s key column is dropped.
    Every matching pair is emitted."""
    r = right.withColumnRenamed(on, "_r_key")
    cond = (left[on] == r["_r_key"]) & within(left[left_ts], r[right_ts], seconds)
    return left.join(r, cond, "inner").drop("_r_key")


def _micros(df: DataFrame, c: str) -> Column:
    """Microseconds of a time, the same distance apart whatever the session's time zone."""
    if isinstance(df.schema[c].dataType, T.TimestampNTZType):
        day = F.unix_date(F.to_date(c)).cast("long") * 86_400
        clock = F.hour(c) * 3_600 + F.minute(c) * 60 + F.date_part(F.lit("SECONDS"), c)
        return ((day + clock) * 1_000_000).cast("long")
    return F.unix_micros(F.col(c).cast("timestamp"))


def window_join_by_time(left: DataFrame, right: DataFrame, on: str, left_ts: str, right_ts: str,
                        seconds: int) -> DataFrame:
    """``window_join`` where one key may have a large share of the rows: a key is cut into
    stretches of the window's length, and each right row goes to its own and both
    neighbouring stretches, so a hot key's pairs are found by many tasks. Each left row is
    in one stretch: every pair comes up once. Rows with a null key or time match none."""
    width = max(int(seconds), 1) * 1_000_000
    left = left.withColumn("_stretch", F.floor(_micros(left, left_ts) / F.lit(width)))
    own = F.floor(_micros(right, right_ts) / F.lit(width))
    r = right.withColumn("_r_stretch", F.explode(F.array(own - 1, own, own + 1))).withColumnRenamed(on, "_r_key")
    cond = ((left[on] == r["_r_key"]) & (left["_stretch"] == r["_r_stretch"])
            & within(left[left_ts], r[right_ts], seconds))
    return left.join(r, cond, "inner").drop("_r_key", "_stretch", "_r_stretch")


def window_pair_counts(left: DataFrame, right: DataFrame, on: str, left_ts: str, right_ts: str,
                       seconds: int, by: dict[str, Column]) -> DataFrame:
    """How many pairs ``window_join`` has, by groups of left rows: the columns of ``by`` (over
    ``left``), n_left and n_pairs. No pair is made: each left row asks twice how many right
    rows of its key lie before a time, and running counts over the stretches of a key (as
    in ``window_join_by_time``) answer all in one pass. Rows with a null key or time count
    as left rows without pairs."""
    reach = int(seconds) * 1_000_000
    width = max(reach, 1)
    at = _micros(left, left_ts)
    named = left.select(*[c.alias(n) for n, c in by.items()], F.col(on).alias("_key"), at.alias("_at"))
    timed = named.where("_key is not null and _at is not null").withColumn("_stretch", F.floor(F.col("_at") / width))
    # below: rows before the window, which doesn't hold its ends' equals; above: up to its end
    asked = timed.withColumn("_ask", F.explode(F.array(
        F.struct((F.col("_at") - reach).alias("at"), F.lit(0).alias("turn"), F.lit(-1).alias("sign")),
        F.struct((F.col("_at") + reach).alias("at"), F.lit(2).alias("turn"), F.lit(1).alias("sign")))))
    rows = asked.select(*by, "_key", "_stretch", "_ask.at", "_ask.turn", "_ask.sign", F.lit(0).alias("one"))
    own = F.floor(F.col("_at") / width)
    there = right.select(F.col(on).alias("_key"), _micros(right, right_ts).alias("_at")).where("_key is not null and _at is not null")
    there = there.withColumn("_stretch", F.explode(F.array(own - 1, own, own + 1)))
    # equal times of a key are one row: a burst costs no more than a single event
    there = there.groupBy("_key", "_stretch", "_at").agg(F.count(F.lit(1)).cast("int").alias("one"))
    there = there.select(*[F.lit(None).cast(rows.schema[n].dataType).alias(n) for n in by], "_key", "_stretch", F.col("_at").alias("at"),
                         F.lit(1).alias("turn"), F.lit(0).alias("sign"), "one")
    line = Window.partitionBy("_key", "_stretch").orderBy("at", "turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = (rows.unionByName(there).withColumn("_before", F.sum(F.col("one").cast("long")).over(line)).where("sign <> 0")
               .select(*by, (F.col("sign") * F.col("_before")).alias("_pairs"), (F.col("sign") == 1).cast("long").alias("_left")))
    rest = named.where("_key is null or _at is null").select(*by, F.lit(0).cast("long").alias("_pairs"), F.lit(1).cast("long").alias("_left"))
    return counted.unionByName(rest).groupBy(*by).agg(F.sum("_left").alias("n_left"), F.sum("_pairs").alias("n_pairs"))


def join_replies(payment: DataFrame, stock: DataFrame, lim: Limits) -> DataFrame:
    """Payment ⋈ stock on id, |ts_p - ts_s| <= window. Columns of the
    payment side plus ``p_status``, ``s_status``, ``p_ts``, ``s_ts``."""
    keep = [c for c in PAYMENT_COLUMNS if c in payment.columns]
    p = payment.select(*keep, F.col("status").alias("p_status"), F.col("ts").alias("p_ts"))
    s = stock.select("id", F.col("status").alias("s_status"), F.col("ts").alias("s_ts"))
    return window_join(p, s, "id", "p_ts", "s_ts", lim.join_window_seconds)


def undecided(payment: DataFrame, stock: DataFrame, lim: Limits) -> DataFrame:
    """Q6: replies that J1 pairs with none, per order id: id, p_status, s_status, p_ts, s_ts,
    ``apart`` (seconds between the two; null if one is missing) and ``reason``
    (``no payment reply``, ``no stock reply`` or ``too far apart``). For one reply per
    order and service, as the services give; the guard of E5 doesn't matter here."""
    p = payment.select("id", F.col("status").alias("p_status"), F.col("ts").alias("p_ts"))
    s = stock.select("id", F.col("status").alias("s_status"), F.col("ts").alias("s_ts"))
    both = p.join(s, "id", "full_outer")
    both = both.where(F.coalesce(~within(F.col("p_ts"), F.col("s_ts"), lim.join_window_seconds), F.lit(True)))
    apart = F.abs(_micros(both, "p_ts") - _micros(both, "s_ts")) / 1_000_000
    reason = (F.when(F.col("p_status").isNull(), F.lit("no payment reply"))
              .when(F.col("s_status").isNull(), F.lit("no stock reply")).otherwise(F.lit("too far apart")))
    return both.withColumns({"apart": apart, "reason": reason})


def unmatched_replies(payment: DataFrame, stock: DataFrame, lim: Limits) -> DataFrame:
    """Q6 reply by reply: id, side, status and ts of those that J1 pairs with none."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.where("id is not null and ts is not null").select("id", F.lit(name).alias("side"), "status", "ts")
    p, s = side(payment, S.PAYMENT), side(stock, S.STOCK)

    def rest(a: DataFrame, b: DataFrame) -> DataFrame:
        other = b.select(F.col("id").alias("_id"), F.col("ts").alias("_ts"))
        return a.join(other, (a["id"] == other["_id"]) & within(a["ts"], other["_ts"], lim.join_window_seconds), "left_anti")
    return rest(p, s).unionByName(rest(s, p))


def decision_status(p_status: Column, s_status: Column) -> Column:
    """Both ACCEPT -> CONFIRMED; both REJECT -> REJECT; one REJECT -> ROLLBACK."""
    return (F.when((p_status == S.ACCEPT) & (s_status == S.ACCEPT), F.lit(S.CONFIRMED))
            .when((p_status == S.REJECT) & (s_status == S.REJECT), F.lit(S.REJECT))
            .when((p_status == S.REJECT) | (s_status == S.REJECT), F.lit(S.ROLLBACK)))


def decision_source(p_status: Column, s_status: Column) -> Column:
    """The side that rejected, only for ROLLBACK."""
    return F.when(decision_status(p_status, s_status) == S.ROLLBACK,
                  F.when(p_status == S.REJECT, F.lit(S.PAYMENT)).otherwise(F.lit(S.STOCK)))


def decide(pairs: DataFrame, lim: Limits) -> DataFrame:
    """J2 + E5 on joined pairs: OrderFullEvent columns, ``ts`` and ``error``."""
    p, s = F.col("p_status"), F.col("s_status")
    guard = lim.price_guard if lim.decision_price_guard is None else lim.decision_price_guard
    error = (F.when(p.isNull() | s.isNull(), F.lit(S.MSG_NULL_STATUS))
             .when(F.col("price").isNull(), F.lit("price is null"))
             .when(F.col("price") >= F.lit(guard).cast(S.MONEY), F.lit(S.MSG_PRICE_HIGH)))
    keep = [c for c in PAYMENT_COLUMNS if c in pairs.columns]
    return pairs.select(
        *keep,
        decision_status(p, s).alias("status"),
        decision_source(p, s).alias("source"),
        F.greatest("p_ts", "s_ts").alias("ts"),
        error.alias("error"),
    )


def decisions(payment: DataFrame, stock: DataFrame, lim: Limits) -> DataFrame:
    """J1 then J2/E5."""
    return decide(join_replies(payment, stock, lim), lim)
