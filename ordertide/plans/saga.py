"""The order saga in batch: enrich -> reserve (x2) -> decide -> settle.

Deterministic two-pass schedule (one valid schedule of the live system):
pass 1 folds every NEW order in (ts, seq) order on each side; replies are
joined and decided; pass 2 applies all settlements as per-key sums, so the
final balance is the pass-1 balance plus the settlement deltas. Releases do
not re-open earlier rejections. Because of the loop guard (replies only to
NEW), nothing is re-emitted after settlement.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide.config import Limits
from ordertide.operators import decision as dc
from ordertide.operators import reservation as rv
from ordertide.operators import routing as rt
from ordertide.operators.reservation_split import reserve_split
from ordertide.session import checkpoint_dir


def materialize(df: DataFrame) -> DataFrame:
    """A stage that several consumers read: checkpointed into
    ``spark.checkpoint.dir``, so it runs once and a lost executor recomputes
    from here."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def reply_delay(seq: Column, modulus: int) -> Column:
    """Reply time model used with the driver's tables: ts + (seq mod m) seconds."""
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.pmod(seq, F.lit(modulus)).cast("decimal(8,6)"))


PAYMENT_DELAY_MOD = 7
STOCK_DELAY_MOD = 23


class SagaResult:
    """Stages of one saga run, each planned on first use (a query needing only
    the credit side never folds the stock side)."""

    def __init__(self, orders_full: DataFrame, lim: Limits, persist: bool,
                 delays: tuple[int, int] | None, fold: str, stored: bool):
        self.orders_full, self.lim, self._persist, self.delays = orders_full, lim, persist, delays
        self._stored = stored
        self._reserve = reserve_split if fold == "range" else rv.reserve

    def with_stages(self, **stages: DataFrame) -> "SagaResult":
        """Use already computed (e.g. written and re-read) stages:
        ``payment``, ``stock`` and/or ``decisions``."""
        for name, df in stages.items():
            if name not in ("payment", "stock", "decisions"):
                raise ValueError(name)
            self.__dict__[name] = df      # fills the cached_property
        return self

    def _fold(self, side: rv.Side) -> DataFrame:
        out = self._reserve(self.orders_full, side)
        return materialize(out) if self._persist else out

    @cached_property
    def payment(self) -> DataFrame:
        """R1 rows."""
        return self._fold(rv.payment_side(self.lim))

    @cached_property
    def stock(self) -> DataFrame:
        """R2 rows."""
        return self._fold(rv.stock_side(self.lim))

    def prepare_both(self) -> "SagaResult":
        """Prepare the two folds concurrently (their eager jobs are
        independent, so they overlap instead of queueing). Both read the orders
        from one checkpoint, so lines are aggregated once."""
        missing = [n for n in ("payment", "stock") if n not in self.__dict__]
        if len(missing) == 2:
            if not self._stored:
                self.orders_full, self._stored = materialize(self.orders_full), True
            with ThreadPoolExecutor(max_workers=2) as pool:
                fold = inheritable_thread_target(self.orders_full.sparkSession)(lambda n: getattr(self, n))
                for name, df in zip(missing, pool.map(fold, missing)):
                    self.__dict__[name] = df
        return self

    @cached_property
    def decisions(self) -> DataFrame:
        """J1 + J2 + E5 rows with an ``error`` column."""
        self.prepare_both()
        pay_replies, stk_replies = with_reply_times(rt.replies(self.payment), rt.replies(self.stock),
                                                    self.delays)
        return dc.decisions(pay_replies, stk_replies, self.lim)

    def payment_balance(self) -> DataFrame:
        return rv.balances(self.payment, rv.payment_side(self.lim))

    def stock_balance(self) -> DataFrame:
        return rv.balances(self.stock, rv.stock_side(self.lim))

    def settled(self, side: rv.Side) -> DataFrame:
        self.prepare_both()
        folded = self.payment if side.source == rv.payment_side(self.lim).source else self.stock
        ok, _ = rt.split(self.decisions)
        return rv.settle(rv.balances(folded, side), rv.settlement_deltas(ok, side), side)


def with_reply_times(pay_replies: DataFrame, stk_replies: DataFrame,
                     delays: tuple[int, int] | None) -> tuple[DataFrame, DataFrame]:
    if delays is None:
        return pay_replies, stk_replies
    return (pay_replies.withColumn("ts", F.col("ts") + reply_delay(F.col("seq"), delays[0])),
            stk_replies.withColumn("ts", F.col("ts") + reply_delay(F.col("seq"), delays[1])))


def run(orders_full: DataFrame, lim: Limits, persist: bool = False,
        delays: tuple[int, int] | None = (PAYMENT_DELAY_MOD, STOCK_DELAY_MOD),
        fold: str = "range", stored: bool = False) -> SagaResult:
    """``orders_full``: successful enriched orders with ``ts`` and ``seq``.

    ``delays``: reply-time model (seconds = seq mod m per side); None keeps the
    order's own time on both replies, as a stream processor would.
    ``fold``: "range" splits hot keys over many tasks (reservation_split);
    "hash" streams every key through one task. ``persist`` checkpoints each
    fold's output (for callers reading it several times). ``stored``:
    ``orders_full`` reads a table or a checkpoint, so nothing is gained by
    storing it for the two folds.
    """
    return SagaResult(orders_full, lim, persist, delays, fold, stored)
