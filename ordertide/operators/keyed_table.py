"""A table of one row per key that batches change (K1, R4): base, deltas, tombstones.

A batch's changed rows are one delta. Readers take the latest of base and deltas per
key. Every ``merge_every`` batches the deltas are merged into a new base, bucket by
bucket of the key's hash, and keys that were deleted go. What belongs to a batch becomes
visible by one empty file whose name says it all (batch and attempt), made after the
data: a reader sees a batch whole or not at all, and a batch that is there is never
written again. Deltas and bases that a newer base replaces stay for ``keep`` bases, so
readers that began before can end; older ones are deleted. So the number of files is
bounded by buckets, ``merge_every`` and ``keep``, not by batches.

Nothing but names of batches comes to the driver. A row's ``deleted`` is its tombstone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.operators import commits

BATCH, BUCKET, DELETED = "_batch", "_bucket", "deleted"
#: Rows of a page of a base: what a lookup of one key reads.
PAGE_ROWS = 500


@dataclass(frozen=True)
class KeyedTable:
    root: str
    schema: str                # DDL of key and value columns
    key: str
    buckets: int = 16
    merge_every: int = 8
    keep: int = 2

    def _full(self) -> str:
        return f"{self.schema}, {DELETED} boolean, {BATCH} long, {BUCKET} int"

    def _there(self, spark: SparkSession, kind: str) -> dict[int, str]:
        return {int(b): a for b, a in commits.committed(spark, self.root, kind).items()}

    def _folder(self, kind: str, batch: int, attempt: str) -> str:
        return commits.data_folder(self.root, kind, commits.number(batch), attempt)

    def apply(self, changes: DataFrame, batch: int) -> bool:
        """The rows of ``changes`` (key, values and optionally ``deleted``; one row a key)
        replace those of their keys as of ``batch``. False: the batch was there already."""
        spark = changes.sparkSession
        if any(batch <= b for b in self._there(spark, "base")):
            return False
        if DELETED not in changes.columns:
            changes = changes.withColumn(DELETED, F.lit(False))
        rows = changes.withColumns({BATCH: F.lit(batch).cast("long"), BUCKET: self._bucket()})
        if not commits.write_once(spark, self.root, "delta", commits.number(batch), rows.write.parquet):
            return False
        self._merge_if_due(spark)
        return True

    def read(self, spark: SparkSession, before: int | None = None, raw: bool = False, keys: Sequence | None = None) -> DataFrame:
        """The table, or what it was before a batch that isn't older than the base. With
        ``keys``, only their rows: files of other buckets aren't opened, and of a bucket's
        file, which is sorted, only the pages that may hold one of them are read."""
        bases, deltas = self._there(spark, "base"), self._there(spark, "delta")
        upto = max((b for b in bases if before is None or b < before), default=-1)
        if upto < 0 and len(bases) >= self.keep:
            raise ValueError(f"batch {before} is older than all bases kept")
        paths = [self._folder("base", upto, bases[upto])] if upto >= 0 else []
        paths += [self._folder("delta", b, a) for b, a in deltas.items() if b > upto and (before is None or b < before)]
        if not paths:
            found = spark.createDataFrame([], self._full())
        else:
            found = spark.read.schema(self._full()).parquet(*paths)
        if keys is not None:
            wanted = spark.createDataFrame([(k,) for k in keys], found.select(self.key).schema)
            where = F.lit(False)
            of: dict[int, list] = {}
            for b, k in wanted.select(self._bucket(), self.key).collect():
                of.setdefault(b, []).append(k)
            for b, ks in of.items():  # a bucket is asked for its own keys only
                where = where | (F.col(BUCKET) == b) & F.col(self.key).isin(*ks)
            found = found.where(where)
        values = [c for c in found.columns if c not in (self.key, BATCH, BUCKET)]
        # a partial maximum: a key costs one row for each file that holds it
        found = found.groupBy(BUCKET, self.key).agg(F.max_by(F.struct(*values, BATCH), BATCH).alias("_row"))
        if raw:
            return found.select(BUCKET, self.key, "_row.*")
        return found.select(self.key, "_row.*").where(f"not {DELETED}").drop(DELETED, BATCH)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int").alias(BUCKET)

    def lookup(self, spark: SparkSession, keys: Sequence) -> DataFrame:
        """K3: a row for each of ``keys``, with ``found``."""
        rows = self.read(spark, keys=keys).withColumn("_found", F.lit(True))
        asked = spark.createDataFrame([(k,) for k in keys], rows.select(self.key).schema)
        return asked.join(rows, self.key, "left").withColumn("found", F.coalesce("_found", F.lit(False))).drop("_found")

    def history(self, spark: SparkSession) -> DataFrame:
        """R4 as of batches: the rows of all deltas kept, with their ``batch``."""
        deltas = self._there(spark, "delta")
        paths = [self._folder("delta", b, a) for b, a in deltas.items()]
        found = spark.read.schema(self._full()).parquet(*paths) if paths else spark.createDataFrame([], self._full())
        return found.drop(BUCKET).withColumnRenamed(BATCH, "batch")

    def _merge_if_due(self, spark: SparkSession) -> None:
        bases, deltas = self._there(spark, "base"), self._there(spark, "delta")
        last = max(bases, default=-1)
        later = [b for b in deltas if b > last]
        if len(later) < self.merge_every:
            return
        upto = max(later)
        merged = self.read(spark, raw=True).where(f"not {DELETED}")
        # one file a bucket, sorted by key: a lookup's key range skips most row groups
        merged = merged.repartition(self.buckets, BUCKET).sortWithinPartitions(BUCKET, self.key)
        commits.write_once(spark, self.root, "base", commits.number(upto),
                           merged.write.option(f"parquet.bloom.filter.enabled#{self.key}", "true")
                           .option("parquet.page.row.count.limit", str(PAGE_ROWS)).parquet)
        kept = sorted([*bases, upto])[-self.keep:]
        if len(kept) < self.keep:
            return
        for kind, found in (("base", bases), ("delta", deltas)):
            for b, a in found.items():
                if b < kept[0] or kind == "delta" and b == kept[0]:
                    commits.delete_batch(spark, self.root, kind, commits.number(b), a)
