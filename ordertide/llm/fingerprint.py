"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over seven bytes marks chunk ends: at block size ``3 * 2**k`` a
byte ends a chunk if the hash plus one is divisible by it, so the ends at twice
a block size are a subset of those at the block size. Each chunk gives one of 64
characters. The block size follows from the text's length, so that 24 to 48
characters are usual, and doubles while the whole text (one of few different
bytes) makes more than 128; the signature at twice that size is kept too. Two fingerprints
compare where their block sizes are equal or one is twice the other, by edit
distance.

Comparing each document with the next one needs neighbours in doc_id order. The
documents are shuffled once into ranges of doc_id with fixed bounds; each
range's first document is also sent to the range before it.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.llm.arrow import arrow_schema, record_batch

WINDOW = 7
#: Characters that a signature has on average at most, and at most.
USUAL = 48
LONGEST = 128
#: Characters in a row that two signatures must share.
COMMON = 4
#: Ranges of doc_id for each shuffle partition.
RANGES_PER_PARTITION = 4
_CHARS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", dtype=np.uint8)
_ROLL = np.random.default_rng(7).integers(1, 2**32, size=256, dtype=np.uint32)
_CHUNK = np.random.default_rng(11).integers(1, 2**63, size=256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int, way: str) -> np.ndarray:
    """Powers 0..n-1 of the base (up) or of its inverse (down), modulo 2**64."""
    if len(_POWERS[way]) < n:
        size = 1 << (n - 1).bit_length()
        step = np.full(size, _BASE if way == "up" else _INVERSE, np.uint64)
        step[0] = 1
        _POWERS[way] = np.cumprod(step)
    return _POWERS[way][:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(text: str | None) -> str:
    """``k:signature:signature at twice the block size``; of no text: ``0::``."""
    b = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    n = len(b)
    if not n:
        return "0::"
    t = _ROLL[b]
    r = t.copy()
    for j in range(1, min(WINDOW, n)):
        r[j:] += t[:-j] * np.uint32(pow(0x01000193, j, 2**32))
    ends = np.flatnonzero((r + np.uint32(1)) % np.uint32(3) == 0)
    third = (r[ends] + np.uint32(1)) // np.uint32(3)
    low = third & (~third + np.uint32(1))  # its lowest bit; a hash of all ones divides by anything
    level = np.where(third == 0, 32, np.log2(np.maximum(low, 1)).astype(np.int64))
    k = max(0, (len(text) - 1) // (3 * USUAL)).bit_length()
    while np.count_nonzero(level >= k) >= LONGEST:
        k += 1
    sums = np.concatenate(([np.uint64(0)], np.cumsum(_CHUNK[b] * _powers(n, "up"), dtype=np.uint64)))
    down = _powers(n, "down")

    def signature(at: int) -> str:
        cuts = ends[level >= at] + 1
        starts = np.concatenate(([0], cuts[cuts < n]))
        stops = np.append(starts[1:], n)
        h = _mixed((sums[stops] - sums[starts]) * down[starts])
        return _CHARS[(h >> np.uint64(58)).astype(np.int64)].tobytes().decode()

    return f"{k}:{signature(k)}:{signature(k + 1)}"


def _alike(a: str, b: str) -> float:
    """1 - (insertions and deletions between a and b) / (their lengths); 0 unless
    they share a run of COMMON characters (of all, if one is shorter)."""
    if a == b:
        return 1.0 if a else 0.0
    n = min(len(a), len(b), COMMON)
    if not n or not ({a[i:i + n] for i in range(len(a) - n + 1)} & {b[i:i + n] for i in range(len(b) - n + 1)}):
        return 0.0
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    every = row = (1 << len(a)) - 1
    for c in b:  # a bit is cleared where the longest common subsequence grows
        hit = row & at.get(c, 0)
        row = ((row + hit) | (row - hit)) & every
    return 2 * (len(a) - row.bit_count()) / (len(a) + len(b))


def likeness(x: str, y: str) -> float:
    """0 to 1, at compatible block sizes; 0 at others. Equal fingerprints: 1."""
    if x == y:
        return 1.0
    (kx, x1, x2), (ky, y1, y2) = x.split(":"), y.split(":")
    gap = int(kx) - int(ky)
    if gap == 0:
        return max(_alike(x1, y1), _alike(x2, y2))
    return _alike(x1, y2) if gap == 1 else _alike(x2, y1) if gap == -1 else 0.0


def edited(text: str, after: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + after[:half]


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _compare(batches):
    """Rows (part, ahead, doc_id, text) in order; each but those ahead gives a row."""
    schema = arrow_schema(SCHEMA)
    held = None  # part, doc_id, text, fingerprint
    for batch in batches:
        out = []
        for part, ahead, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            print_ = None
            if held and held[0] == part:
                print_ = fingerprint(text)
                changed = edited(held[2], text)
                new = fingerprint(changed)
                out.append((held[1], len(held[2]), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                            held[3], new, likeness(held[3], new), likeness(held[3], print_)))
            held = None if ahead else (part, doc_id, text, print_ or fingerprint(text))
        if out:
            yield record_batch(list(zip(*out, strict=True)), schema)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are ignored): its
    fingerprint, that of its edited text, and the likeness to the edited text and
    to the next document in ascending doc_id (after the last, the first).

    Null text: empty. Null doc_id: before all others. Rows of one doc_id are
    documents that follow each other by text, then in any order. A single row is
    its own next document. Empty table: no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("ord", F.coalesce("doc_id", F.lit(-(2**63))))
    n = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted(set(docs.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.25 / n) or [0.0]))
    ranges = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="at", outputCol="part")
    docs = ranges.transform(docs.withColumn("at", F.col("ord").cast("double"))).withColumn("part", F.col("part").cast("int"))
    # one row for each range
    firsts = sorted(docs.groupBy("part").agg(F.min("ord")).collect())
    before = [(o, firsts[i - 1][0]) for i, (_, o) in enumerate(firsts)]
    before = spark.createDataFrame(before, "f_ord long, f_part int")
    docs = docs.join(F.broadcast(before), F.col("ord") == F.col("f_ord"), "left")
    own = F.struct(F.col("part"), F.lit(False).alias("ahead"))
    next_ = F.struct(F.col("f_part").alias("part"), F.lit(True).alias("ahead"))
    docs = docs.withColumn("to", F.explode(F.when(F.col("f_part").isNull(), F.array(own)).otherwise(F.array(own, next_))))
    docs = (docs.select("to.part", "to.ahead", "ord", "doc_id", "text").repartition("part")
            .sortWithinPartitions("part", "ahead", "ord", "text").drop("ord"))
    return docs.mapInArrow(_compare, SCHEMA)


def op10_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
