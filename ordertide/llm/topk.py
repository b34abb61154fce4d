"""Exact top-k search by inner product with a bit-sliced index.

Vectors are turned into integers and indexed in blocks of rows: for each
attribute and bit one bitmap over the block's rows. A query adds the slices of
all attributes, weighted by the bits of its own components, with bitmap full
adders, without the lowest slices. It then takes the top rows from the most
significant sum slice downward. The lowest slices could add only a known amount,
so rows within that amount of the last one are its boundary: their scores are
computed exactly, and only those decide.

Every block of queries meets every block of rows once; each keeps its best k.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordertide.llm.arrow import arrow_schema, record_batch

ROWS = 16_384
QUERIES = 512
#: Slices that the sum leaves out.
DROPPED = 2


def whole_numbers(df: DataFrame, id_col: str, vector: str, scale: int) -> DataFrame:
    """(id, ints, copies): floor(scale * x) of each component; equal rows once, counted.
    Rows with a null id, a null or empty vector, or a null or non-finite component go."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector).alias("x")).where(
        F.col("id").isNotNull() & F.col("x").isNotNull())
    rows = rows.where((F.size("x") > 0) & ~F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    ints = F.transform("x", lambda c: F.floor(c.cast("double") * scale).cast("long"))
    return rows.select("id", ints.alias("ints")).groupBy("id", "ints").agg(F.count("*").alias("copies"))


def _pack(batches: pa.Table) -> tuple[bytes, bytes, bytes, int]:
    ids = batches["id"].to_numpy().astype(np.int64)
    ints = np.stack([np.asarray(v, np.int64) for v in batches["ints"].to_pylist()])
    order = np.lexsort((*ints.T[::-1], ids))
    copies = batches["copies"].to_numpy().astype(np.int64)
    return ids[order].tobytes(), copies[order].tobytes(), ints[order].tobytes(), len(ids)


PACKED = "dim int, block int, ids binary, copies binary, ints binary, n int"


def _packed(df: DataFrame, size: int) -> tuple[DataFrame, int]:
    """Blocks of about ``size`` rows as one row each, and how many blocks there are."""
    n = max(1, -(-df.count() // size))
    block = F.pmod(F.xxhash64("id", "ints"), F.lit(n)).cast("int")
    df = df.withColumn("dim", F.size("ints")).withColumn("block", block)

    def pack(key, table):
        return pa.Table.from_batches([record_batch(
            [[key[0].as_py()], [key[1].as_py()], *([v] for v in _pack(table))], arrow_schema(PACKED))])
    return df.groupBy("dim", "block").applyInArrow(pack, PACKED), n


class BitSlices:
    """The index of one block: ``slices[d, j]`` is the bitmap of bit j of attribute
    d, above the attribute's least value."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, ints: np.ndarray):
        self.ids, self.copies, self.ints = ids, copies, ints
        self.least = ints.min(0)
        above = (ints - self.least).T
        self.bits = max(1, int(above.max()).bit_length())
        self.top = (1 << self.bits) - 1
        words = -(-len(ids) // 64)
        plain = np.zeros((len(above), self.bits, words * 64), np.uint8)
        for j in range(self.bits):
            plain[:, j, :len(ids)] = (above >> j) & 1
        self.slices = np.packbits(plain, axis=2, bitorder="little").view(np.uint64)
        self.all = self._bitmap(np.arange(len(ids)))

    def _bitmap(self, rows: np.ndarray) -> np.ndarray:
        plain = np.zeros(self.slices.shape[2] * 64, np.uint8)
        plain[rows] = 1
        return np.packbits(plain, bitorder="little").view(np.uint64)

    def sums(self, query: np.ndarray, dropped: int) -> list[np.ndarray]:
        """Slices of sum(|q| * (y >> dropped)), lowest first; y is the attribute above
        its least value, or, under a negative q, below the largest value of its bits."""
        size = np.abs(query)
        at: dict[int, list[np.ndarray]] = {}
        for bit in range(int(size.max()).bit_length() if len(size) else 0):
            for neg in (False, True):
                use = np.flatnonzero(((size >> bit) & 1 == 1) & ((query < 0) == neg))
                if len(use):
                    for j in range(dropped, self.bits):
                        s = self.slices[use, j]
                        at.setdefault(bit + j - dropped, []).append(~s if neg else s)
        made, w = [], 0
        while at:
            here = at.pop(w, [])
            rows = np.concatenate(here) if here else np.zeros((1, len(self.all)), np.uint64)
            carries = []
            while len(rows) > 1:  # full adders on thirds of the bitmaps, a half adder on a last pair
                n = len(rows) // 3
                if n:
                    a, b, c = rows[:n], rows[n:2 * n], rows[2 * n:3 * n]
                    ab = a ^ b
                    carries.append((a & b) | (ab & c))
                    rows = np.concatenate((ab ^ c, rows[3 * n:]))
                else:
                    carries.append(rows[:1] & rows[1:])
                    rows = rows[:1] ^ rows[1:]
            made.append(rows[0])
            if carries:
                at.setdefault(w + 1, []).extend(carries)
            w += 1
        return made

    def best(self, query: np.ndarray, own: int, k: int, dropped: int = DROPPED) -> list[tuple[int, int, int]]:
        """(score, id, copies) of the rows that hold the k highest scores; ties to the
        smaller id; rows with the id ``own`` take no part."""
        first, last = np.searchsorted(self.ids, [own, own + 1])
        left = self.all if first == last else self.all & ~self._bitmap(np.arange(first, last))
        dropped = min(dropped, self.bits - 1)
        sums = self.sums(query, dropped)
        sure, equal, level = np.zeros_like(left), left, 0
        for j in range(len(sums) - 1, -1, -1):
            more = equal & sums[j]
            n = int(np.bitwise_count(sure | more).sum())
            if n >= k:
                equal, level = more, level | 1 << j
            else:
                sure, equal = sure | more, equal & ~sums[j]
        # level: the kth highest sum. What was dropped could lift rows this far below it.
        level = max(0, level - int(np.abs(query).sum() * ((1 << dropped) - 1) >> dropped) - 1)
        above, equal = np.zeros_like(left), left
        for j in range(max(len(sums), level.bit_length()) - 1, -1, -1):
            s = sums[j] if j < len(sums) else np.zeros_like(left)
            if level >> j & 1:
                equal = equal & s
            else:
                above, equal = above | (equal & s), equal & ~s
        rows = np.flatnonzero(np.unpackbits((above | equal).view(np.uint8), bitorder="little"))
        scores = self.ints[rows] @ query
        order = np.lexsort((self.ids[rows], -scores))[:k]
        return [(int(scores[i]), int(self.ids[rows[i]]), int(self.copies[rows[i]])) for i in order]


FOUND = "query_no long, query_id long, vec_id long, score long, copies long"


def _search(k: int):
    def run(batches):
        schema = arrow_schema(FOUND)
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                read = lambda name, row=row: np.frombuffer(row[name], np.int64)
                index = BitSlices(read("ids"), read("copies"), read("ints").reshape(-1, dim))
                out = []
                for i, (own, query) in enumerate(zip(read("q_ids"), read("q_ints").reshape(-1, dim), strict=True)):
                    no = row["q_block"] * 2**32 + i
                    out += [(no, int(own), vec, score, min(copies, k)) for score, vec, copies in index.best(query, int(own), k)]
                if out:
                    yield record_batch(list(zip(*out, strict=True)), schema)
    return run


def top_k(rows: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, id_col: str = "vec_id",
          vector: str = "embedding", block_rows: int = ROWS, block_queries: int = QUERIES) -> DataFrame:
    """For each row of ``queries`` its k highest integer inner products with ``rows``
    but those of its own id: query_id, rank from 1, vec_id, score; ties go to the
    smaller vec_id.

    Components count as floor(scale * x). Null ids, null or empty vectors and vectors
    with null or non-finite components take no part. Vectors meet those of their own
    length only. Repeated rows count each on its own as candidates, once as queries.
    Fewer than k candidates: all of them; empty tables: no rows."""
    index, n_blocks = _packed(whole_numbers(rows, id_col, vector, scale), block_rows)
    asked, n_asked = _packed(whole_numbers(queries, id_col, vector, scale), block_queries)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    index = index.select("dim", "block", "ids", "copies", "ints", each(n_asked).alias("q_block"))
    asked = asked.select("dim", F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("ints").alias("q_ints"),
                         each(n_blocks).alias("block"))
    pairs = index.join(asked, ["dim", "block", "q_block"])
    found = pairs.mapInArrow(_search(k), FOUND)
    order = Window.partitionBy("query_no", "query_id").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k)
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    order = Window.partitionBy("query_no", "query_id").orderBy(F.desc("score"), "vec_id", "copy")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")


def op6_topk(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(rows, rows.where(F.col("vec_id") % 50 == 0))


ORACLE = """
WITH v AS (SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS ints FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.ints, c.ints) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
