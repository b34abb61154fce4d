"""Phrase collocations from counting quotient filters.

Words that occur ten times or more in a language get numbers. The two or three
numbers of an n-gram are packed into as many bits as the largest number needs three
times (34 at least, 96 at most), which an invertible permutation (a Feistel network
over two halves) spreads evenly. The first 32 bits are the quotient, the others the
remainder, kept in full: a filter holds exactly the n-grams that were put in. It is
sorted by quotient and remainder; an n-gram takes the bytes of its remainder, one or
more count bytes and its share of the run lengths of the quotients that occur.

Each block of documents makes one filter, cut by the quotient's high bits. Filters of
the same cut are merged as they come and their counts added. The permutation then
gives the word numbers back. No cut is hot: an n-gram is once in each block's filter,
however often it occurs, and all cuts get about the same number of entries.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ordertide.llm.stored import stored, text_blocks

#: Characters of text in a block.
BLOCK_CHARS = 8_000_000
#: Word occurrences per cut of the quotients (about a task's work; decides costs only).
CUT_WORDS = 4_000_000
#: Least occurrences of a candidate phrase.
LEAST = 10
#: A candidate goes if a longer one has this share of its occurrences, in percent.
COVERED = 50
#: Phrases kept for each language.
KEPT = 2_000
#: Parts of a language that are ranked apart first.
SALTS = 256

_ROUNDS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))
_LOW = 2**32 - 1
#: A-Z small, tabs as spaces, the ends of pieces as line ends.
_SMALL = bytes(c + 32 if 65 <= c <= 90 else 32 if c == 9 else 10 if c in b".,;:!?\n\x0b\x0c\r" else c for c in range(256))


class Permutation:
    """Of rows of three numbers of ``bits`` bits, to quotients of 32 bits and remainders of
    ``3 * bits`` (one more if odd) less 32, and back."""

    def __init__(self, largest: int):
        self.bits = max(int(largest).bit_length(), 11)
        if self.bits > 32:
            raise ValueError("word numbers of more than 32 bits")
        self.half = -(-3 * self.bits // 2)
        self.rest = 2 * self.half - 32  # bits of a remainder
        self.bytes = -(-self.rest // 8)

    def _round(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        x = (x ^ (x >> np.uint64(23))) * key
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x >> np.uint64(64 - self.half)

    def permuted(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        b, h = self.bits, self.half
        w = words.astype(np.uint64)
        # the middle number's high bits go to the left half
        high = h - b
        left = w[:, 0] << np.uint64(high) | w[:, 1] >> np.uint64(b - high)
        right = (w[:, 1] & np.uint64((1 << b - high) - 1)) << np.uint64(b) | w[:, 2]
        for key in _ROUNDS:
            left, right = right, left ^ self._round(right, key)
        if h >= 32:
            return left >> np.uint64(h - 32), (left & np.uint64((1 << h - 32) - 1)) << np.uint64(h) | right
        return left << np.uint64(32 - h) | right >> np.uint64(self.rest), right & np.uint64((1 << self.rest) - 1)

    def restored(self, quotients: np.ndarray, remainders: np.ndarray) -> np.ndarray:
        """The rows of word numbers that ``permuted`` was given."""
        b, h = self.bits, self.half
        if h >= 32:
            left = quotients << np.uint64(h - 32) | remainders >> np.uint64(h)
            right = remainders & np.uint64((1 << h) - 1)
        else:
            left = quotients >> np.uint64(32 - h)
            right = (quotients & np.uint64((1 << 32 - h) - 1)) << np.uint64(self.rest) | remainders
        for key in reversed(_ROUNDS):
            left, right = right ^ self._round(left, key), left
        high = h - b
        middle = (left & np.uint64((1 << high) - 1)) << np.uint64(b - high) | right >> np.uint64(b)
        return np.stack((left >> np.uint64(high), middle, right & np.uint64((1 << b) - 1)), axis=1)


def merged(quotients: np.ndarray, remainders: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted by quotient and remainder, counts of equal ones added."""
    if not len(quotients):
        return quotients, remainders, counts
    if int(remainders.max()) <= _LOW:  # both fit one number
        key = quotients << np.uint64(32) | remainders
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.concatenate(([True], key[1:] != key[:-1]))
    else:
        order = np.lexsort((remainders, quotients))
        q, r = quotients[order], remainders[order]
        new = np.concatenate(([True], (q[1:] != q[:-1]) | (r[1:] != r[:-1])))
    first = np.flatnonzero(new)
    return quotients[order[first]], remainders[order[first]], np.add.reduceat(counts[order], first)


def _varints(x: np.ndarray) -> bytes:
    """Seven bits a byte, the lowest first; the high bit says that more follow."""
    x = x.astype(np.uint64)
    size = np.ones(len(x), np.int64)
    for k in range(1, 10):
        size += x >> np.uint64(7 * k) > 0
    at = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    for k in range(int(size.max(initial=0))):
        has = size > k
        out[at[has] + k] = (x[has] >> np.uint64(7 * k) & np.uint64(127)).astype(np.uint8) | (size[has] > k + 1).astype(np.uint8) << 7
    return out.tobytes()


def _read_varints(data: np.ndarray) -> np.ndarray:
    last = data < 128
    ends = np.flatnonzero(last) + 1
    starts = np.concatenate(([0], ends[:-1]))
    out = np.zeros(len(ends), np.uint64)
    for k in range(int((ends - starts).max(initial=0))):
        has = ends - starts > k
        out[has] |= (data[starts[has] + k].astype(np.uint64) & np.uint64(127)) << np.uint64(7 * k)
    return out


def packed(quotients: np.ndarray, remainders: np.ndarray, counts: np.ndarray, width: int) -> bytes:
    """A filter as bytes, from sorted and different entries: numbers of runs and entries,
    for each run the step from the last quotient and its length, the counts, and
    ``width`` bytes of each remainder, the lowest bytes of all first."""
    new = np.ones(len(quotients), bool)
    new[1:] = quotients[1:] != quotients[:-1]
    first = np.flatnonzero(new)
    steps = _varints(np.diff(quotients[first], prepend=np.uint64(0)))
    runs = _varints(np.diff(np.append(first, len(quotients))))
    numbers = _varints(counts)
    head = np.array([len(quotients), width, len(steps), len(runs), len(numbers)], "<i8").tobytes()
    rest = np.ascontiguousarray(remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return head + steps + runs + numbers + rest.tobytes()


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, width, *sizes = np.frombuffer(data, "<i8", 5).tolist()
    parts, at = [], 40
    for size in sizes:
        parts.append(_read_varints(np.frombuffer(data, np.uint8, size, at)))
        at += size
    steps, runs, counts = parts
    rest = np.zeros((n, 8), np.uint8)
    rest[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n).T
    return np.repeat(np.cumsum(steps), runs.astype(np.int64)), rest.view("<u8").ravel().astype(np.uint64), counts.astype(np.int64)


def _block_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block and language: its different words and their counts, and its texts as
    numbers into them, -1 where a piece ends."""
    for number, rows in text_blocks(batches, BLOCK_CHARS):
        numbers: dict[str, dict[bytes, int]] = {}
        streams: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(rows["lang"].to_pylist(), rows["text"].cast(pa.binary()).to_pylist(), strict=True):
            if not text:
                continue
            if lang not in numbers:
                of = numbers[lang] = defaultdict(None, {b"": 0, b"\n": 1})
                of.default_factory = of.__len__
            found = text.translate(_SMALL).replace(b"\n", b" \n ").split(b" ")
            stream = np.fromiter(map(numbers[lang].__getitem__, found), np.int32, len(found))
            streams.setdefault(lang, []).append(np.append(stream[stream > 0], 1))
        out = []
        for lang, parts in streams.items():
            stream = np.concatenate(parts).astype("<i4") - 2
            words = list(islice(numbers[lang], 2, None))
            counts = np.bincount(stream[stream >= 0], minlength=len(words))
            out.append((number, lang, pa.array(words, pa.binary()).cast(pa.string()), counts, stream.astype("<i4").tobytes()))
        for row in out:
            yield pa.RecordBatch.from_arrays([pa.array([x.to_pylist() if isinstance(x, pa.Array) else x], t) for x, t in zip(row, _WORDED.types, strict=True)], schema=_WORDED)


_WORDED = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())), ("stream", pa.binary())])
_WORDED_DDL = "block long, lang string, words array<string>, counts array<long>, stream binary"


def _filters(cuts: int, permutation: Permutation):
    """Filters of a block's n-grams, one row for each cut of the quotients."""
    shift = np.uint64(33 - cuts.bit_length())
    schema = pa.schema([("cut", pa.int64()), ("filter", pa.binary())])

    def run(blocks: pa.Table, known: pa.Table) -> pa.Table:
        if not blocks.num_rows or not known.num_rows:
            return schema.empty_table()
        row = blocks.select(["words", "stream"]).combine_chunks()
        ids = np.zeros(len(row["words"].chunk(0).values) + 1, np.uint64)  # 0: not frequent; the last one is a piece's end
        ids[known["place"].to_numpy()] = known["id"].to_numpy()
        stream = ids[np.frombuffer(row["stream"][0].as_py(), "<i4")]
        two = np.stack((stream[:-1], stream[1:], np.zeros(max(len(stream) - 1, 0), np.uint64)), axis=1)
        three = np.stack((stream[:-2], stream[1:-1], stream[2:]), axis=1)
        grams = np.concatenate((two[(two[:, :2] > 0).all(axis=1)], three[(three > 0).all(axis=1)]))
        q, r, n = merged(*permutation.permuted(grams), np.ones(len(grams), np.int64))
        edge = np.searchsorted(q >> shift, np.arange(cuts + 1, dtype=np.uint64)) if cuts > 1 else np.array([0, len(q)])
        out = [(c, packed(q[a:b], r[a:b], n[a:b], permutation.bytes)) for c, (a, b) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)) if b > a]
        return pa.Table.from_pylist([dict(zip(schema.names, x, strict=True)) for x in out], schema)
    return run


def _merge(filters: Iterator[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merged one after another, each with those before it that aren't much larger."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for f in filters:
        now = unpacked(f)
        while held and len(held[-1][0]) <= 2 * len(now[0]):
            now = merged(*(np.concatenate(x) for x in zip(held.pop(), now, strict=True)))
        held.append(now)
    while len(held) > 1:
        held.append(merged(*(np.concatenate(x) for x in zip(held.pop(), held.pop(), strict=True))))
    return held[0]


def _filters_of(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
    for batch in batches:
        yield from batch.column(batch.schema.get_field_index("filter")).to_pylist()


def _merge_cut(least: int, permutation: Permutation):
    """The n-grams of a cut that occur ``least`` times."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, r, n = _merge(_filters_of(batches))
        kept = n >= least
        words = permutation.restored(q[kept], r[kept]).astype(np.int64)
        yield pa.record_batch({"w1": words[:, 0], "w2": words[:, 1], "w3": words[:, 2], "a": n[kept]})
    return run


def _dictionary(counted: DataFrame, least: int) -> tuple[DataFrame, int]:
    """(lang, word, f, id) of the words with ``least`` occurrences; ids from 1 without gaps,
    by a count of each partition's words on the driver (one number a partition). Also the
    largest id."""
    frequent = stored(counted.where(F.col("f") >= least), "phrase-words")
    placed = frequent.withColumn("at", F.monotonically_increasing_id())
    part = F.shiftright("at", 33)
    sizes = sorted(tuple(r) for r in placed.groupBy(part.alias("part")).count().collect())
    begins, total = [], 0
    for p, n in sizes:
        begins.append((p, total + 1))
        total += n
    begins = counted.sparkSession.createDataFrame(begins, "part long, begin long")
    placed = placed.withColumn("part", part).join(F.broadcast(begins), "part")
    return stored(placed.select("lang", "word", "f", (F.col("begin") + F.col("at").bitwiseAND((1 << 33) - 1)).alias("id")), "phrase-ids"), total


def phrase_counts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lang, n) of all words; (lang, word, f, id) of the frequent ones; (w1, w2, w3, a) of
    the phrases of two (w3 = 0) and three words with ``least`` occurrences.

    Null text: empty. Null lang: ``und``. Other columns are ignored."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").where("text is not null")
    blocks = stored(texts.mapInArrow(_block_words, _WORDED_DDL), "phrase-blocks")
    words = blocks.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "w"))
    words = words.select("block", "lang", "place", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    counted = stored(words.groupBy("lang", "word").agg(F.sum("n").alias("f")), "phrase-counts")
    sizes = counted.groupBy("lang").agg(F.sum("f").alias("n"))
    dictionary, largest = _dictionary(counted, least)
    total = sizes.agg(F.sum("n")).first()[0] or 0
    cuts = 1 << min(max(-(-total // CUT_WORDS) - 1, 0).bit_length(), 24)
    permutation = Permutation(largest)
    known = words.select("block", "lang", "place", "word").join(dictionary.select("lang", "word", "id"), ["lang", "word"])
    known = known.select(F.col("block").alias("b"), F.col("lang").alias("g"), "place", "id")
    filters = (blocks.groupBy("block", "lang").cogroup(known.groupBy("b", "g"))
               .applyInArrow(_filters(cuts, permutation), "cut long, filter binary"))
    phrases = filters.groupBy("cut").applyInArrow(_merge_cut(least, permutation), "w1 long, w2 long, w3 long, a long")
    return sizes, dictionary, stored(phrases, "phrases")


def _score(a: str, left: str, right: str):
    """floor(1000000 * a * a / (left * right)); counts up to 10**18 are exact."""
    wide = "decimal(19,0)"
    return F.expr(f"cast({a} as decimal(18,0)) * 1000000 * cast({a} as decimal(13,0)) div (cast({left} as {wide}) * cast({right} as {wide}))")


def collocations(docs: DataFrame, least: int = LEAST, covered: int = COVERED, kept: int = KEPT) -> DataFrame:
    """Each language's first ``kept`` phrases of two and three words: lang, rank, phrase, a
    (its occurrences), l and r (those of the two parts of its lowest-scoring cut), n (words
    of the language) and score. Phrases of which a longer candidate has ``covered`` percent
    are left out.

    Null text: empty; null lang: ``und``; doc_ids aren't read, and repeated rows count as
    often as they are there. Ties in score and count go by the phrase's UTF-8 bytes. Texts
    of any length are read whole. Empty table, or no frequent phrase: no rows. Exact up to
    10**12 occurrences of a phrase."""
    sizes, dictionary, phrases = phrase_counts(docs, least)
    word = dictionary.select("id", "f", "word", "lang")
    two = phrases.where("w3 = 0").select("w1", "w2", "a")
    three = phrases.where("w3 > 0")

    def named(df: DataFrame, i: int) -> DataFrame:
        return df.join(word.select(F.col("id").alias(f"w{i}"), F.col("f").alias(f"f{i}"), F.col("word").alias(f"t{i}"), *(["lang"] if i == 1 else [])), f"w{i}")
    pairs = named(named(two, 1), 2)
    within = three.select(F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p"), "a")
    within = within.groupBy("p.w1", "p.w2").agg(F.max("a").alias("longer"))
    pairs = pairs.join(within, ["w1", "w2"], "left").where(f"longer is null or 100 * longer < {covered} * a")
    pairs = pairs.select("lang", F.concat_ws(" ", "t1", "t2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), _score("a", "f1", "f2").alias("score"))
    triples = named(three, 1)
    triples = triples.join(two.select("w1", "w2", F.col("a").alias("f12")), ["w1", "w2"])
    triples = triples.join(two.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("f23")), ["w2", "w3"])
    triples = named(named(triples.drop("f1").join(word.select(F.col("id").alias("w1"), "f"), "w1").withColumnRenamed("f", "f1"), 2), 3)
    triples = triples.withColumn("s1", _score("a", "f1", "f23")).withColumn("s2", _score("a", "f12", "f3"))
    first = F.col("s1") <= F.col("s2")
    triples = triples.select("lang", F.concat_ws(" ", "t1", "t2", "t3").alias("phrase"), "a", F.when(first, F.col("f1")).otherwise(F.col("f12")).alias("l"),
                             F.when(first, F.col("f23")).otherwise(F.col("f3")).alias("r"), F.least("s1", "s2").alias("score"))
    best = pairs.unionByName(triples).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    # the first ones of a language are among the first ones of each part of it
    for keys in (("lang", "salt"), ("lang",)):
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.desc("a"), "phrase")
        best = best.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= kept)
    return best.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_phrases(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
sizes AS (SELECT lang, cast(sum(len(w)) AS BIGINT) AS n FROM split GROUP BY lang),
grams AS (
  SELECT lang, k, list_slice(w, i, i + k - 1) AS g
  FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split), (VALUES (1), (2), (3)) AS lengths(k)
  WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, k, g, count(*) AS a FROM grams GROUP BY lang, k, g HAVING count(*) >= 10),
parts AS (
  SELECT lang, g, a, 1 AS cut, list_slice(g, 1, 1) AS head, list_slice(g, 2, k) AS rest FROM f WHERE k > 1
  UNION ALL SELECT lang, g, a, 2, list_slice(g, 1, 2), list_slice(g, 3, 3) FROM f WHERE k = 3),
heads AS (SELECT p.*, f.a AS l FROM parts p JOIN f ON f.lang = p.lang AND f.g = p.head),
cuts AS (
  SELECT h.lang, h.g, h.a, h.cut, h.l, f.a AS r, cast((cast(1000000 AS HUGEINT) * h.a * h.a) // (cast(h.l AS HUGEINT) * f.a) AS BIGINT) AS score
  FROM heads h JOIN f ON f.lang = h.lang AND f.g = h.rest),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
covered AS (
  SELECT lang, g, max(a) AS longer
  FROM (SELECT lang, list_slice(g, 1, 2) AS g, a FROM f WHERE k = 3 UNION ALL SELECT lang, list_slice(g, 2, 3), a FROM f WHERE k = 3)
  GROUP BY lang, g),
kept AS (SELECT s.* FROM scored s LEFT JOIN covered c ON s.lang = c.lang AND s.g = c.g WHERE c.longer IS NULL OR 100 * c.longer < 50 * s.a)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank,
       array_to_string(g, ' ') AS phrase, a, l, r, n, score
FROM kept k JOIN sizes s ON k.lang = s.lang
QUALIFY rank <= 2000
"""
