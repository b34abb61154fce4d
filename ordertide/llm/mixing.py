"""Mixing sources to target weights.

Every document gets a hash-random key. Within its source the documents are
range-partitioned on that key: the key is uniform, so equal key ranges hold
about equal numbers of documents, and their bounds are a formula, the same in
every run. Word counts are summed per range, the range totals are prefix-summed,
and a running sum inside each range is added to its range's offset. A source
whose budget is ``e`` whole epochs and ``r`` more words takes every document
``e`` times and cuts the next epoch exactly after ``r`` words, inside a document
if need be.

Only (doc_id, source, text hash, size) rows are shuffled, never texts. Equal ones are
counted before the shuffle and travel as one row, so a text that is repeated without a
doc_id, or a repeated document, weighs on no range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordertide.session import checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"
#: Documents per key range. A range is one window partition.
RANGE_ROWS = 20_000
#: Repeats of a row that are written out at a time.
REPEATS = 10_000
#: Sources up to this number are joined by broadcast (five numbers each).
BROADCAST_SOURCES = 10_000


def word_count(text):
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """Targets of the sources (source, source_size, ...): weights repeat over the
    sources by code point, null last, and share the sum of all sizes. A target
    stops at ``max_epochs`` times its source's size, the excess is shared again by
    weight until none is above: targets are min(cap, level * weight) for the one
    level at which they add up. In ascending cap / weight, the capped sources come
    first, so running sums over one row per source find that level."""
    n = len(weights)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % n + 1).cast("int"))
    s = sources.withColumn("weight", weight.cast("long"))
    s = s.withColumn("cap", F.lit(max_epochs) * F.col("source_size"))
    s = s.withColumn("ratio", F.col("cap").cast("double") / F.col("weight"))
    every = Window.partitionBy()
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns({
        "capped": F.coalesce(F.sum("cap").over(before), F.lit(0)),
        "spent": F.coalesce(F.sum("weight").over(before), F.lit(0)),
        "total": F.sum("source_size").over(every),
        "weights": F.sum("weight").over(every),
    })
    level = (F.col("total") - F.col("capped")).cast("double") / (F.col("weights") - F.col("spent"))
    s = s.withColumn("level", level)
    first_free = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "spent", "level"))).over(every)
    s = s.withColumn("target", F.least(F.col("cap").cast("double"), first_free["level"] * F.col("weight")))
    return s.select("source", "source_size", "n_docs", F.coalesce("target", F.lit(0.0)).alias("target"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3,
                seed: str = "mix", range_rows: int = RANGE_ROWS) -> DataFrame:
    """Per row of ``docs`` (doc_id, source, text; other columns are ignored):
    doc_id, source, text_hash, size, source_size, target, taken.

    Null text and empty text: size 0, taken 0. Null source: a source of its own,
    last. Null doc_id and repeated rows: each row is a document; rows of one doc_id
    share a key and follow each other by size, then text hash; rows without one have
    their text's key. Of equal rows the cut takes one after the other. Very long texts:
    counted whole. Empty table: no rows. (Different texts under one doc_id share a range,
    however many they are.)
    """
    checkpoint_dir(docs.sparkSession)
    rows = docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash"), word_count(F.col("text")).alias("size"))
    # four values and a count a row, read twice below: counted once, and the same rows in any rerun of a task
    rows = rows.groupBy(*rows.columns).agg(F.count("*").alias("n")).checkpoint()
    sources = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count("*").alias("n_docs"))
    targets = source_targets(sources, weights, max_epochs).withColumnRenamed("source", "s_source").checkpoint()
    if targets.count() <= BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    key = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), "text_hash"))))
    ranges = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / F.lit(range_rows)))
    part = F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("double") * ranges / F.lit(2.0**32))
    rows = (rows.withColumn("key", key)
            .join(targets, F.col("source").eqNullSafe(F.col("s_source"))).drop("s_source")
            .withColumn("part", part))
    # names for (source, part) that join without nulls
    rows = rows.withColumn("src", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")))
    totals = rows.groupBy("src", "part").agg(F.sum(F.col("size") * F.col("n")).alias("part_size"))
    ahead = Window.partitionBy("src").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("src").alias("t_src"), F.col("part").alias("t_part"),
                           F.coalesce(F.sum("part_size").over(ahead), F.lit(0)).alias("offset"))
    rows = rows.join(totals, (F.col("src") == F.col("t_src")) & (F.col("part") == F.col("t_part")))
    so_far = (Window.partitionBy("src", "part").orderBy("key", "doc_id", "size", "text_hash")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    every = F.col("size") * F.col("n")
    start = F.col("offset") + F.sum(every).over(so_far) - every
    budget = F.floor("target")
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rows = rows.withColumns({"start": start, "epochs": whole.cast("long")})
    rest = budget - F.col("epochs") * F.col("source_size")
    # the equal rows of a group, a bounded number at a time
    rows = rows.withColumn("rest", rest - F.col("start"))
    rows = rows.withColumn("from", F.explode(F.expr(f"sequence(0L, n - 1, {REPEATS}L)")))
    rows = rows.withColumn("nth", F.explode(F.expr(f"sequence(from, least(from + {REPEATS - 1}L, n - 1))")))
    cut = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("nth") * F.col("size")))
    taken = F.col("epochs") * F.col("size") + cut
    return rows.select("doc_id", "source", "text_hash", "size", "source_size", "target", taken.cast("long").alias("taken"))


def apply_mix(docs: DataFrame, mix: DataFrame) -> DataFrame:
    """``docs`` as the mix takes them: a row for each whole time, and one cut after its
    last word taken. Rows without words are kept once. Rows of one doc_id, source and
    text follow each other in the mix, so what it takes of them together is dealt to
    them one after the other, in the order of their other columns."""
    same = ["no_id", "id", "src", "text_hash"]

    def keyed(df: DataFrame, text_hash, *more) -> DataFrame:
        """The row key in columns that join without nulls."""
        return df.select(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"),
                         F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("src"), text_hash.alias("text_hash"), *more)

    mix = keyed(mix.where("size > 0"), F.col("text_hash"), "size", "taken")
    mix = mix.groupBy(*same).agg(F.max("size").alias("size"), F.sum("taken").alias("taken"), F.count("*").alias("alike"))
    # packed, so that no column of docs meets a name used here
    others = F.to_json(F.struct(*(f"`{c}`" for c in docs.columns if c != "text")))
    rows = keyed(docs, F.xxhash64("text"), F.struct(*(f"`{c}`" for c in docs.columns)).alias("doc"), others.alias("others"),
                 F.coalesce("text", F.lit("")).rlike(WORD).alias("worded"))

    def column(c: str):
        return F.col("doc").getField(c)

    blank = rows.where("not worded").select(*(column(c).alias(c) for c in docs.columns))
    rows = rows.where("worded").join(mix, same)
    before = F.row_number().over(Window.partitionBy(*same).orderBy("others")) - 1  # of the rows that are alike
    rest = F.col("taken") % (F.col("alike") * F.col("size")) - F.col("before") * F.col("size")
    rest = F.greatest(F.lit(0), F.least(F.col("size"), rest))
    share = F.floor(F.col("taken") / (F.col("alike") * F.col("size"))) * F.col("size") + rest
    rows = rows.withColumn("before", before).withColumn("share", share.cast("long"))
    whole = F.floor(F.col("share") / F.col("size")).cast("int")
    rest = (F.col("share") % F.col("size")).cast("int")
    head = F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>"))
    rows = rows.withColumn("words", F.explode(F.concat(F.array_repeat(F.lit(-1), whole), head)))
    # each word with the white space before it
    split = F.regexp_extract_all(column("text"), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    text = F.when(F.col("words") < 0, column("text")).otherwise(F.array_join(F.slice(split, 1, F.greatest("words", F.lit(0))), ""))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("words") < 0, column("n_chars")).otherwise(F.length(text).cast("long"))
    return rows.select(*(changed.get(c, column(c)).alias(c) for c in docs.columns)).unionAll(blank)


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH d AS (SELECT doc_id, source,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w FROM d GROUP BY source),
l AS (SELECT *, 3 * source_size / w AS ratio,
    coalesce(sum(3 * source_size) OVER b, 0) AS capped, coalesce(sum(w) OVER b, 0) AS spent,
    sum(source_size) OVER () AS total, sum(w) OVER () AS ws FROM s
    WINDOW b AS (ORDER BY 3 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT *, CAST(total - capped AS DOUBLE) / CAST(ws - spent AS DOUBLE) AS level FROM l),
f AS (SELECT level FROM v WHERE level <= ratio ORDER BY ratio, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), f.level * w) AS target FROM v, f),
k AS (SELECT d.doc_id, d.size, t.source_size, t.target,
    CAST(floor(t.target) AS BIGINT) AS budget,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('mix:' || d.doc_id), d.doc_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS start
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
    CAST(CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
        + greatest(0, least(size, budget % source_size - start)) END AS BIGINT) AS taken
FROM k
"""
