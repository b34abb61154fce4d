"""A training corpus in five stages over ``documents``.

toxicity: documents scored toxic go. near_duplicates: one document of each Jaccard
component stays. secrets: secret values are replaced by their kind. mixture:
sources are brought to their target weights, whole documents repeated for whole
epochs, the last one of a source cut after the words that are left. tokens: doc_id
and SentencePiece ids of what is left.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's docs. All but the last return the columns
of documents. SQL expresses neither the toxicity model, the guess costs nor the
tokens, so ORACLE_SQL is None and tests compare the rows with a plain version.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.llm import jaccard, mixing, pieces, secrets, toxicity
from ordertide.session import checkpoint_dir
from ordertide.ship import ship


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted not toxic, by a model fitted to the table's own labels (those
    not held out). A document without a doc_id is scored like any other; nulls count as
    empty texts and stay."""
    ship(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, the one with the smallest doc_id
    (null last), then text hash. Rows of one doc_id and different texts are documents of
    their own; of rows of one doc_id and text, the first by its other columns stays.
    Documents without words are linked with nothing: all stay, but for such repeats of
    a doc_id and text."""
    ship(spark)
    found = jaccard.jaccard_rows(docs).where("label is not null")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("least")
    kept = found.groupBy("label").agg(least).select(
        F.col("least.no_id").alias("k_no_id"), F.coalesce("least.doc_id", F.lit(0)).alias("k_id"), F.col("least.text_hash").alias("k_hash"))
    # packed, so that no column of docs meets a name used here
    columns = [f"`{c}`" for c in docs.columns]
    rows = docs.select(F.struct(*columns).alias("doc"), F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"),
                       F.xxhash64("text").alias("text_hash"), F.coalesce("text", F.lit("")).rlike(mixing.WORD).alias("worded"),
                       F.to_json(F.struct(*(c for c in columns if c != "`text`"))).alias("others"))
    same = (F.col("no_id") == F.col("k_no_id")) & (F.col("id") == F.col("k_id")) & (F.col("text_hash") == F.col("k_hash"))
    named = ["no_id", "id", "text_hash"]

    def first(df: DataFrame) -> DataFrame:
        return df.groupBy(*named).agg(F.min_by("doc", "others").alias("doc")).select("doc")
    # grouped as they are joined, so that texts are shuffled once
    worded = first(rows.where("worded").join(kept, same, "left_semi"))
    blank = rows.where("not worded")
    return worded.unionByName(first(blank.where("not no_id"))).unionByName(blank.where("no_id").select("doc")).select("doc.*")


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, secret values replaced; n_chars follows the text."""
    ship(spark)
    done = secrets.redact_secrets(docs)
    return done.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them; the one at a source's cut ends
    after its last word taken. Documents without words count nothing and are kept once."""
    ship(spark)
    return mixing.apply_mix(docs, mixing.mix_sources(docs)).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the ids of each document's text."""
    ship(spark)
    return pieces.encode_texts(docs, pieces.read_model())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", keep_one_of_each),
    ("secrets", redact),
    ("mixture", mix),
    ("tokens", tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
