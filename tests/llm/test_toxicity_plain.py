"""Toxicity: the bound on what is learned from, and the matcher against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from ordertide.llm import toxicity
from ordertide.ship import ship


def test_repeated_documents_stay_within_the_bound(spark, monkeypatch):
    ship(spark)
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("some words "), F.when(F.col("id") % 4 == 0, "you moron fleeb").otherwise("here"),
                                                                        F.lit(" "), F.col("id")).alias("text"))
    hot = spark.range(3000).select(F.lit(4).cast("long").alias("doc_id"), F.concat(F.lit("you fleeb moron "), F.col("id")).alias("text"))
    labels = spark.range(200).select(F.col("id").alias("doc_id"), (F.col("id") % 4 == 0).cast("int").alias("toxic"))
    seen = []
    real = toxicity.fit_curve
    monkeypatch.setattr(toxicity, "fit_curve", lambda x, y: seen.append(len(y)) or real(x, y))
    lexicon, _ = toxicity.fit(docs.unionByName(hot), labels, fit_rows=50)
    assert len(seen) == 1 and seen[0] <= 50
    again, _ = toxicity.fit(docs.unionByName(hot).repartition(7), labels, fit_rows=50)
    assert again == lexicon


def plain_weights(text, lexicon):
    """Of each word outside exception phrases, the highest weight of the entries that are
    it or, with a star, begin it."""
    words = text.split()
    safe = set()
    for phrase in toxicity.EXCEPTIONS:
        p = phrase.split()
        for i in range(len(words)):
            if words[i:i + len(p)] == p:
                safe.update(range(i, i + len(p)))
    found = []
    for i, w in enumerate(words):
        fits = [x for e, x in lexicon.items() if e == w or e.endswith("*") and w.startswith(e[:-1])]
        if fits and i not in safe:
            found.append(max(fits))
    return sum(found), max(found, default=0)


@pytest.mark.parametrize("seed", range(5))
def test_matches_against_plain_loops(seed):
    rng = random.Random(seed)
    lexicon = {"moron": 2.0, "trash": 1.5, "idiot": 2.5, "pig": 1.0, "clown": 1.25, "mor*": 0.5, "fleeb*": 3.0, "garbage": 1.0, "trashc*": 0.25}
    words = toxicity.automaton(lexicon)
    vocabulary = [*(w for w in lexicon if w[-1] != "*"), "morons", "more", "fleebing", "nice", "can", "cans", "pigment", "iron", "guinea", "collector", "trashcan", "take", "out", "the"]
    for _ in range(500):
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 12)))
        assert toxicity.matched_weight(toxicity.fold(text), words) == pytest.approx(plain_weights(text, lexicon))
