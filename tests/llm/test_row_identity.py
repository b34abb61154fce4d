"""Rows without a doc_id, repeated doc_ids, and columns that share names with working columns."""

import os
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(name, n=60):
    return " ".join(f"{name}{i}" for i in range(n))


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], SCHEMA).repartition(parts)


@pytest.mark.parametrize("parts", [1, 5])
def test_near_duplicates_of_shared_and_missing_doc_ids(spark, parts):
    rows = [(1, prose("a"), "en"), (1, prose("b"), "en"),  # two documents under one doc_id
            (2, prose("b") + " tail", "en"),  # a copy of the second
            (0, prose("a") + " more", "en"),  # before the first: the other one stays
            (7, prose("c"), "fr"), (7, prose("c"), "de"), (7, prose("c"), "en"),  # one text three times
            (None, prose("d"), "en"), (None, prose("d") + " end", "en"), *[(None, prose("e"), "en")] * 50,
            (9, prose("f"), "en"), (None, prose("f"), "en"),  # null last
            (None, "", "en"), (None, "", "en"), (None, None, "en"), (5, " ", "en"), (5, None, "en"), (5, None, "en")]
    docs = frame(spark, rows, parts)
    got = corpus_pipeline.keep_one_of_each(spark, docs, "")
    assert got.columns == docs.columns
    got = [(r.doc_id, r.text, r.lang) for r in got.collect()]
    d = [x for x in got if x[0] is None and (x[1] or "").startswith("d0 ")]
    assert len(d) == 1
    want = [(0, prose("a") + " more", "en"), (1, prose("b"), "en"), (7, prose("c"), "de"), (None, prose("e"), "en"), (9, prose("f"), "en"),
            (None, "", "en"), (None, "", "en"), (None, None, "en"), (5, " ", "en"), (5, None, "en")]
    assert Counter(got) == Counter(want + d)


def test_near_duplicates_leave_clashing_columns_alone(spark):
    extra = ["size", "words", "taken", "alike", "before", "share", "doc", "id", "src", "no_id", "worded", "others", "text_hash", "start", "target"]
    docs = frame(spark, [(i, prose(f"a{i}b", 10 + i), "en") for i in range(30)])
    docs = docs.withColumns({c: F.concat(F.lit(f"{c} of "), "doc_id") for c in extra}).withColumn("a.b", F.lit(1))
    got = corpus_pipeline.keep_one_of_each(spark, docs, "")
    assert got.columns == docs.columns
    got = got.collect()
    assert got and all(r[c] == f"{c} of {r.doc_id}" for r in got for c in extra)


def test_sketches_never_rule_out_a_link():
    """Sketches of sets that differ in d shingles differ in d bits at most, at any size."""
    import numpy as np

    from ordertide.llm import jaccard
    rng = np.random.default_rng(2)
    for _ in range(200):
        a = np.unique(rng.integers(0, 2**63, size=rng.integers(1, 1500), dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < rng.random()], rng.integers(0, 2**63, size=rng.integers(1, 300), dtype=np.uint64)]))
        both = jaccard.Sketches([jaccard._sketch(a), jaccard._sketch(b)])
        apart = len(np.setxor1d(a, b))
        assert both.within(np.array([0, 1]), np.array([1, 0]), np.array([apart, apart])).all()
    far = jaccard.Sketches([jaccard._sketch(rng.integers(0, 2**63, size=200, dtype=np.uint64)) for _ in range(2)])
    assert not far.within(np.array([0]), np.array([1]), np.array([44]))[0]


def test_a_large_region_is_dealt_into_cells(spark, monkeypatch):
    """Several hundred near copies of which most don't link with each other: the same
    components whether a region is one cell or many."""
    import random

    from ordertide.llm import jaccard
    from ordertide.ship import ship
    ship(spark)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(120)] = f"x{i}-{rng.randrange(1000)}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)

    def sets(words):
        return {tuple(words[k:k + 5]) for k in range(len(words) - 4)}
    found = [sets(t.split()) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(found[i] & found[j]) >= 80 * len(found[i] | found[j]) and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    for size in (jaccard.CELL_ROWS, 40):
        monkeypatch.setattr(jaccard, "CELL_ROWS", size)
        assert {r.doc_id: r.component_id for r in jaccard.jaccard_components(df).collect()} == dict(enumerate(label))
    assert 1 < len(set(label)) < len(rows)
