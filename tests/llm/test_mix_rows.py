"""Shares of rows without a doc_id and of repeated doc_ids; columns that share names with working columns."""

from collections import Counter

from pyspark.sql import functions as F

from ordertide.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(name, n=60):
    return " ".join(f"{name}{i}" for i in range(n))


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], SCHEMA).repartition(parts)


def test_mix_gives_each_row_its_own_share(spark):
    n, words = 20, 30
    rows = [(None, prose(f"x{i}y", words), "en") for i in range(n)]  # alike by doc_id, source and size
    rows += [(3, prose("same", words), lang) for lang in ("en", "de", "fr")] + [(None, "", "en"), (None, " ", "en")]
    other = spark.createDataFrame([(100 + i, prose(f"o{i}w", 200), "en", "t", 0) for i in range(3)], SCHEMA)
    docs = frame(spark, rows).unionAll(other)
    mix = mixing.mix_sources(docs, weights=(1, 13)).cache()
    want = Counter()
    for r in mix.where("source = 's' and size > 0").collect():
        whole, rest = divmod(r.taken, r.size)
        want[r.doc_id, r.size] += whole
        want[r.doc_id, rest] += rest > 0
    got = mixing.apply_mix(docs, mix).where("source = 's'").withColumn("n", mixing.word_count(F.col("text"))).collect()
    assert Counter((r.doc_id, r.n) for r in got if r.n) == +want
    assert 0 < sum(r.n for r in got) == mix.where("source = 's'").agg(F.sum("taken")).first()[0] < (n + 3) * words
    assert sum(r.n not in (0, words) for r in got) <= 1
    assert sum(r.n == 0 for r in got) == 2


def test_mix_leaves_clashing_columns_alone(spark):
    extra = ["size", "words", "taken", "alike", "before", "share", "doc", "id", "src", "no_id", "worded", "others", "text_hash", "start", "target"]
    docs = frame(spark, [(i, prose(f"a{i}b", 10 + i), "en") for i in range(30)])
    docs = docs.withColumns({c: F.concat(F.lit(f"{c} of "), "doc_id") for c in extra}).withColumn("a.b", F.lit(1))
    got = mixing.apply_mix(docs, mixing.mix_sources(docs))
    assert got.columns == docs.columns
    got = got.collect()
    assert got and all(r[c] == f"{c} of {r.doc_id}" for r in got for c in extra)


def test_rows_without_ids_spread_and_repeats_travel_as_one(spark, monkeypatch):
    monkeypatch.setattr(mixing, "REPEATS", 7)
    rows = [(None, prose("copy", 10), "en")] * 50 + [(None, prose(f"n{i}x", 10), "en") for i in range(50)] + [(5, prose("five", 10), "en")] * 23
    rows += [(None, None, "en")] * 15
    other = spark.createDataFrame([(100 + i, prose(f"o{i}w", 200), "en", "t", 0) for i in range(9)], SCHEMA)
    docs = frame(spark, rows).unionAll(other)
    found = {n: mixing.mix_sources(docs, weights=(1, 3), range_rows=n).where("source = 's'").collect() for n in (4, 1000)}
    for got in found.values():
        assert len(got) == len(rows) and {r.source_size for r in got} == {1230}
        assert sum(r.taken for r in got) == int(got[0].target) < 1230
        assert sum(r.taken not in (0, r.size) for r in got) <= 1
        assert all(r.taken <= 3 * r.size for r in got)
    assert sorted(found[4], key=str) == sorted(found[1000], key=str)
