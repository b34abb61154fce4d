"""Edge cases: nulls, empty and very long texts, ties, repeated rows, empty tables, extra columns."""

import hashlib

import pytest
from pyspark.sql import functions as F

from ordertide.llm import fingerprint, jaccard, licenses, mixing, pieces, secrets, substrings, suffixes, topk, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_shingles string, g string, size string, part string"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(60_000))
WORDS = " ".join(f"word{i}" for i in range(50))
ROWS = [
    (1, WORDS), (2, WORDS), (2, WORDS), (3, None), (4, ""), (5, "  \n\t "), (6, LONG), (7, LONG + " tail"),
    (None, "no id " + WORDS), (None, None), (8, "Released under the MIT License.\nstupid idiot password = 'abcdefghijkl1'"),
    (9, "one two"), (10, "One TWO"), (11, "x" * 250), (12, "ÄÖ 中文 😀 \x00"),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", None if i == 3 else f"s{(i or 0) % 2}", len(t or ""), "extra", "g", "s", "p")
                                  for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, ROWS).cache()


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.doc_id, []).append(r)
    return out


def test_jaccard(spark, docs):
    r = by_id(jaccard.jaccard_components(docs))
    assert [x.component_id for x in r[1] + r[2]] == [1, 1, 1]
    assert r[1][0].n_shingles == 46
    assert [(r[i][0].n_shingles, r[i][0].component_id) for i in (3, 4, 5)] == [(0, 3), (0, 4), (0, 5)]
    assert r[7][0].component_id == 6 and r[9][0].component_id == r[10][0].component_id == 9
    # 46 of 48 shingles are those of 1
    assert sorted((x.n_shingles, x.component_id or 0) for x in r[None]) == [(0, 0), (48, 1)]
    assert jaccard.jaccard_components(docs.limit(0)).collect() == []


def test_jaccard_group_of_near_copies(spark):
    base = [f"t{i}" for i in range(200)]
    rows = [(i, " ".join([*base[:i % 180], f"e{i}", *base[i % 180 + 1:]])) for i in range(300)]
    rows += [(1000 + i, f"{WORDS} " + " ".join(f"u{i}v{j}" for j in range(60))) for i in range(100)]
    r = by_id(jaccard.jaccard_components(frame(spark, rows)))
    assert {r[i][0].component_id for i in range(300)} == {0}
    assert all(r[1000 + i][0].component_id == 1000 + i for i in range(100))


def test_jaccard_finds_links_beyond_pivots(spark):
    # chains: each links with the next only
    rows = []
    for c in range(30):
        for k in range(6):
            rows.append((c * 10 + k, " ".join(f"c{c}n{i}" for i in range(k * 8, k * 8 + 104))))
    r = by_id(jaccard.jaccard_components(frame(spark, rows)))
    assert all(r[c * 10 + k][0].component_id == c * 10 for c in range(30) for k in range(6))


def test_suffixes(spark, docs):
    r = by_id(suffixes.drop_repeated_strings(docs))
    n = len(WORDS)
    assert (r[1][0].n_removed, r[1][0].n_bytes) == (n if None in r else 0, n)  # null ids come first
    assert [x.n_removed for x in r[2]] == [n, n] and r[2][0].kept == b""
    assert r[7][0].n_removed == len(LONG) and r[7][0].kept == b" tail"
    assert (r[11][0].n_removed, r[11][0].n_spans) == (249, 1)
    assert (r[3][0].n_bytes, r[3][0].kept_sha256) == (0, hashlib.sha256(b"").hexdigest())
    assert suffixes.drop_repeated_strings(docs.limit(0)).collect() == []


@pytest.mark.parametrize("width", [7, 25, 60, 100, 130])
def test_suffix_refinement_of_any_width(spark, width):
    text = ("abcab" * 40 + "x" * 150 + "abcab" * 30 + "q") * 2
    r = suffixes.drop_repeated_strings(frame(spark, [(1, text), (2, "zz" + text[50:300])]), width).orderBy("doc_id").collect()
    seen = set()
    for row, t in zip(r, (text, "zz" + text[50:300]), strict=True):
        gone = [False] * len(t)
        for i in range(len(t) - width + 1):
            if t[i:i + width] in seen:
                gone[i:i + width] = [True] * width
            seen.add(t[i:i + width])
        assert row.kept.decode() == "".join(c for c, g in zip(t, gone, strict=True) if not g)


def test_substrings(spark, docs):
    r = by_id(substrings.drop_repeated_substrings(docs))
    assert (r[1][0].n_removed, [x.n_removed for x in r[2]]) == (50, [50, 50])
    assert r[7][0].n_removed == 60_000 and r[7][0].kept == "tail"
    assert [(x.n_words, x.kept) for x in r[3] + r[4] + r[5]] == [(0, "")] * 3
    assert r[9][0].kept == "one two"
    assert substrings.drop_repeated_substrings(docs.limit(0)).collect() == []


@pytest.mark.parametrize("bucket", [1, 3])
def test_frequent_buckets_give_the_same(spark, monkeypatch, bucket):
    from ordertide.llm import repeats
    rows = [(i, f"a{i} b{i} {WORDS} c{i}") for i in range(40)] + [(100, WORDS), (101, WORDS)]
    usual = [suffixes.drop_repeated_strings(frame(spark, rows)), substrings.drop_repeated_substrings(frame(spark, rows))]
    usual = [sorted(d.collect()) for d in usual]
    monkeypatch.setattr(repeats, "BUCKET_PIECES", bucket)
    split = [suffixes.drop_repeated_strings(frame(spark, rows)), substrings.drop_repeated_substrings(frame(spark, rows))]
    assert [sorted(d.collect()) for d in split] == usual


def test_licenses(spark, docs):
    r = by_id(licenses.scan_licenses(docs))
    assert (r[8][0].sentence_ids, r[8][0].licenses) == (["M01"], ["MIT"])
    assert all(x.licenses == [] for i, xs in r.items() if i != 8 for x in xs)
    assert licenses.scan_licenses(docs.limit(0)).collect() == []
    wrapped = ("The MIT text: Permission\nis hereby granted. This program is free software; you can redistribute it and/or\nmodify it under "
               "the terms of the GNU General Public License as\npublished by the Free Software Foundation, either version 3 of the\n"
               "License, or (at your option) any later version. See the\nGNU General Public License for more details.")
    assert licenses.scan_licenses(frame(spark, [(1, wrapped)])).first().licenses == ["GPL-3.0-or-later"]


def test_secrets(spark, docs):
    r = by_id(secrets.scan_secrets(docs))
    assert r[8][0].spans.startswith("assign:") and r[8][0].n_assign == 1
    assert r[3][0].base_sha256 == hashlib.sha256(b"").hexdigest() and len(r[None]) == 2
    assert secrets.scan_secrets(docs.limit(0)).collect() == []
    red = by_id(secrets.redact_secrets(docs))
    assert red[8][0].text.endswith("password = '<assign>'") and red[3][0].text is None and red[8][0].part == "p"


def test_guess_costs():
    assert secrets.guess_cost("") == 0
    cheap = ["password", "P4ssword1", "qwertyuiop", "aaaaaaaaaaaaaaaa", "19990101", "abcabcabcabcabc", "letmein2020"]
    assert all(secrets.guess_cost(v) < secrets.MIN_GUESSES for v in cheap)
    assert all(secrets.guess_cost(v) >= secrets.MIN_GUESSES for v in ["xK9#vQ2$mZ", "tR7wq0Lp3n"])
    kinds = [f[2] for f in secrets.find_secrets("passphrase is xK9#vQ2$mZ! and pwd: password, token: aaaaaaaaaaaa")]
    assert kinds == ["guess", "assign"]


def test_topk(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5]), (50, [-1.0, 0.25]), (3, None), (4, [None, 1.0]),
            (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, []), (8, [1.0]), (None, [9.0, 9.0])]
    v = spark.createDataFrame([(i, x, 3) for i, x in rows], "vec_id long, embedding array<float>, rank int")
    r = topk.top_k(v, v.where("vec_id % 50 = 0"), k=3).collect()
    assert sorted((x.query_id, x["rank"], x.vec_id, x.score) for x in r) == [
        (0, 1, 1, 65536), (0, 2, 1, 65536), (0, 3, 2, 32768), (50, 1, 2, -24576), (50, 2, 0, -65536), (50, 3, 1, -65536)]
    assert topk.top_k(v.limit(0), v.limit(0)).collect() == []


def test_mixing(spark, docs):
    r = by_id(mixing.mix_sources(docs))
    assert r[3][0].source is None and r[3][0].taken == 0 and r[4][0].taken == 0
    rows = [x for xs in r.values() for x in xs]
    total = sum(x.size for x in rows)
    taken = {s: sum(x.taken for x in rows if x.source == s) for s in ("s0", "s1")}
    target = {x.source: x.target for x in rows}
    assert abs(sum(target.values()) - total) < 1e-6
    assert all(taken[s] == int(target[s]) for s in taken) and all(x.taken <= 3 * x.size for x in rows)
    assert sorted(mixing.mix_sources(docs).collect(), key=str) == sorted(rows, key=str)
    assert mixing.mix_sources(docs.limit(0)).collect() == []
    mixed = mixing.apply_mix(docs, mixing.mix_sources(docs))
    words = mixed.groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()
    assert all(abs(taken[x.source] - x.n) <= 1 for x in words if x.source)
    assert mixed.columns == docs.columns


def test_mixing_caps(spark):
    rows = [(i, "w " * (1 if i % 3 == 0 else 100)) for i in range(30)]
    d = frame(spark, rows).withColumn("source", F.concat(F.lit("s"), F.col("doc_id") % 3))
    t = {x.source: (x.source_size, x.target) for x in mixing.mix_sources(d).collect()}
    assert t["s0"] == (10, 30.0) and abs(t["s1"][1] * 1.5 - t["s2"][1]) < 1e-6


def test_pieces(spark, docs):
    import numpy as np
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = {i: t for i, t in ROWS}
    for r in pieces.decode_tokens(pieces.encode_texts(docs, pieces.read_model()), pieces.read_model()).collect():
        if r.doc_id is not None:
            assert np.frombuffer(r.tokens, "<i4").tolist() == library.encode(texts[r.doc_id] or "")
            assert r.text == (texts[r.doc_id] or "")
    assert pieces.encode_texts(docs.limit(0), pieces.read_model()).collect() == []


def test_toxicity(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (8, 1, None), (9, 0, 1), (9, 0, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    r = by_id(toxicity.score_toxicity(docs, model))
    assert r[8][0].predicted == 1 and r[3][0].predicted == 0 and all(0 <= x.score <= 1 for xs in r.values() for x in xs)
    tricked = frame(spark, [(1, "you 1d!0t, you ѕtuрid id​iot"), (2, "take out the trash, put it in the trash can")])
    assert [x.predicted for x in toxicity.score_toxicity(tricked, model).orderBy("doc_id").collect()] == [1, 0]
    empty = toxicity.fit(docs.limit(0), labels.limit(0))
    assert toxicity.score_toxicity(docs.limit(0), empty).collect() == []


def test_fingerprints(spark, docs):
    r = fingerprint.fingerprints(docs)
    assert r.count() == len(ROWS)
    r = by_id(r)
    assert r[1][0].fingerprint == r[2][0].fingerprint and r[1][0].near_next == 1.0
    assert r[2][0].edited_fingerprint and r[3][0].n_chars == 0 and r[3][0].fingerprint == "0::"
    assert r[6][0].near_next > 0.9 and r[6][0].near_edited > 0.3
    last, first = r[12][0], ""
    assert last.edited_sha256 == hashlib.sha256(fingerprint.edited(ROWS[-1][1], first).encode()).hexdigest()
    assert fingerprint.fingerprints(docs.limit(0)).collect() == []
    alone = fingerprint.fingerprints(frame(spark, [(5, "only")])).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0
