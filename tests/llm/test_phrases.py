"""Phrase collocations against plain counting; the filters' round trips."""

import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ordertide.llm import phrases
from ordertide.ship import ship

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least=10, covered=50, kept=2000):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.setdefault(lang, Counter()).update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {g: a for g, a in counts.items() if len(g) > 1 and a >= least}
        rows = []
        for g, a in found.items():
            longer = [b for h, b in found.items() if len(h) > len(g) and g in (h[:2], h[1:])]
            if any(100 * b >= covered * a for b in longer):
                continue
            cut = min((1000000 * a * a // (counts[g[:k]] * counts[g[k:]]), k) for k in range(1, len(g)))
            rows.append((-cut[0], -a, " ".join(g).encode(), counts[g[:cut[1]]], counts[g[cut[1]:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(rows)[:kept])]
    return sorted(out)


ROWS = [(None, "New York is big. new york, NEW\tYork;york new:new york"), ("en", None), ("en", ""), ("en", " \t\n"), ("und", "new york\x0bnew york"),
        ("de", "über ÜBER über alles hier über alles"), ("en", "a b c! a b c? a b x a b c" * 5), ("en", "a a a a a a a a a a a a a a"), ("fr", "rien"),
        ("en", "same words " * 20_000)]


@pytest.mark.parametrize("kept", [2000, 3])
def test_plain(spark, kept):
    ship(spark)
    df = spark.createDataFrame([(i % 3 or None, t, g, "x", 1) for i, (g, t) in enumerate(ROWS * 3)], "doc_id long, text string, lang string, word string, f int").repartition(4)
    found = phrases.collocations(df, least=4, kept=kept)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == plain(ROWS * 3, least=4, kept=kept)


def test_several_cuts(spark, monkeypatch):
    ship(spark)
    rng = np.random.default_rng(3)
    rows = [("ab"[i % 2], " ".join(f"w{x}" for x in rng.zipf(1.4, 400) % 60)) for i in range(60)]
    monkeypatch.setattr(phrases, "CUT_WORDS", 1_000)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    assert sorted(map(tuple, phrases.collocations(df).collect())) == plain(rows)


@pytest.mark.parametrize("rows", [[], [("en", None)], [("en", "seldom said words")]])
def test_nothing_frequent(spark, rows):
    ship(spark)
    assert phrases.collocations(spark.createDataFrame(rows, "lang string, text string")).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.integers(0, 2**32 - 1))
def test_permutation(bits, seed):
    rng = np.random.default_rng(seed)
    largest = 2**bits - 1
    words = rng.integers(0, largest + 1, size=(300, 3))
    words[0], words[1] = 0, largest
    p = phrases.Permutation(largest)
    q, r = p.permuted(words)
    assert (p.restored(q, r) == words).all() and len(set(zip(q.tolist(), r.tolist(), strict=True))) == len(np.unique(words, axis=0))
    counts = rng.integers(1, 2**60, size=300)
    q, r, n = phrases.merged(*(np.concatenate((x, x)) for x in (q, r)), np.concatenate((counts, counts)))
    assert n.sum() == 2 * counts.sum()
    back = phrases.unpacked(phrases.packed(q, r, n, p.bytes))
    assert all((x == y).all() for x, y in zip((q, r, n), back, strict=True))


def test_exact_scores(spark):
    """Products past 64 bits."""
    df = spark.createDataFrame([(10**12, 10**12 + 7, 10**12), (10, 10, 10), (3 * 10**9, 10**18, 5 * 10**9)], "a long, x long, y long")
    found = {r.a: r.s for r in df.select("a", phrases._score("a", "x", "y").alias("s")).collect()}
    assert found == {a: 10**6 * a * a // (x * y) for a, x, y in ((10**12, 10**12 + 7, 10**12), (10, 10, 10), (3 * 10**9, 10**18, 5 * 10**9))}
