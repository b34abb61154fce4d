"""Toxicity by a weighted lexicon.

Texts are folded (case, look-alike letters of other scripts, digits and signs
that stand for letters, invisible characters) and matched against a lexicon of
words by an Aho-Corasick automaton. Matches inside an exception phrase don't
count. The weights of the matches add up; the sum, alone and by text length,
gives the score through a logistic curve.

The lexicon starts from common insults and is completed, with all weights and
the curve, from labelled documents: a word enters if its smoothed log-odds
between toxic and other documents are far above their standard error. Word
beginnings are learned alike, for inflected forms. A word counts once for each
different context (the words around it), so copies of one document don't make
its rare words look toxic.
"""

from __future__ import annotations

import re
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.llm.arrow import arrow_schema, map_columns, record_batch
from ordertide.llm.stored import stored

#: Labelled documents that the lexicon and the curve are learned from, at most (those with the smallest md5 of doc_id).
FIT_ROWS = 20_000
#: Standard errors that a word's log-odds must be above zero.
MIN_Z = 3.2
#: Lengths of the word beginnings that are learned beside whole words.
STEMS = (4, 5, 6)
THRESHOLD = 0.7
PRIOR_WEIGHT = 3.0
#: With fewer labelled documents of either kind nothing is learned: the insults and a curve that takes one for toxic.
LEAST_LABELLED = 10

# Insults that are in the lexicon whatever the labels say.
INSULTS = ("asshole bastard bitch clown crap cretin cunt dickhead disgusting dumbass dumb fool freak fuck fucking garbage "
           "idiot idiotic imbecile jerk loser lowlife moron moronic motherfucker nitwit pathetic pig prick retard retarded "
           "scum scumbag shit shithead slut stupid subhuman trash twat vermin wanker whore worthless").split()
# Phrases in which those words are harmless.
EXCEPTIONS = ("trash can", "trash cans", "trash bag", "trash bags", "trash bin", "take out the trash", "taking out the trash",
              "garbage collection", "garbage collector", "garbage can", "garbage bag", "garbage truck", "clown fish",
              "circus clown", "clown car", "guinea pig", "guinea pigs", "pig farm", "pig iron", "fool proof", "april fool",
              "jerk chicken", "pond scum", "dumb bell", "dumb terminal", "freak accident", "freak weather", "crap shoot")
# Letters of other scripts, digits and signs, and the Latin letters that they look like.
LOOK_ALIKE = {
    "аᴀɑα@4": "a", "в8": "b", "сϲⅽ": "c", "ԁⅾ": "d", "еёεҽ3€": "e", "ɡց": "g", "һн": "h", "іїıιⅰ1": "i", "јϳ": "j", "кκ": "k",
    "ⅼӏ": "l", "мⅿ": "m", "ոп": "n", "оοσօ0": "o", "рρ": "p", "ԛ": "q", "гⲅ": "r", "ѕ5$": "s", "тτ7": "t", "υսц": "u",
    "ѵνⅴ": "v", "ԝшω": "w", "хχⅹ": "x", "уγү": "y", "ᴢ": "z",
}
INVISIBLE = "­​‌‍⁠﻿"
FOLD = ({ord(a): b for many, b in LOOK_ALIKE.items() for a in many} | {ord(c): None for c in INVISIBLE}
        | {0xFF21 + i: chr(97 + i) for i in range(26)} | {0xFF41 + i: chr(97 + i) for i in range(26)})
APART = re.compile(r"[\W_]+")

UNFITTED = np.array([-4.0, 3.0, 1.0, 0.5])


def fold(text: str | None) -> str:
    """Folded words with a space before, between and after; one space if there are none."""
    return f" {APART.sub(' ', (text or '').lower().translate(FOLD)).strip()} ".replace("  ", " ")


def patterns(word: str) -> list[str]:
    """A word's lexicon entries: itself, and its beginnings, which end in ``*``."""
    return [word, *(f"{word[:n]}*" for n in STEMS if len(word) > n)]


def automaton(lexicon: dict[str, float]):
    a = ahocorasick.Automaton()
    for entry, weight in [*lexicon.items(), *((p, None) for p in EXCEPTIONS)]:
        looked_for = f" {entry} " if entry[-1] != "*" else f" {entry[:-1]}"
        a.add_word(looked_for, (len(looked_for) - 1, weight))
    if len(a):
        a.make_automaton()
    return a


def matched_weight(folded: str, words) -> tuple[float, float]:
    """Over the words outside exception phrases, each with the highest weight that
    fits: the sum, and the highest."""
    best: dict[int, float] = {}
    safe = []
    for end, (size, weight) in words.iter(folded) if len(words) else ():
        if weight is None:
            safe.append((end - size, end))
        else:
            best[end - size] = max(weight, best.get(end - size, 0.0))
    weights = [w for at, w in best.items() if not any(a <= at < b for a, b in safe)]
    return float(sum(weights)), float(max(weights, default=0.0))


def features(matched: list[tuple[float, float]], n_words: list[int]) -> np.ndarray:
    """1, the damped sum of the weights, that by length, and the highest weight."""
    total, highest = np.array(matched, dtype=np.float64).reshape(-1, 2).T
    n = np.array(n_words, dtype=np.float64)
    return np.stack([np.ones(len(n)), np.log1p(total), np.log1p(20 * total / np.sqrt(n + 20)), highest], axis=1)


def scores(x: np.ndarray, curve: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))


def fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton's method; a slope that would be negative is
    0, and the others are fitted without it."""
    use = np.arange(x.shape[1])
    while True:
        c, part = np.zeros(len(use)), x[:, use]
        ridge = np.diag([1e-3] + [0.05] * (len(use) - 1))
        for _ in range(100):
            p = scores(part, c)
            step = np.linalg.solve((part * (p * (1 - p))[:, None]).T @ part + ridge, part.T @ (y - p) - ridge @ c)
            c += step * min(1.0, 2 / (np.abs(step).max() + 1e-9))
        if len(use) == 1 or c[1:].min() >= 0:
            curve = np.zeros(x.shape[1])
            curve[use] = c
            return curve
        use = np.delete(use, 1 + int(c[1:].argmin()))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _word_counts(toxic: list, texts: list) -> list:
    counts: Counter = Counter()
    for t, text in zip(toxic, texts, strict=True):
        counts.update((p, t) for p in {p for w in set(fold(text).split()) for p in patterns(w)})
    return [[w for w, _ in counts], [t for _, t in counts], list(counts.values())]


def _log_odds(toxic, n_toxic: int, other, n_other: int):
    """Their lower bound (at 1.64 standard errors), and the log-odds in standard errors."""
    odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((other + 0.5) / (n_other + 1))
    error = np.sqrt(1 / (toxic + 0.5) + 1 / (other + 0.5))
    return odds - 1.64 * error, odds / error


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[dict[str, float], np.ndarray]:
    """Lexicon and curve from at most ``fit_rows`` labelled documents that aren't held
    out. Labels other than 0 and 1 and labels without a doc_id are ignored; of several
    labels of one doc_id the highest counts, of several texts the one with the least hash.
    The documents that are learned from are found in one pass and stored; the rest reads
    these."""
    labels = labels.select("doc_id", "toxic").where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    labels = labels.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sample = labels.orderBy(F.md5(F.col("doc_id").cast("string"))).limit(fit_rows)
    # at most fit_rows pairs of numbers
    spark = docs.sparkSession
    sample = spark.createDataFrame(sample.collect(), "l_id long, toxic int")
    known = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("l_id"))
    # one row for each label, however often its document is there
    known = known.groupBy("l_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    known = stored(known.select("toxic", "text"), "toxicity")
    n = {t: c for t, c in known.groupBy("toxic").count().collect()}
    n_toxic, n_other = n.get(1, 0), n.get(0, 0)
    prior = dict.fromkeys(INSULTS, PRIOR_WEIGHT)
    if min(n_toxic, n_other) < LEAST_LABELLED:
        return prior, UNFITTED

    counts = map_columns(known, _word_counts, "word string, toxic int, n long").groupBy("word").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("other"))
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("other") + 0.5) / (n_other + 1))
    z = odds / F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("other") + 0.5))
    counts = counts.where((F.col("toxic") > 1) & (z >= MIN_Z))
    # words of the stored documents, so at most what fit_rows of them hold
    counts = {r["word"]: (r["toxic"], r["other"]) for r in counts.collect()}

    def contexts(toxic: list, texts: list) -> list:
        seen = set()
        for text in texts:
            w = fold(text).split()
            w = ["", *w, ""]
            seen.update((p, a, c) for a, b, c in zip(w, w[1:], w[2:], strict=False) for p in patterns(b) if p in counts)
        return [list(c) for c in zip(*seen, strict=True)] or [[], [], []]
    ddl = "word string, left string, right string"
    n_contexts = map_columns(known.where("toxic = 1"), contexts, ddl).distinct().groupBy("word").count()
    lexicon = dict(prior)
    for word, here in n_contexts.collect():
        toxic, other = counts[word]
        weight, sure = _log_odds(min(toxic, here), n_toxic, other, n_other)
        if sure >= MIN_Z:
            lexicon[word] = round(float(weight), 6)

    def measured(toxic: list, texts: list) -> list:
        words, folded = automaton(lexicon), [fold(t) for t in texts]
        matched = [matched_weight(f, words) for f in folded]
        return [toxic, [m[0] for m in matched], [m[1] for m in matched], [f.count(" ") for f in folded]]
    rows = sorted(map_columns(known, measured, "toxic int, total double, highest double, words long").collect())
    return lexicon, fit_curve(features([(r[1], r[2]) for r in rows], [r[3] for r in rows]), np.array([r[0] for r in rows]))


def score_toxicity(docs: DataFrame, model: tuple[dict[str, float], np.ndarray]) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are ignored): score from 0 to 1
    and predicted, 1 from a score of 0.7. Null text counts as empty and gets the score
    of a text without matches; repeated rows get equal scores; empty table: no rows."""
    lexicon, curve = model

    def run(batches):
        schema, words = arrow_schema(SCORED), automaton(lexicon)
        for batch in batches:
            ids, texts = batch.columns
            folded = [fold(t) for t in texts.to_pylist()]
            x = features([matched_weight(f, words) for f in folded], [f.count(" ") for f in folded])
            score = scores(x, curve).round(9)
            yield record_batch([ids, score, (score >= THRESHOLD).astype(np.int32)], schema)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCORED)


def drop_toxic(docs: DataFrame, model: tuple[dict[str, float], np.ndarray], column: str = "text") -> DataFrame:
    """``docs`` without those that the model predicts toxic; no column changes."""
    lexicon, curve = model

    def run(batches):
        words = automaton(lexicon)
        for batch in batches:
            folded = [fold(t) for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]
            x = features([matched_weight(f, words) for f in folded], [f.count(" ") for f in folded])
            yield batch.filter(pa.array(scores(x, curve).round(9) < THRESHOLD))
    return docs.mapInArrow(run, docs.schema)


SCORED = "doc_id long, score double, predicted int"


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = score_toxicity(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
