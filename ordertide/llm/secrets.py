"""Secret scans with a guess-cost estimate.

Three fixed patterns find assignments, access keys and long hex runs. Beside
them, any value in a credential context (``pwd: ...``, ``passphrase is ...``) is
scored: the cheapest segmentation into common words, dates, repeats, keyboard
walks, digit or letter sequences and brute-force spans, by dynamic programming
over its characters. A value that would take at least 10**9 guesses is a secret.

Common words come from fixed lists and from the table: the words that most documents
have outside credential contexts, ranked by the number of those documents. So "password
is incorrect" names no secret, and a leaked value, however often it is copied after the
word "password", makes itself no common word.
"""

from __future__ import annotations

import hashlib
import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.llm.arrow import map_columns, map_text
from ordertide.llm.words import WORDS
from ordertide.session import checkpoint_dir

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "guess")
#: A word that names a credential, then "is", ":" or "=", then a value of 6 characters or more.
CONTEXT = re.compile(r"""(?<![A-Za-z])(pass(?:word|wd|phrase|code)|pwd|secret|token|credentials?|api[ _-]?key|access[ _-]?key|"""
                     r"""private[ _-]?key|auth[ _-]?key)["']?[ \t]*(?:[:=]|=>|[ \t]is[ \t])[ \t]*["']?([^\s"'<>,;(){}]{6,})""", re.I | re.A)
#: log10 of the guesses from which a value in a credential context is a secret.
MIN_GUESSES = 9.0

# Common password words, most common first.
COMMON = ("password love admin welcome monkey dragon master login hello secret summer winter spring autumn qwerty "
          "princess sunshine football baseball shadow letmein michael jordan charlie superman batman test guest root "
          "user access token changeme default example sample your here none null true false string value the and "
          "pass word key code name mail home work game star king queen blue green black white red happy lucky angel "
          "magic tiger eagle flower computer internet server system office company private public").split()
# Rows of a keyboard.
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "qwertzuiop", "azertyuiop", "abcdefghijklmnopqrstuvwxyz")
LEET = str.maketrans("013457@$", "oieastas")
RANK = {w: i + 1 for i, w in enumerate(dict.fromkeys([*COMMON, *WORDS]))}
LONGEST_WORD = 24
#: Words of the table that are ranked: those of this many documents or more, at most WORDS_KEPT of them. A rank of 50,000
#: costs 10**4.7 guesses, so two words of the highest ranks are dearer than MIN_GUESSES already; the list takes some
#: 5 MB in a Python worker, whatever the table.
MIN_DOCS, WORDS_KEPT = 5, 50_000
NEXT = {(a, b) for row in ROWS for s in (row, row[::-1]) for a, b in zip(s, s[1:], strict=False)}
DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d")
LONGEST_SPAN = 64


def _alphabet(c: str) -> int:
    return 10 if c.isdigit() else 26 if c.isascii() and c.isalpha() else 33 if c.isascii() else 1000


def guess_cost(value: str, ranks: dict[str, int] = RANK) -> float:
    """log10 of the guesses of the cheapest segmentation; 0 for an empty value.

    The pieces multiply. A word costs its rank (twice if capitals or look-alike
    digits are in it), a date 40,000, a repeat the cost of its unit times its
    count, a keyboard walk 50 times its length, a brute-force character the size
    of its alphabet. Long values are scored whole: a piece spans 64 characters at
    most, and each character is taken in constant work."""
    n = len(value)
    low = value.lower()
    plain = low.translate(LEET)
    brute = [math.log10(_alphabet(c)) for c in value]
    best = [0.0] + [math.inf] * n
    walk = 1  # characters of the walk or run that ends here
    same = 1
    for e in range(1, n + 1):
        i = e - 1
        best[e] = min(best[e], best[i] + brute[i])
        walk = walk + 1 if i and (low[i - 1], low[i]) in NEXT else 1
        same = same + 1 if i and value[i] == value[i - 1] else 1
        for size in range(3, min(walk, LONGEST_SPAN) + 1):
            best[e] = min(best[e], best[e - size] + math.log10(50 * size))
        for size in range(3, min(same, LONGEST_SPAN) + 1):
            best[e] = min(best[e], best[e - size] + brute[i] + math.log10(size))
        for size in range(3, min(LONGEST_WORD, e) + 1):
            if rank := ranks.get(plain[e - size:e]):
                twist = 2 if value[e - size:e] != plain[e - size:e] else 1
                best[e] = min(best[e], best[e - size] + math.log10(rank * twist + 1))
        for size in (4, 6, 7, 8, 10):
            if size <= e and value[e - size].isdigit() and DATE.fullmatch(value, e - size, e):
                best[e] = min(best[e], best[e - size] + math.log10(40_000))
        for unit in range(2, 9):  # a unit of 2 to 8 characters, again
            if 2 * unit <= e and value[e - unit:e] == value[e - 2 * unit:e - unit]:
                best[e] = min(best[e], best[e - unit] + math.log10(2))
    return best[n]


def find_secrets(text: str | None, ranks: dict[str, int] = RANK) -> list[tuple[int, int, str, int, int]]:
    """(start, end, kind, value start, value end) by start, then kind; code points."""
    text = text or ""
    found = [(m.start(), m.end(), 0, m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    for kind, pattern in ((1, ACCESS), (2, HEX)):
        found += [(m.start(), m.end(), kind, m.start(), m.end()) for m in pattern.finditer(text) if m.end() - m.start() >= 16 + 2 * (kind == 1)]
    spans = sorted((f[3], f[4]) for f in found)
    at = 0
    for m in CONTEXT.finditer(text):
        start, end = m.start(2), m.end(2)
        while end > start and text[end - 1] in ".:!?":
            end -= 1
        while at < len(spans) and spans[at][1] <= start:
            at += 1
        if (at == len(spans) or spans[at][0] >= end) and guess_cost(text[start:end], ranks) >= MIN_GUESSES:
            found.append((start, end, 3, start, end))
    found.sort(key=lambda f: (f[0], f[2], f[1]))
    return [(s, e, KINDS[k], vs, ve) for s, e, k, vs, ve in found]


def _joined(found) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k, *_ in found)


def redacted(text: str, found) -> str:
    """The text with each secret value replaced by its kind in angle brackets;
    overlapping values make one, named after the first."""
    out, at = [], 0
    for start, end, kind in sorted((vs, ve, k) for _, _, k, vs, ve in found):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def word_ranks(docs: DataFrame, text: str = "text") -> dict[str, int]:
    """RANK, and the words that most of ``docs`` have outside credential contexts by the
    number of those documents; a word in both has its lower rank."""
    checkpoint_dir(docs.sparkSession)
    low = F.lower(F.regexp_replace(text, f"(?i){CONTEXT.pattern}", "$1"))
    words = docs.select(F.explode(F.array_distinct(F.split(low, r"[^\p{L}]+"))).alias("word"))
    words = words.where(F.length("word").between(3, LONGEST_WORD))
    # counted once; few are left
    counts = words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_DOCS).checkpoint()
    # eight steps for each power of two, so a few hundred rows
    steps = counts.groupBy(F.floor(8 * F.log2("n")).alias("step")).agg(F.count("*").alias("words"), F.min("n").alias("least"))
    least, kept = None, 0
    for r in sorted(steps.collect(), key=lambda r: -r.step):
        kept += r.words
        if kept > WORDS_KEPT:
            break
        least = r.least
    found = [] if least is None else counts.where(F.col("n") >= least).collect()
    found = [r.word for r in sorted(found, key=lambda r: (-r.n, r.word))]
    ranks = {w: i + 1 for i, w in enumerate(found)}
    return ranks | {w: min(i, ranks.get(w, i)) for w, i in RANK.items()}


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string"


def _scan(ranks):
    def scan(doc_ids, texts) -> list:
        found = [find_secrets(t, ranks.value) for t in texts]
        counts = [[sum(f[2] == k for f in fs) for fs in found] for k in KINDS]
        base = [hashlib.sha256(_joined([f for f in fs if f[2] != "guess"]).encode()).hexdigest() for fs in found]
        return [doc_ids, *counts, base, [_joined(fs) for fs in found]]
    return scan


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are ignored): counts and
    spans of its secrets. Null text: empty, no spans (the hash is of nothing). Null
    doc_id stays null; repeated rows give repeated rows; empty table: no rows."""
    ranks = docs.sparkSession.sparkContext.broadcast(word_ranks(docs))
    return map_columns(docs.select(F.col("doc_id").cast("long"), "text"), _scan(ranks), SCHEMA)


def redact_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each secret value in ``text`` replaced by ``<kind>``; other
    columns as they are, null text stays null."""
    ranks = docs.sparkSession.sparkContext.broadcast(word_ranks(docs, text))
    return map_text(docs, lambda t: redacted(t, find_secrets(t, ranks.value)), text)


def op5_secrets(spark, sf_dir: str) -> DataFrame:
    return scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
