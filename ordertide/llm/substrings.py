"""Substring dedup by super-k-mer partitioning.

Consecutive windows of words that share a minimiser travel as one packed string
to its bucket; there the windows of all strings are sorted by their words' hashes
and counted. See ``repeats`` for how windows are dealt and how frequent buckets
are split.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from ordertide.llm import grams
from ordertide.llm.repeats import Units, covered_units, cut_out, grouped, kept_mask

WIDTH = 35
GRAM = 12


def _counted(width: int):
    def judge(units: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Whether each window occurs twice or more among those of its bucket. Equal
        windows are of one bucket, so all buckets of a block are sorted together."""
        h1 = grams.run_hashes(units, width)[at]
        h2 = grams.run_hashes(grams.mixed(units + np.uint64(1)), width)[at]
        order = np.lexsort((h2, h1))
        same = (h1[order][1:] == h1[order][:-1]) & (h2[order][1:] == h2[order][:-1])
        hit = np.zeros(len(at), bool)
        hit[order[1:][same]] = True
        hit[order[:-1][same]] = True
        return hit
    return judge


DDL = "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string"


def _cut(with_text: bool):
    def cut(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple:
        words = text.split()
        keep = kept_mask(len(words), starts, ends)
        kept = b" ".join(words if keep.all() else [w for w, k in zip(words, keep.tolist(), strict=True) if k])
        return (len(words), len(words) - int(keep.sum()), kept.decode("utf-8", "replace") if with_text else None,
                hashlib.sha256(kept).hexdigest())
    return cut


def drop_repeated_substrings(docs: DataFrame, width: int = WIDTH, with_text: bool = True) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are ignored) what is left when
    each word that is covered by a window of ``width`` words occurring anywhere else is
    removed: n_words, n_removed, kept (words joined by one space; null without
    ``with_text``) and its sha256.

    Null and empty text: no words. Rows of one doc_id, null too, are documents of
    their own, so a repeated row of ``width`` words or more loses all of them. Empty
    table: no rows."""
    rows = grouped(docs)
    covered = covered_units(rows, Units(True, width, min(GRAM, width)), _counted(width), all_but_first=False)
    return cut_out(rows, covered, DDL, _cut(with_text))


def op4_substrings(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return drop_repeated_substrings(docs, with_text=False).drop("kept")
