"""Suffix-array dedup by bucket-pointer refinement.

Positions start in buckets of equal q-grams, one partition per minimiser bucket
(see ``repeats``). A refinement sorts positions by the pair of their own bucket
and the bucket of the position one bucket length later; the new buckets hold
positions with equal text of twice the length, and the next refinement uses them
again, until the length is that of the strings looked for. Positions in a bucket
of one are left out of further sorting.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from ordertide.llm import grams
from ordertide.llm.repeats import Units, covered_units, cut_out, grouped, kept_mask

WIDTH = 100
GRAM = 24


def refinements(width: int, first: int) -> list[tuple[int, int]]:
    """(offset, length after): lengths double, the last pair overlaps."""
    steps, have = [], first
    while have < width:
        offset = min(have, width - have)
        steps.append((offset, have + offset))
        have += offset
    return steps


def refined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Bucket numbers of the pairs; each pair that occurs once has a negative one of its own."""
    order = np.lexsort((right, left))
    a, b = left[order], right[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    alone = new & np.append(new[1:], True)
    number = np.cumsum(new) - 1
    number[alone] = -1 - number[alone]
    out = np.empty(len(order), np.int64)
    out[order] = number
    return out


def _refine(width: int):
    first = min(25, width)

    def judge(units: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Whether an earlier window has the same text. Windows come in order of
        document and start within a bucket, and equal ones share a bucket."""
        bucket = grams.run_hashes(units, first).view(np.int64)
        live = at
        steps = refinements(width, first)
        for k, (offset, _) in enumerate(steps):
            need = live  # and the positions whose buckets later steps look up
            for later, _ in steps[k + 1:]:
                need = np.union1d(need, need + later)
            finer = np.full(len(bucket), -1, np.int64)
            finer[need] = refined(bucket[need], bucket[need + offset])
            bucket, live = finer, live[finer[live] >= 0]
        number = bucket[at] if steps else refined(bucket[at], bucket[at])
        order = np.argsort(number, kind="stable")
        again = (number[order][1:] == number[order][:-1]) & (number[order][1:] >= 0)
        hit = np.zeros(len(at), bool)
        hit[order[1:][again]] = True
        return hit
    return judge


DDL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"


def _cut(with_text: bool):
    def cut(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple:
        keep = kept_mask(len(text), starts, ends)
        kept = text if keep.all() else np.frombuffer(text, np.uint8)[keep].tobytes()
        spans = int(np.count_nonzero(np.diff(np.concatenate(([1], keep.astype(np.int8)))) == -1))
        return len(text), len(text) - len(kept), spans, kept if with_text else None, hashlib.sha256(kept).hexdigest()
    return cut


def drop_repeated_strings(docs: DataFrame, width: int = WIDTH, with_text: bool = True) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are ignored) what is left of its
    UTF-8 bytes when each byte covered by a string of ``width`` bytes that also starts
    earlier (smaller doc_id, or earlier in the document) is removed: n_bytes,
    n_removed, n_spans (maximal removed runs), kept (null without ``with_text``; it may
    cut into characters) and its sha256.

    Null text: empty. Null doc_ids come first; rows of one doc_id follow each other by
    text. Empty table: no rows."""
    rows = grouped(docs)
    covered = covered_units(rows, Units(False, width, min(GRAM, width)), _refine(width), all_but_first=True)
    return cut_out(rows, covered, DDL, _cut(with_text))


def op2_suffixes(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return drop_repeated_strings(docs, with_text=False).drop("kept")
