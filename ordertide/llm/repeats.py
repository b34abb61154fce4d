"""Windows that repeat: the part that substring and suffix-array dedup share.

A document is a sequence of units (words, or bytes). Each window of ``width``
units is represented by its minimiser, the run of ``gram`` units in it with the
smallest hash. Equal windows have equal minimisers, so only windows whose
minimiser occurs as such twice or more can repeat.

1. Documents are dealt into groups of about GROUP_ROWS. Each group gives its
   different minimisers with counts: 64-bit hashes, so a frequent passage gives
   one row per group. A minimiser counted once in the whole table is dropped.
2. Consecutive windows with one kept minimiser travel as one packed piece of text
   to the bucket of that minimiser. Pieces are cut and shuffled once.
3. A bucket of up to BUCKET_PIECES pieces is judged as a whole by the caller's
   method, equal pieces once. Pieces of a more frequent minimiser are spread by
   group, a group sends the bytes of equal ones once; equal pieces are first made one
   by a grouped minimum, and windows of what is left are compared by a second
   aggregation, so no task gets a whole frequent passage.
4. The covered units go back to the documents' groups, which cut them out.

Texts are shuffled once, by group; all later uses read the same shuffle, so nothing
is written in between.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordertide.llm import grams
from ordertide.llm.arrow import arrow_schema, record_batch

GROUP_ROWS = 1_024
BUCKET_PIECES = 16_384
#: Units handled at once in a task.
BLOCK_UNITS = 250_000


@dataclass(frozen=True)
class Units:
    """What a document's units are."""
    words: bool
    width: int
    gram: int

    def hashed(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Unit hashes of all texts, and how many each has."""
        if self.words:
            return grams.words_of(texts)
        return grams.BYTES[np.frombuffer(b"".join(texts), np.uint8)], np.array([len(t) for t in texts], np.int64)

    def pieces(self, texts: list[bytes], doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[bytes]:
        """Units [start, end) of each document, packed; start and end count within it."""
        if not self.words:
            return [texts[d][s:e] for d, s, e in zip(doc, start, end, strict=True)]
        out, last, words = [], None, []
        for d, s, e in zip(doc.tolist(), start.tolist(), end.tolist(), strict=True):
            if d != last:
                last, words = d, texts[d].split()  # of bytes: splits at ASCII white space only
            out.append(b" ".join(words[s:e]))
        return out

    def minimisers(self, texts: list[bytes]):
        """For each run of consecutive windows with one minimiser: its hash, the
        document, and the first and last window's start in the document."""
        units, counts = self.hashed(texts)
        n_windows = len(units) - self.width + 1
        if n_windows < 1:
            return (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 3
        h = grams.run_hashes(units, self.gram)
        low = np.uint64(2**32 - 1)
        least = grams.sliding_min((h & ~low) | np.arange(len(h), dtype=np.uint64), self.width - self.gram + 1)
        at = (least & low).astype(np.int64)[:n_windows]
        begin = np.concatenate(([0], np.cumsum(counts)))
        doc = np.repeat(np.arange(len(counts)), counts)
        whole = doc[:n_windows] == doc[self.width - 1:]
        change = np.empty(n_windows, bool)
        change[0] = True
        change[1:] = (at[1:] != at[:-1]) | (whole[1:] != whole[:-1]) | (doc[1:n_windows] != doc[:n_windows - 1])
        first = np.flatnonzero(change)
        last = np.append(first[1:], n_windows) - 1
        first, last = first[whole[first]], last[whole[first]]
        d = doc[first]
        return h[at[first]], d, first - begin[d], last - begin[d]


def _in_order(table: pa.Table) -> tuple[list, list[bytes]]:
    """doc_ids and UTF-8 texts of a group, by doc_id (null first), then text: the
    place in this order names a row wherever the group is seen."""
    rows = sorted(((i is not None, i or 0, t or b"") for i, t in
                   zip(table["doc_id"].to_pylist(), table["text"].to_pylist(), strict=True)))
    return [i if known else None for known, i, _ in rows], [t for *_, t in rows]


def _blocks(texts: list[bytes], units: Units) -> Iterator[tuple[int, int]]:
    return grams.blocks([len(t) for t in texts], BLOCK_UNITS * (6 if units.words else 1))


GRAMS = "g long, gram long, n long"
#: salt: -1, or the group for pieces of a frequent minimiser. Those have a name, and
#: bytes only for the first of a name in its group.
PIECES = "gram long, salt long, g long, place long, doc_id long, start long, last long, name binary, piece binary"
COVERED = "g long, place long, start long, end long"


def _gram_counts(units: Units):
    def run(key, table):
        _, texts = _in_order(table)
        found = [units.minimisers(texts[a:b])[0] for a, b in _blocks(texts, units)]
        gram, n = np.unique(np.concatenate(found), return_counts=True)
        return pa.Table.from_batches([record_batch([np.full(len(gram), key[0].as_py()), gram.view(np.int64), n], arrow_schema(GRAMS))])
    return run


def _cut_pieces(units: Units):
    def run(key, docs, kept):
        out, g = [], key[0].as_py()
        if docs.num_rows and kept.num_rows:
            ids, texts = _in_order(docs)
            known = kept["gram"].to_numpy().view(np.uint64)
            order = np.argsort(known)
            known, frequent = known[order], kept["often"].to_numpy()[order]
            sent = set()  # names of frequent pieces
            for a, b in _blocks(texts, units):
                gram, doc, first, last = units.minimisers(texts[a:b])
                at = np.minimum(np.searchsorted(known, gram), len(known) - 1)
                use = known[at] == gram
                gram, doc, first, last, often = gram[use], doc[use], first[use], last[use], frequent[at[use]]
                pieces = units.pieces(texts[a:b], doc, first, last + units.width)
                names = [None] * len(pieces)
                for i in np.flatnonzero(often).tolist():
                    names[i] = hashlib.blake2b(pieces[i], digest_size=16).digest()
                    if names[i] in sent:
                        pieces[i] = None
                    sent.add(names[i])
                out.append(record_batch([
                    gram.view(np.int64), np.where(often, g, -1), np.full(len(gram), g), doc + a, [ids[a + d] for d in doc.tolist()],
                    first, last, names, pieces], arrow_schema(PIECES)))
        return pa.Table.from_batches(out, arrow_schema(PIECES))
    return run


def _runs(place: list[np.ndarray], window: np.ndarray, hit: np.ndarray, width: int) -> list[np.ndarray]:
    """Rows of COVERED for windows in order of (row, window): consecutive hits make one.
    ``place``: arrays, per window, that name its document."""
    at = np.flatnonzero(hit)
    if not len(at):
        return [np.zeros(0, np.int64)] * (len(place) + 2)
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(window[at]) != 1) | np.any([p[at][1:] != p[at][:-1] for p in place], axis=0)
    first = at[new]
    last = at[np.append(np.flatnonzero(new)[1:], len(at)) - 1]
    return [*(p[first] for p in place), window[first], window[last] + width]


def windows_of(units: Units, pieces: list[bytes], n_windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit hashes of all pieces, and where each window starts among them."""
    hashed, counts = units.hashed(pieces)
    begin = np.cumsum(counts) - counts
    return hashed, _ranges(begin, n_windows)


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[i], start[i] + 1, ... n[i] of them, for each i."""
    return np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())


def _judge_buckets(units: Units, judge: Callable, all_but_first: bool):
    """PIECES sorted by bucket, then document and start. Of equal pieces, which share
    a bucket, the first is judged: all windows of a later one start earlier too."""
    def covered(rows: pa.Table):
        col = lambda name: rows[name].to_numpy()
        start, n = col("start"), col("last") - col("start") + 1
        texts = pc.dictionary_encode(rows["piece"].combine_chunks())
        kind = texts.indices.to_numpy()  # numbered by first occurrence
        first = np.unique(kind, return_index=True)[1]
        hashed, at = windows_of(units, texts.dictionary.to_pylist(), n[first])
        again = np.ones(len(n), bool)
        again[first] = False
        if not all_but_first:
            again = np.bincount(kind)[kind] > 1
        hit = np.repeat(again, n)
        judged = np.zeros(len(n), bool)
        judged[first] = True
        hit[np.repeat(judged, n)] |= judge(hashed, at)
        return record_batch(_runs([np.repeat(col("g"), n), np.repeat(col("place"), n)], _ranges(start, n), hit, units.width),
                            arrow_schema(COVERED))

    def run(batches):
        held = []  # batches of whole buckets, but for the last bucket
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows * (2 * units.width)
            if size < BLOCK_UNITS:
                continue
            rows = pa.Table.from_batches(held)
            gram = rows["gram"].to_numpy()
            cut = int(np.searchsorted(gram, gram[-1]))
            if cut:
                yield covered(rows.slice(0, cut))
                rows = rows.slice(cut)
            held = rows.combine_chunks().to_batches()
            size = rows.num_rows * (2 * units.width)
        if held:
            yield covered(pa.Table.from_batches(held))
    return run


def _as_is(batches):
    yield from batches


WINDOWS = "h1 long, h2 long, g long, place long, doc_id long, start long, n long"


def _explode_windows(units: Units):
    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK_UNITS // (2 * units.width)):
                rows = batch.slice(a, BLOCK_UNITS // (2 * units.width))
                col = lambda name, rows=rows: rows[name].to_numpy(zero_copy_only=False)
                start, n = col("start"), col("last") - col("start") + 1
                hashed, at = windows_of(units, rows["piece"].to_pylist(), n)
                h = grams.run_hashes(hashed, units.width)[at]
                doc_id = rows["doc_id"].take(pa.array(np.repeat(np.arange(len(n)), n)))
                yield record_batch([h.view(np.int64), grams.run_hashes(grams.mixed(hashed + np.uint64(1)), units.width)[at].view(np.int64),
                                    np.repeat(col("g"), n), np.repeat(col("place"), n), doc_id, _ranges(start, n),
                                    np.repeat(col("n"), n)], arrow_schema(WINDOWS))
    return run


def _window_runs(units: Units):
    """One-window rows sorted by document and start, made into runs within a batch."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                g, place, start = (b[c].to_numpy() for c in ("g", "place", "start"))
                yield record_batch(_runs([g, place], start, np.ones(len(g), bool), units.width), arrow_schema(COVERED))
    return run


def grouped(docs: DataFrame) -> DataFrame:
    """(g, doc_id, text as UTF-8) dealt by group; rows of one doc_id share a group."""
    n = max(1, -(-docs.count() // GROUP_ROWS))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    g = F.pmod(F.xxhash64(F.coalesce("doc_id", F.xxhash64("text"))), F.lit(n))
    return docs.select(g.alias("g"), "doc_id", "text").repartition("g")


def covered_units(docs: DataFrame, units: Units, judge: Callable, all_but_first: bool) -> DataFrame:
    """COVERED rows of ``grouped`` documents: units covered by a repeated window.
    ``all_but_first``: a window counts if the same one starts earlier (by doc_id, null
    first, then group, place and start); else if the same one starts anywhere else."""
    counts = docs.groupBy("g").applyInArrow(_gram_counts(units), GRAMS)
    kept = counts.withColumn("total", F.sum("n").over(Window.partitionBy("gram"))).where("total > 1")

    kept = kept.select("g", "gram", (F.col("total") > BUCKET_PIECES).cast("long").alias("often"))
    cut = docs.groupBy("g").cogroup(kept.groupBy("g")).applyInArrow(_cut_pieces(units), PIECES).repartition("gram", "salt")

    def dealt(salted: bool) -> DataFrame:
        # rand() (below 1) keeps the filter above the shuffle, so that both readers share it
        salt = F.col("salt") + F.floor(F.rand(0))
        return cut.where(salt >= 0 if salted else salt < 0)

    usual = dealt(False).sortWithinPartitions("gram", "doc_id", "g", "place", "start")
    found = usual.mapInArrow(_judge_buckets(units, judge, all_but_first), COVERED)

    # through Arrow with all columns, for the same reason
    often = dealt(True).mapInArrow(_as_is, PIECES).withColumn("first", F.struct("doc_id", "g", "place", "start", "last"))
    same = often.groupBy("gram", "name").agg(F.min("first").alias("head"), F.count("*").alias("n"), F.min("piece").alias("piece"))
    repeated = (F.col("first") != F.col("head")) if all_but_first else F.col("n") > 1
    members = often.drop("piece").join(same.drop("piece"), ["gram", "name"]).where(repeated)
    found = found.unionByName(members.select("g", "place", "start", (F.col("last") + units.width).alias("end")))
    heads = same.select("head.*", "piece", "n")
    windows = heads.mapInArrow(_explode_windows(units), WINDOWS).withColumn("at", F.struct("doc_id", "g", "place", "start"))
    first = windows.groupBy("h1", "h2").agg(F.min("at").alias("least"), F.sum("n").alias("times"), F.count("*").alias("heads"))
    first = first.where("heads > 1")
    again = windows.join(first, ["h1", "h2"])
    if all_but_first:
        again = again.where(F.col("at") != F.col("least"))
    again = again.select("g", "place", "start").repartition("g").sortWithinPartitions("g", "place", "start")
    return found.unionByName(again.mapInArrow(_window_runs(units), COVERED))


def kept_mask(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) == 0


def cut_out(docs: DataFrame, covered: DataFrame, ddl: str, cut: Callable[[bytes, np.ndarray, np.ndarray], tuple]) -> DataFrame:
    """A row (doc_id, *cut(text, starts, ends)) for each of the ``grouped`` documents."""
    def run(key, texts, spans):
        ids, texts = _in_order(texts)
        place, start, end = (spans[c].to_numpy() for c in ("place", "start", "end"))
        order = np.lexsort((start, place))
        place, start, end = place[order], start[order], end[order]
        edge = np.searchsorted(place, np.arange(len(texts) + 1))
        rows = [cut(t, start[edge[i]:edge[i + 1]], end[edge[i]:edge[i + 1]]) for i, t in enumerate(texts)]
        schema = arrow_schema(ddl)
        return pa.Table.from_batches([record_batch([ids, *map(list, zip(*rows, strict=True))], schema)] if rows else [], schema)
    return docs.groupBy("g").cogroup(covered.groupBy("g")).applyInArrow(run, ddl)
