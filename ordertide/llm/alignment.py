"""Alignment of two tokenizers' tokens by interval coalescing.

Each token of a text covers an interval of its bytes. All intervals of both
tokenizers, of a whole block of documents at once, are sorted by start, and the ends
are accumulated to a running maximum: a group ends where the next start reaches that
maximum. Within a group tokens overlap; the A and the B token that end with it are
linked. How often two ids are linked is counted over all documents.

Documents are encoded once, in blocks of a few MB that are written as a table: per
block one row, with its documents' figures, its different pairs of ids and which
document holds which pair how often. A pair of a block is one row of the counting
shuffle and one of the way back, however many documents of the block hold it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.llm.stored import stored, text_blocks

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
#: How a byte-level vocabulary of this kind splits texts before merging (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of text in a block (more only if a text is longer).
BLOCK_CHARS = 2_000_000


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of bytes in a byte-level vocabulary."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Both tokenizers, from the contents of their files, with the bytes of each id.

    The byte-level one runs in ``tiktoken``, from the vocabulary of its file: an id's
    rank is when it was merged, which is checked here against the file's merges."""

    def __init__(self, byte_bpe: bytes, piece_bpe: bytes):
        model = json.loads(byte_bpe)["model"]
        alphabet = _byte_alphabet()
        ranks = {bytes(map(alphabet.__getitem__, token)): i for token, i in model["vocab"].items() if all(c in alphabet for c in token)}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"][a + b] for a, b in merges]
        if made != sorted(made):
            raise ValueError("ids of the byte-level vocabulary aren't in order of their merges")
        self.a = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_bpe)
        a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            a_bytes[i] = token
        b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.bytes = (a_bytes, b_bytes)
        self.lengths = tuple(np.array([len(t) for t in x], np.int64) for x in self.bytes)
        n_a, n_b = len(a_bytes), len(b_bytes)
        #: each id's digits with what may follow it: A ids with , or |, B ids with , or ;
        self.digits = [f"{i}{end}" for n, ends in ((n_a, ",|"), (n_b, ",;")) for end in ends for i in range(n)]
        self.first_digits = (0, n_a, 2 * n_a, 2 * n_a + n_b)

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of A and B; none where either doesn't give back the text's bytes."""
        if not text:
            return [], []
        want = b" " + text.encode()
        a, b = self.a.encode_ordinary(" " + text), self.b.encode(text)
        of_a, of_b = (x.__getitem__ for x in self.bytes)
        return (a, b) if b"".join(map(of_a, a)) == want and b"".join(map(of_b, b)) == want else ([], [])


@lru_cache(maxsize=1)
def _pair(byte_bpe: bytes, piece_bpe: bytes) -> Pair:
    return Pair(byte_bpe, piece_bpe)


def coalesce(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of intervals by start, and in that order the number of each one's group
    of overlapping intervals."""
    order = np.lexsort((starts,))
    reach = np.maximum.accumulate(ends[order]) if len(order) else ends
    new = np.ones(len(order), bool)
    new[1:] = starts[order][1:] >= reach[:-1]
    return order, np.cumsum(new) - 1


class Aligned:
    """Groups and links of a block of texts."""

    def __init__(self, pair: Pair, texts: list[str]):
        found = [pair.encode(t) for t in texts]
        n_a, n_b = (np.array([len(f[k]) for f in found], np.int64) for k in (0, 1))
        self.n_a, self.n_b = n_a, n_b
        ids = [np.fromiter(chain.from_iterable(f[k] for f in found), np.int64, int(n.sum())) for k, n in ((0, n_a), (1, n_b))]
        # in one line of bytes, texts follow each other, so no group spans two
        ends = [np.cumsum(pair.lengths[k][ids[k]]) for k in (0, 1)]
        starts = [ends[k] - pair.lengths[k][ids[k]] for k in (0, 1)]
        order, numbers = coalesce(np.concatenate(starts), np.concatenate(ends))
        group = np.empty_like(numbers)
        group[order] = numbers
        side = np.repeat(np.array([0, 1], np.int64), [len(ids[0]), len(ids[1])])
        doc = np.concatenate([np.repeat(np.arange(len(texts)), n_a), np.repeat(np.arange(len(texts)), n_b)])
        order = np.lexsort((group * 2 + side,))  # A before B in each group, in text order
        self.group, self.side, self.doc = group[order], side[order], doc[order]
        self.ids, self.ends = np.concatenate(ids)[order], np.concatenate(ends)[order]
        last = np.ones(len(order), bool)  # of its side in its group
        last[:-1] = (self.group[1:] != self.group[:-1]) | (self.side[1:] != self.side[:-1])
        at = np.flatnonzero(last)
        a, b = at[self.side[at] == 0], at[self.side[at] == 1]
        same = self.ends[a] == self.ends[b] if len(a) == len(b) else None
        if same is None or not same.all() or (self.group[a] != self.group[b]).any():
            raise ValueError("a group without a token of either side at its end")
        self.link_a, self.link_b, self.link_doc = self.ids[a], self.ids[b], self.doc[a]
        self.n_groups = np.bincount(self.doc[b], minlength=len(texts)) if len(b) else np.zeros(len(texts), np.int64)
        self.last = last

    def written(self, pair: Pair) -> list[str]:
        """Each text's groups as ``a1,a2|b1;a3|b2,b3``."""
        table = np.array(pair.first_digits)[self.side * 2 + self.last]
        parts = list(map(pair.digits.__getitem__, (table + self.ids).tolist()))
        cut = np.concatenate(([0], np.cumsum(np.bincount(self.doc, minlength=len(self.n_a))))) if len(self.doc) else np.zeros(len(self.n_a) + 1, np.int64)
        return ["".join(parts[a:b])[:-1] for a, b in zip(cut.tolist(), cut[1:].tolist(), strict=False)]


def _files(spark, byte_bpe: str, piece_bpe: str):
    """Both files, read by the driver; a few MB for any vocabulary in use."""
    contents = []
    for path in (byte_bpe, piece_bpe):
        with open(path, "rb") as f:
            contents.append(f.read())
    return spark.sparkContext.broadcast(tuple(contents))


def token_groups(docs: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are ignored) its aligned tokens:
    doc_id, and per token, group by group and A before B, its group (from 0), side
    (0: A, 1: B), id and end (byte offset in space + text).

    Null and empty texts, and those that either tokenizer doesn't give back byte by byte,
    have no tokens. Null doc_ids stay null; repeated rows give repeated rows; texts of any
    length are aligned whole; empty table: no rows."""
    shared = _files(docs.sparkSession, byte_bpe, piece_bpe)
    ddl = "doc_id long, groups array<long>, sides array<int>, ids array<long>, ends array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(*shared.value)
        for _, rows in text_blocks(batches, BLOCK_CHARS):
            texts = [t or "" for t in rows["text"].to_pylist()]
            found = Aligned(pair, texts)
            cut = np.searchsorted(found.doc, np.arange(len(texts) + 1))
            sizes = np.bincount(found.doc, minlength=len(texts)) if len(found.doc) else np.zeros(len(texts), np.int64)
            shift = np.repeat(found.group[np.minimum(cut[:-1], max(len(found.group) - 1, 0))] if len(found.group) else np.zeros(len(texts), np.int64), sizes)
            begin = np.repeat(np.cumsum([0, *(len(t.encode()) + 1 if n else 0 for t, n in zip(texts, found.n_a, strict=True))])[:-1], sizes)
            offsets = pa.array(cut, pa.int32())
            columns = [pa.ListArray.from_arrays(offsets, pa.array(x, kind)) for x, kind in
                       ((found.group - shift, pa.int64()), (found.side, pa.int32()), (found.ids, pa.int64()), (found.ends - begin, pa.int64()))]
            yield from pa.Table.from_arrays([rows["doc_id"], *columns], ["doc_id", "groups", "sides", "ids", "ends"]).combine_chunks().to_batches()
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ddl)


_BLOCK = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_a", pa.list_(pa.int64())), ("n_b", pa.list_(pa.int64())),
                    ("n_groups", pa.list_(pa.int64())), ("groups_sha256", pa.list_(pa.string())), ("of_doc", pa.binary()),
                    ("of_pair", pa.binary()), ("times", pa.binary()), ("pairs", pa.binary()), ("counts", pa.binary())])
_BLOCK_DDL = ("block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, groups_sha256 array<string>, "
              "of_doc binary, of_pair binary, times binary, pairs binary, counts binary")
RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _block_rows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(*shared.value)
        for number, rows in text_blocks(batches, BLOCK_CHARS):
            texts = [t or "" for t in rows["text"].to_pylist()]
            found = Aligned(pair, texts)
            digests = [hashlib.sha256(g.encode()).hexdigest() if n else "" for g, n in zip(found.written(pair), found.n_a.tolist(), strict=True)]
            pairs, index, counts = np.unique(found.link_a << 32 | found.link_b, return_inverse=True, return_counts=True)
            held, times = np.unique(found.link_doc * max(len(pairs), 1) + index, return_counts=True)
            of_doc, of_pair = np.divmod(held, max(len(pairs), 1))
            row = [[number], [rows["doc_id"].to_pylist()], [found.n_a], [found.n_b], [found.n_groups], [digests],
                   *([x.astype(kind).tobytes()] for x, kind in ((of_doc, "<i4"), (of_pair, "<i4"), (times, "<i4"), (pairs, "<i8"), (counts, "<i8")))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, _BLOCK.types, strict=True)], schema=_BLOCK)
    return run


def _pairs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, a, b, n) of each pair of each block."""
    for batch in batches:
        for block, pairs, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            pairs = np.frombuffer(pairs, "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), block)), pa.array((pairs >> 32).astype(np.int32)),
                                              pa.array((pairs & 0xFFFFFFFF).astype(np.int32)), pa.array(np.frombuffer(counts, "<i8"))],
                                             names=["block", "a", "b", "n"])


def _figures(blocks: pa.Table, known: pa.Table) -> pa.Table:
    """Figures of a block's documents from its row and the counts of its pairs."""
    schema = pa.schema([(c.split()[0], pa.string() if "string" in c else pa.int64()) for c in RESULT.split(", ")])
    if not blocks.num_rows:
        return schema.empty_table()
    row = blocks.to_pylist()[0]
    of_doc, of_pair, times = (np.frombuffer(row[c], "<i4") for c in ("of_doc", "of_pair", "times"))
    key = known["a"].to_numpy().astype(np.int64) << 32 | known["b"].to_numpy()
    order = np.argsort(key)
    if not np.array_equal(key[order], np.frombuffer(row["pairs"], "<i8")):
        raise ValueError("a block's pairs without counts")
    total, best = known["total"].to_numpy()[order], known["best"].to_numpy(zero_copy_only=False)[order]
    sums, bests = (np.zeros(len(row["doc_ids"]), np.int64) for _ in range(2))
    np.add.at(sums, of_doc, times * total[of_pair])
    np.add.at(bests, of_doc, times * best[of_pair].astype(np.int64))
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(
        (row["doc_ids"], row["n_a"], row["n_b"], row["n_groups"], row["n_groups"], bests, sums, row["groups_sha256"]), schema.types, strict=True)], schema=schema)


def align_tokenizers(docs: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are ignored): tokens of both
    sides, groups, links, links whose pair is the most frequent of its B id in all of
    ``docs`` (ties included), the sum of the links' counts, and the sha256 of its groups.

    Null and empty texts, and those that either tokenizer doesn't give back byte by byte:
    zeros and ''. Null doc_ids stay null; repeated rows count and appear as often as they
    are there; a text longer than a block is a block of its own; empty table: no rows."""
    shared = _files(docs.sparkSession, byte_bpe, piece_bpe)
    blocks = stored(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_block_rows(shared), _BLOCK_DDL), "alignment")
    pairs = blocks.select("block", "pairs", "counts").mapInArrow(_pairs_of, "block long, a int, b int, n long")
    totals = pairs.groupBy("a", "b").agg(F.sum("n").alias("total"))
    most = totals.groupBy("b").agg(F.max("total").alias("most"))
    totals = totals.join(most, "b").select("a", "b", "total", (F.col("total") == F.col("most")).alias("best"))
    known = pairs.select("block", "a", "b").join(totals, ["a", "b"])
    return blocks.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(_figures, RESULT)


def op12_alignment(spark, sf_dir: str) -> DataFrame:
    return align_tokenizers(spark.read.parquet(f"{sf_dir}/documents.parquet"))
