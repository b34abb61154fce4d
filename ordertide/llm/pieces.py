"""SentencePiece (BPE) encoding and decoding by suffix-array matching.

A batch's different words are joined to one text with a suffix array. Every
vocabulary piece is binary-searched in it for its range of occurrences. The
occurrences are the edges of a graph over the text; sorted by position, they are
relaxed from left to right.

Byte-pair merging gives each prefix of a word exactly one last piece, and a piece
may follow another if merging the two side by side leaves both whole. So an edge
extends the prefix before it if its piece may follow that prefix's last piece,
and at most one edge into each position does. The result is the library's own
segmentation, not only one of equal score. Characters outside the vocabulary
become byte pieces.

Whether two pieces may stand side by side follows from how each was merged: going
back in time, the edge pieces of both come apart one by one, and no pair of them
may have a merge that would have come first.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from functools import lru_cache
from itertools import count

import numpy as np
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.llm.arrow import map_columns

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Characters of text whose words are indexed at once.
BATCH_CHARS = 2_000_000
#: Rows handled at once.
BATCH_ROWS = 1_000
#: Slots of a worker's memory of pairs that it has judged.
SLOTS = 1 << 22
_NONE = 2**31 - 1


def _merged(symbols: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> tuple[list[int], tuple[int, int] | None]:
    """Byte-pair merging: the best pair first, the leftmost of equals. Also the last merge."""
    last = None
    while True:
        found = min(((m[0], i) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)) if (m := merges.get(p))), default=None)
        if found is None:
            return symbols, last
        i = found[1]
        last = (symbols[i], symbols[i + 1])
        symbols = [*symbols[:i], merges[last][1], *symbols[i + 2:]]


class Vocabulary:
    """Tables of a SentencePiece BPE model, from its serialised bytes. The library only
    reads the file; it encodes nothing."""

    def __init__(self, model: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.size = sp.get_piece_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(n)]
        text = [sp.id_to_piece(i) for i in range(n)]
        self.byte_ids = {int(text[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.bytes = [bytes([int(text[i][3:5], 16)]) if sp.is_byte(i) else b"" if special[i]
                      else text[i].replace(SPACE, " ").encode() for i in range(n)]
        ids = {text[i]: i for i in range(n) if not special[i]}
        self.single = {t: i for t, i in ids.items() if len(t) == 1}
        long = sorted((i for t, i in ids.items() if len(t) > 1), key=lambda i: (-sp.get_score(i), i))
        self.rank = np.full(n, -1, np.int64)
        self.rank[long] = np.arange(len(long))
        self.merges = {(ids[a], ids[b]): (int(self.rank[i]), i) for i in long for k in range(1, len(text[i]))
                       if (a := text[i][:k]) in ids and (b := text[i][k:]) in ids}
        self.left, self.right = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        self.made = set(self.single.values())
        for i in long:
            if all(c in self.single for c in text[i]):
                symbols, last = _merged([self.single[c] for c in text[i]], self.merges)
                if symbols == [i]:
                    self.left[i], self.right[i] = last
                    self.made.add(i)
        self.text = {i: text[i] for i in sorted(self.made)}
        keys = np.array([a * n + b for a, b in self.merges], np.int64)
        order = np.argsort(keys)
        self.pair_keys = np.append(keys[order], 2**62)
        self.pair_ranks = np.append(np.array([r for r, _ in self.merges.values()], np.int64)[order], _NONE)
        self.longest = max(map(len, self.text.values()), default=1)
        # words end where no piece can go on: before a space after another character, around line ends
        inner = {c for t in self.text.values() if len(t) > 1 for c in t}
        spaced = not any(SPACE in t.lstrip(SPACE) for t in self.text.values())
        breaks = "" if "\n" in inner else "\n"
        self.words = re.compile(f"{SPACE}*[^{SPACE}{breaks}]+|{SPACE}+" + "|\n+" * bool(breaks) if spaced else "(?s).+")
        self.slots = np.zeros(SLOTS, np.int64)

    def may_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether piece b may come right after piece a; judged pairs are remembered."""
        key = a * self.size + b + 1
        slot = ((key * 0x9E3779B97F4A7C1) >> 20) & (SLOTS - 1)
        held = self.slots[slot]
        ok = held == key * 2 + 1
        new = np.flatnonzero(~ok & (held != key * 2))
        if len(new):
            first, back = np.unique(key[new], return_inverse=True)
            at = np.empty(len(first), np.int64)
            at[back] = new
            found = self._judged(a[at], b[at])
            self.slots[slot[at]] = first * 2 + found
            ok[new] = found[back]
        return ok

    def _judged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        ok = np.ones(len(a), bool)
        at = np.flatnonzero((a < self.size) & (b < self.size))  # others are characters that never merge
        a, b = a[at], b[at]
        until_a, until_b = np.full(len(at), _NONE), np.full(len(at), _NONE)
        while len(at):
            key = a * self.size + b
            i = np.searchsorted(self.pair_keys, key)
            merge = np.where(self.pair_keys[i] == key, self.pair_ranks[i], _NONE)
            bad = (merge < until_a) & (merge <= until_b) & (merge < _NONE)
            ok[at[bad]] = False
            made_a, made_b = self.rank[a], self.rank[b]
            go = ~bad & ((made_a >= 0) | (made_b >= 0))
            at, a, b, until_a, until_b, made_a, made_b = (x[go] for x in (at, a, b, until_a, until_b, made_a, made_b))
            part_a = made_a > made_b  # of equal ranks the left one was merged first
            until_a, until_b = np.where(part_a, made_a, until_a), np.where(part_a, until_b, made_b)
            a, b = np.where(part_a, self.right[a], a), np.where(part_a, b, self.left[b])
        return ok

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all words in a row (characters outside the vocabulary: size plus
        code point), and how many each word has."""
        text = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        size = np.array([len(w) for w in words], np.int64)
        begin = np.cumsum(size) - size
        inside = np.arange(len(text)) - np.repeat(begin, size)
        left = np.repeat(size, size) - inside  # characters to the word's end
        start, piece, length = self._edges(text, left)
        end = inside[start] + length
        order = np.argsort(end, kind="stable")
        start, piece, length, end = start[order], piece[order], length[order], end[order]
        last = np.full(len(text) + 1, -1, np.int64)  # the last piece of the prefix up to and with a character
        cut = np.searchsorted(end, np.arange(1, int(size.max(initial=0)) + 2))
        for lo, hi in zip(cut, cut[1:], strict=False):
            s, p = start[lo:hi], piece[lo:hi]
            good = inside[s] == 0
            rest = np.flatnonzero(~good)
            before = last[s[rest] - 1]
            rest, before = rest[before >= 0], before[before >= 0]
            good[rest] = self.may_follow(before, p[rest])
            last[s[good] + length[lo:hi][good] - 1] = p[good]
        lengths = np.ones(self.size, np.int64)
        lengths[list(self.text)] = [len(t) for t in self.text.values()]
        at, of, found = begin + size - 1, np.arange(len(words)), []
        while len(of):
            p = last[at]
            found.append((of, p))
            at = at - np.where(p < self.size, lengths[np.minimum(p, self.size - 1)], 1)
            go = at >= begin[of]
            at, of = at[go], of[go]
        if not found:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        of, ids = np.concatenate([f[0] for f in found])[::-1], np.concatenate([f[1] for f in found])[::-1]
        if (ids < 0).any():
            raise ValueError("a prefix without a last piece: not a byte-pair model")
        return ids[np.argsort(of, kind="stable")], np.bincount(of, minlength=len(words))

    def _edges(self, text: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, piece, length) of every occurrence of a piece within a word."""
        suffixes, keys = _suffix_array(text, left, self.longest)
        pieces = np.array(list(self.text), np.int64)
        size = np.array([len(t) for t in self.text.values()], np.int64)
        chars = np.frombuffer("".join(self.text.values()).encode("utf-32-le"), np.uint32).astype(np.int64)
        begin = np.cumsum(size) - size
        to_end = np.repeat(size, size) - (np.arange(len(chars)) - np.repeat(begin, size))
        low = [k[begin] for k in _packed(chars, to_end, self.longest, 0)]
        high = [k[begin] for k in _packed(chars, to_end, self.longest, _TOP)]
        first, after = _search(suffixes, keys, low), _search(suffixes, keys, high)
        n = after - first
        at = suffixes[np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())]
        unknown = np.flatnonzero(~np.isin(text, np.array([ord(c) for c in self.single], np.int64)))
        return (np.concatenate((at, unknown)), np.concatenate((np.repeat(pieces, n), self.size + text[unknown])),
                np.concatenate((np.repeat(size, n), np.ones(len(unknown), np.int64))))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts in a row, and how many each has."""
        index: dict[str, int] = defaultdict(count().__next__)
        numbers, counts = [], []
        for t in texts:
            found = self.words.findall(SPACE + t.replace(" ", SPACE)) if t else []
            numbers += map(index.__getitem__, found)
            counts.append(len(found))
        ids, n = self.encode_words(list(index))
        begin = np.cumsum(n) - n
        numbers = np.array(numbers, np.int64)
        each = n[numbers]
        ids = ids[np.repeat(begin[numbers] - np.cumsum(each) + each, each) + np.arange(each.sum())]
        edge = np.concatenate(([0], np.cumsum(each)))[np.cumsum([0, *counts])]
        if (ids >= self.size).any():  # byte pieces
            wide = np.flatnonzero(ids >= self.size)
            made = [[self.byte_ids[b] for b in chr(c).encode("utf-8", "surrogatepass")] for c in (ids[wide] - self.size).tolist()]
            more = np.ones(len(ids), np.int64)
            more[wide] = [len(m) for m in made]
            out = np.repeat(ids, more)
            spread = np.repeat(np.isin(np.arange(len(ids)), wide), more)
            out[spread] = [b for m in made for b in m]
            edge = np.concatenate(([0], np.cumsum(more)))[edge]
            ids = out
        return ids.astype(np.int32), np.diff(edge)

    def encoded(self, texts: list[str]) -> list[np.ndarray]:
        ids, n = self.encode(texts)
        return np.split(ids.astype("<i4"), np.cumsum(n)[:-1])

    def decode(self, ids) -> str:
        made = b"".join(map(self.bytes.__getitem__, ids))
        return made[1:].decode("utf-8", "replace") if made[:1] == b" " else made.decode("utf-8", "replace")


#: A character that sorts after all others; 21 bits hold any code point plus one.
_TOP = 2**21 - 1


def _packed(text: np.ndarray, left: np.ndarray, longest: int, after: int) -> list[np.ndarray]:
    """The first ``longest`` characters from each position, three to a number; what lies
    beyond the word's end is ``after``."""
    keys = []
    padded = np.concatenate((text + 1, np.zeros(longest + 3, np.int64)))
    for k in range(0, longest, 3):
        key = np.zeros(len(text), np.int64)
        for j in range(k, k + 3):
            key = key << 21 | np.where(j < left, padded[j:j + len(text)], after)
        keys.append(key)
    return keys


def _suffix_array(text: np.ndarray, left: np.ndarray, longest: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions in order of the word's text from there on, as far as a piece can reach,
    and that text's packed characters. Only positions still equal are sorted again."""
    keys = _packed(text, left, longest, 0)
    order = np.argsort(keys[0], kind="stable")
    tied = np.zeros(len(order) + 1, bool)  # the same as the one before, by the keys so far
    tied[1:-1] = keys[0][order][1:] == keys[0][order][:-1]
    for key in keys[1:]:
        part = np.flatnonzero(tied[:-1] | tied[1:])
        if not len(part):
            break
        group = np.cumsum(~tied[:-1])[part]
        at = order[part]
        new = np.lexsort((key[at], group))
        order[part] = at[new]
        k = key[order[part]]
        tied[part[1:]] &= k[1:] == k[:-1]
    return order, keys


def _search(order: np.ndarray, keys: list[np.ndarray], wanted: list[np.ndarray]) -> np.ndarray:
    """For each wanted key, how many suffixes are smaller."""
    lo, hi = np.zeros(len(wanted[0]), np.int64), np.full(len(wanted[0]), len(order))
    while (active := lo < hi).any():
        mid = (lo + hi) // 2
        at = order[np.minimum(mid, len(order) - 1)]
        less, same = np.zeros(len(lo), bool), np.ones(len(lo), bool)
        for key, want in zip(keys, wanted, strict=True):
            k = key[at]
            less |= same & (k < want)
            same &= k == want
        lo, hi = np.where(active & less, mid + 1, lo), np.where(active & ~less, mid, hi)
    return lo


@lru_cache(maxsize=2)
def _vocabulary(model: bytes) -> Vocabulary:
    return Vocabulary(model)


def read_model(path: str = MODEL) -> bytes:
    """The model file, read by the driver; some hundred kB for any vocabulary size in use."""
    with open(path, "rb") as f:
        return f.read()


def _batches(texts: list[str]):
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= BATCH_CHARS:
            yield texts[start:i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield texts[start:]


def encode_texts(docs: DataFrame, model: bytes) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, n_tokens,
    tokens (little-endian 32-bit ids, packed) as the library's BPE encoding.

    Null and empty text: no tokens. A U+2581 in a text counts as a space, as in the
    library. Null doc_id stays null; repeated rows give repeated rows; empty table: no
    rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(doc_ids: list, texts: list) -> list:
        vocabulary = _vocabulary(shared.value)
        found = [t for part in _batches([t or "" for t in texts]) for t in vocabulary.encoded(part)]
        return [doc_ids, [len(t) for t in found], [t.tobytes() for t in found]]
    return map_columns(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, n_tokens long, tokens binary", BATCH_ROWS)


def decode_tokens(encoded: DataFrame, model: bytes) -> DataFrame:
    """(doc_id, n_tokens, tokens) with the text that the tokens stand for."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def run(doc_ids: list, n_tokens: list, tokens: list) -> list:
        vocabulary = _vocabulary(shared.value)
        return [doc_ids, n_tokens, tokens, [vocabulary.decode(np.frombuffer(t, "<i4").tolist()) for t in tokens]]
    return map_columns(encoded.select("doc_id", "n_tokens", "tokens"), run, "doc_id long, n_tokens long, tokens binary, text string", BATCH_ROWS)


def round_trip(docs: DataFrame, model: bytes) -> DataFrame:
    """``encode_texts`` and ``decode_tokens`` in one pass: doc_id, n_tokens and the
    sha256 of the packed tokens and of the text decoded from them."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(doc_ids: list, texts: list) -> list:
        vocabulary = _vocabulary(shared.value)
        out = []
        for part in _batches([t or "" for t in texts]):
            for tokens in vocabulary.encoded(part):
                text = vocabulary.decode(tokens.tolist())
                out.append((len(tokens), hashlib.sha256(tokens.tobytes()).hexdigest(),
                            hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()))
        return [doc_ids, *map(list, zip(*out, strict=True))]
    return map_columns(docs.select(F.col("doc_id").cast("long"), "text"), run, ROUND_TRIP, BATCH_ROWS)


ROUND_TRIP = "doc_id long, n_tokens long, tokens_sha256 string, decoded_sha256 string"


def op8_pieces(spark, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"), read_model())
