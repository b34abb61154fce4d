"""Alignment of two tokenizers against their libraries and plain loops."""

import hashlib
from collections import Counter

import sentencepiece
from tokenizers import Tokenizer

from ordertide.llm import alignment
from ordertide.ship import ship

SF = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, "a<|endoftext|>b <s> </s><unk>"), (4, "a ▁ b"), (5, "  two\n\n\tthree  "), (None, "naïve café 🙂🙂 ①ﬁ"),
       (None, "naïve café 🙂🙂 ①ﬁ"), (8, "​\x01 x́"), (9, "word " * 30_000), (10, " "), (11, "x" * 5_000), (12, "don't I'll 1234567 ...")]


def plain(rows):
    a = Tokenizer.from_file(alignment.BYTE_BPE)
    a.encode_special_tokens = True
    names = {i: t for t, i in a.get_vocab().items()}
    letters = alignment._byte_alphabet()
    b = sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_BPE)
    docs, counts = [], Counter()
    for doc_id, text in rows:
        want = (" " + (text or "")).encode()
        ids = [a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)] if text else [[], []]
        made = [[bytes(letters[c] for c in names[i]) for i in ids[0]],
                [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]]]
        groups, links = [], []
        if text and b"".join(made[0]) == want == b"".join(made[1]):
            ends = []
            for tokens in made:
                at, of = 0, {}
                for k, t in enumerate(tokens):
                    at += len(t)
                    of[at] = k
                ends.append(of)
            last = (-1, -1)
            for e in sorted(set(ends[0]) & set(ends[1])):
                now = (ends[0][e], ends[1][e])
                groups.append((ids[0][last[0] + 1:now[0] + 1], ids[1][last[1] + 1:now[1] + 1]))
                links.append((ids[0][now[0]], ids[1][now[1]]))
                last = now
        else:
            ids = [[], []]
        counts.update(links)
        docs.append((doc_id, ids, groups, links))
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(most.get(y, 0), n)
    out = []
    for doc_id, ids, groups, links in docs:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc_id, len(ids[0]), len(ids[1]), len(groups), len(links), sum(counts[x] == most[x[1]] for x in links),
                    sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str), docs


def test_odd_texts(spark):
    ship(spark)
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in ODD], "doc_id long, text string, block long, a int, ends string")
    want, docs = plain(ODD)
    assert sorted((tuple(r) for r in alignment.align_tokenizers(df).collect()), key=str) == want
    for r in alignment.token_groups(df).collect():
        if r.doc_id is None:
            continue
        groups = next(d[2] for d in docs if d[0] == r.doc_id)
        found = [([], []) for _ in groups]
        for g, side, i in zip(r.groups, r.sides, r.ids, strict=True):
            found[g][side].append(i)
        assert found == groups
        text = next(t for i, t in ODD if i == r.doc_id)
        assert not groups or r.ends[-1] == len(text.encode()) + 1


def test_blocks(spark):
    """Counts cover all documents, however few a block holds."""
    ship(spark)
    rows = [(i, t) for i, t in ODD if i != 9] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted((tuple(r) for r in alignment.align_tokenizers(df).collect()), key=str) == plain(rows)[0]


def test_empty(spark):
    ship(spark)
    df = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align_tokenizers(df).collect() == [] and alignment.token_groups(df).collect() == []


def test_query(spark):
    ship(spark)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in alignment.op12_alignment(spark, SF).collect()), key=str) == plain(rows)[0]
