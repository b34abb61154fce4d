"""The queries on the driver's tables against SQL or plain versions."""

import hashlib
import os
import re
import sys
from collections import Counter
from itertools import combinations

import duckdb
import numpy as np
import pytest
import sentencepiece

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402

from ordertide.llm import fingerprint, pieces, queries, secrets, toxicity  # noqa: E402

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def table(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    con.execute(f"CREATE VIEW want AS {queries.ORACLE_SQL[name]}")
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM want").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(want)


def plain_sets(table):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in table.items():
        w = WORD.findall(t.translate(low))
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    return sets


def plain_components(sets):
    label = {i: i for i in sets}
    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * len(sets[a] | sets[b]) and label[a] != label[b]:
            old, new = max(label[a], label[b]), min(label[a], label[b])
            label = {i: new if x == old else x for i, x in label.items()}
    return label


def test_jaccard(spark, table):
    sets = plain_sets(table)
    label = plain_components(sets)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.QUERIES["op1_jaccard"](spark, SF).collect()}
    assert got == {i: (len(s), label[i]) for i, s in sets.items()}


def test_suffixes(spark, table):
    seen, want = set(), {}
    for i in sorted(table):
        b = table[i].encode()
        gone = bytearray(len(b))
        for s in range(len(b) - 99):
            if b[s:s + 100] in seen:
                gone[s:s + 100] = b"\1" * 100
            seen.add(b[s:s + 100])
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        want[i] = (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.QUERIES["op2_suffixes"](spark, SF).collect()}
    assert got == want


def test_substrings(spark, table):
    words = {i: WORD.findall(t) for i, t in table.items()}
    times = Counter(tuple(w[k:k + 35]) for w in words.values() for k in range(len(w) - 34))
    want = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - 34):
            if times[tuple(w[k:k + 35])] > 1:
                gone[k:k + 35] = [True] * 35
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.QUERIES["op4_substrings"](spark, SF).collect()}
    assert got == want


def plain_secrets(text):
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, m.end()) for m in re.finditer(assign, text, re.I) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))


def test_secrets(spark, table):
    got = {r.doc_id: r for r in queries.QUERIES["op5_secrets"](spark, SF).collect()}
    for i, t in table.items():
        base = plain_secrets(t)
        assert got[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(base.split(",")) <= set(got[i].spans.split(","))


def test_pieces(spark, table):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    want = {i: hashlib.sha256(np.array(library.encode(t), "<i4").tobytes()).hexdigest() for i, t in table.items()}
    got = queries.QUERIES["op8_pieces"](spark, SF).collect()
    assert {r.doc_id: r.tokens_sha256 for r in got} == want
    assert {r.doc_id: r.decoded_sha256 for r in got} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in table.items()}


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in queries.QUERIES["op9_toxicity"](spark, sf).collect() if r.held_out and labels.get(r.doc_id) is not None]
    toxic = [r for r in rows if labels[r.doc_id] == 1]
    clean = [r for r in rows if labels[r.doc_id] == 0]
    assert sum(r.predicted for r in toxic) >= 0.7 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)


def plain_distance(a: str, b: str) -> int:
    """Insertions and deletions between two strings."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, up = [i], row
        for j, y in enumerate(b, 1):
            row.append(up[j - 1] if x == y else 1 + min(up[j], row[-1]))
    return row[-1]


def test_fingerprints(spark, table):
    got = {r.doc_id: r for r in queries.QUERIES["op10_fingerprints"](spark, SF).collect()}
    ids = sorted(table)
    for i, after in zip(ids, [*ids[1:], ids[0]], strict=True):
        text = table[i]
        half = len(text) // 2
        changed = text[:len(text) - half] + table[after][:half]
        assert got[i].n_chars == len(text) and got[i].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert got[i].fingerprint == fingerprint.fingerprint(text) and got[i].edited_fingerprint == fingerprint.fingerprint(changed)
    (ka, a, _), (kb, b, _) = (got[i].fingerprint.split(":") for i in (ids[0], ids[-1]))
    assert fingerprint._alike(a, a[:20] + b) == pytest.approx(1 - plain_distance(a, a[:20] + b) / (len(a) + 20 + len(b)))
    assert np.median([r.near_edited for r in got.values()]) > 0.4 > 0.1 > np.median([r.near_next for r in got.values()])


def test_pipeline(spark, table):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "secrets", "mixture", "tokens"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    lexicon, curve = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    words = toxicity.automaton(lexicon)

    def score(text):
        f = toxicity.fold(text)
        return toxicity.scores(toxicity.features([toxicity.matched_weight(f, words)], [f.count(" ")]), curve)[0]
    left = {i: t for i, t in table.items() if score(t) < toxicity.THRESHOLD}
    assert len(left) < len(table)
    label = plain_components(plain_sets(left))
    left = {i: t for i, t in left.items() if label[i] == i}
    left = {i: secrets.redacted(t, secrets.find_secrets(t)) for i, t in left.items()}
    # the mix, source by source
    size = {i: len(WORD.findall(t)) for i, t in left.items()}
    sources = sorted({rows[i].source for i in left})
    total = {s: sum(n for i, n in size.items() if rows[i].source == s) for s in sources}
    weight = {s: 1 + k % 3 for k, s in enumerate(sources)}
    free, target = set(sources), {}
    while True:
        level = (sum(total.values()) - sum(target.values())) / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 3 * total[s]]
        if not over:
            break
        target |= {s: 3 * total[s] for s in over}
        free -= set(over)
    target |= {s: level * weight[s] for s in free}
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    want = []
    for s in sources:
        rest = int(target[s] + 1e-9)
        ids = sorted((i for i in left if rows[i].source == s), key=lambda i: hashlib.md5(f"mix:{i}".encode()).hexdigest())
        while rest and total[s]:
            for i in ids:
                if rest >= size[i]:
                    want.append((i, left[i]))
                    rest -= size[i]
                else:
                    if rest:
                        want.append((i, left[i][:list(WORD.finditer(left[i]))[rest - 1].end()]))
                    rest = 0
                    break
    want = sorted((i, np.array(library.encode(t), "<i4").tobytes()) for i, t in want)
    got = sorted((r.doc_id, bytes(r.tokens)) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == want
