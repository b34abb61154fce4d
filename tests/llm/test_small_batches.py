"""Jaccard join: what a task holds of texts is bounded, whatever comes in one Arrow batch."""

import pyarrow as pa
from pyspark.sql import functions as F

from ordertide.llm import jaccard


def test_tasks_hold_few_texts_at_once(monkeypatch):
    calls, plain = [], jaccard.shingle_sets
    monkeypatch.setattr(jaccard, "shingle_sets", lambda texts, words: calls.append(len(texts)) or plain(texts, words))
    n = 3 * jaccard.BATCH_ROWS + 7
    texts = [f"one two three four five six {i} seven" for i in range(n)]
    a, b = list(range(n)), [n + i // 1000 for i in range(n)]
    b_text = [texts[k - n] for k in b]
    found = [r for out in jaccard._compare(5, 80)([pa.record_batch([a, b, texts, b_text], ["a", "b", "a_text", "b_text"])]) for r in out.to_pylist()]
    assert [(r["a"], r["b"]) for r in found] == list(zip(a, b, strict=True))
    assert [r["linked"] for r in found] == [t == u for t, u in zip(texts, b_text, strict=True)]
    points = list(jaccard._points(5)([pa.record_batch([a, a, a, texts], ["row", "doc_id", "text_hash", "text"])]))
    assert sum(p.num_rows for p in points) == n + jaccard.COUNT_BLOCKS
    assert max(calls) <= jaccard.BATCH_ROWS


def test_batches_are_bounded_in_bytes_while_jobs_run(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.nbytes]})
    df = spark.range(6000).repartition(1).select(F.repeat(F.lit("x"), 4000).alias("t"))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    with jaccard._small_batches(spark):
        most = max(r.n for r in df.mapInArrow(sizes, "n long").collect())
    assert most <= 1.1 * jaccard.BATCH_BYTES and spark.conf.get(key) == before


def test_all_jobs_on_texts_run_inside(spark, monkeypatch):
    seen, plain = [], jaccard._labelled_rows
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    monkeypatch.setattr(jaccard, "_labelled_rows", lambda docs, *a: seen.append(docs.sparkSession.conf.get(key)) or plain(docs, *a))
    docs = spark.createDataFrame([(i, f"a b c d e f {i % 3} g") for i in range(9)], "doc_id long, text string")
    out = jaccard.jaccard_rows(docs)
    assert seen == [str(jaccard.BATCH_BYTES)] and spark.conf.get(key) != seen[0]
    assert "InArrow" not in out._jdf.queryExecution().executedPlan().toString()
    assert len({r.label for r in out.collect()}) == 3
