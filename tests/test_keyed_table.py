"""The table that batches change: merging, visibility, history."""

import os
import random

import pytest
from pyspark.sql import functions as F

from ordertide.operators import commits
from ordertide.operators.keyed_table import KeyedTable


def files(root):
    return sum(len([f for f in names if f.endswith(".parquet")]) for _, _, names in os.walk(root))


def changes(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, deleted boolean")


def test_fifty_batches(spark, scratch):
    table = KeyedTable(scratch, "k string, v int", "k", buckets=2, merge_every=5)
    rnd, state, most = random.Random(1), {}, 0
    for batch in range(50):
        rows = {f"k{rnd.randint(0, 30)}": (rnd.randint(0, 99), rnd.random() < 0.2) for _ in range(6)}
        assert table.apply(changes(spark, [(k, *x) for k, x in rows.items()]).coalesce(1), batch)
        state = {k: v for k, v in ({k: (v, False) for k, v in state.items()} | rows).items()}
        state = {k: v for k, (v, gone) in state.items() if not gone}
        most = max(most, files(scratch))
        if batch % 7 == 0:
            assert {r.k: r.v for r in table.read(spark).collect()} == state
    assert {r.k: r.v for r in table.read(spark).collect()} == state
    assert most <= 3 * 2 + 3 * 5  # three bases of two files, the deltas since the oldest that is kept
    assert table.read(spark).columns == ["k", "v"]


def test_a_batch_is_written_once(spark, scratch):
    table = KeyedTable(scratch, "k string, v int", "k")
    assert table.apply(changes(spark, [("a", 1, False)]), 0)
    assert not table.apply(changes(spark, [("a", 2, False)]), 0)
    assert [tuple(r) for r in table.read(spark).collect()] == [("a", 1)]


def test_half_a_batch_is_never_seen(spark, scratch, monkeypatch):
    table = KeyedTable(scratch, "k string, v int", "k", merge_every=2)
    table.apply(changes(spark, [("a", 1, False), ("b", 1, False)]), 0)

    def killed(*_):
        raise KeyboardInterrupt
    monkeypatch.setattr(commits, "commit", killed)
    with pytest.raises(KeyboardInterrupt):
        table.apply(changes(spark, [("a", 2, False), ("b", 2, False)]), 1)
    assert {tuple(r) for r in table.read(spark).collect()} == {("a", 1), ("b", 1)}
    monkeypatch.undo()
    calls = []
    whole = commits.commit

    def killed_in_merge(spark, root, kind, batch, attempt):
        calls.append(kind)
        if kind == "base":
            raise KeyboardInterrupt
        whole(spark, root, kind, batch, attempt)
    monkeypatch.setattr(commits, "commit", killed_in_merge)
    with pytest.raises(KeyboardInterrupt):  # the delta is there, the base isn't
        table.apply(changes(spark, [("a", 2, False), ("b", None, True)]), 1)
    assert calls == ["delta", "base"] and [tuple(r) for r in table.read(spark).collect()] == [("a", 2)]
    monkeypatch.undo()
    table.apply(changes(spark, [("c", 3, False)]), 2)
    assert {tuple(r) for r in table.read(spark).collect()} == {("a", 2), ("c", 3)}


def test_as_of_a_batch_and_history(spark, scratch):
    table = KeyedTable(scratch, "k string, v int", "k", merge_every=3)
    for batch in range(7):
        table.apply(changes(spark, [("a", batch, False), (f"b{batch}", batch, False)]), batch)
        assert table.read(spark, before=batch).where("k = 'a'").collect() == ([] if batch == 0 else table.read(spark, before=batch).where(F.col("v") == batch - 1).where("k = 'a'").collect())
        assert {r.v for r in table.read(spark, before=batch).where("k = 'a'").collect()} == ({batch - 1} if batch else set())
    with pytest.raises(ValueError):
        table.read(spark, before=1)
    seen = [(r.batch, r.v) for r in table.history(spark).where("k = 'a'").orderBy("batch").collect()]
    assert seen == [(b, b) for b in range(3, 7)]


def test_empty(spark, scratch):
    table = KeyedTable(scratch, "k string, v int", "k")
    assert table.read(spark).collect() == [] and table.history(spark).collect() == []


def scanned(df):
    """Rows that the scans of the executed plan gave."""
    rows, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        if "numFiles" in str(node.metrics().keys()):
            rows += node.metrics().apply("numOutputRows").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return rows


def test_a_lookup_reads_little(spark, scratch):
    table = KeyedTable(scratch, "k string, v long", "k", buckets=8, merge_every=1)
    n = 200_000
    table.apply(spark.range(n).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v")), 0)
    keys = [f"k{i * 19_001 % n}" for i in range(9)] + ["none"]
    rows = table.read(spark, keys=keys)
    assert {r.k: r.v for r in rows.collect()} == {k: int(k[1:]) for k in keys[:-1]}
    assert 0 < scanned(rows) < n // 20
    found = {r.k: (r.found, r.v) for r in table.lookup(spark, keys).collect()}
    assert len(found) == 10 and found["none"] == (False, None) and found[keys[0]] == (True, int(keys[0][1:]))
