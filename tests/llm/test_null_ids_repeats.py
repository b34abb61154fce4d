"""A passage shared by rows without doc_ids in different groups."""

import pytest

from ordertide.llm import repeats, suffixes

WORDS = " ".join(f"word{i}" for i in range(50))


@pytest.mark.parametrize("bucket", [1, 3])
def test_one_row_keeps_the_passage(spark, monkeypatch, bucket):
    monkeypatch.setattr(repeats, "GROUP_ROWS", 2)
    # ends that differ, so that the pieces at them do; places that shift the passage
    rows = [(None, " " * (i % 3) + f"{WORDS} {chr(97 + i) * 60}") for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    usual = sorted((r.n_bytes, r.n_removed, r.kept) for r in suffixes.drop_repeated_strings(docs).collect())
    assert sum(removed == 0 for _, removed, _ in usual) == 1
    monkeypatch.setattr(repeats, "BUCKET_PIECES", bucket)
    split = sorted((r.n_bytes, r.n_removed, r.kept) for r in suffixes.drop_repeated_strings(docs).collect())
    assert split == usual
