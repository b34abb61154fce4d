"""Blocks of rows, and tables that several later jobs read."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ordertide.session import checkpoint_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read again: later jobs start
    from the files, whichever executors are lost, and rows keep the names given to them."""
    path = f"{checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_blocks(batches: Iterator[pa.RecordBatch], chars: int, text: str = "text") -> Iterator[tuple[int, pa.Table]]:
    """The rows of a partition in order, cut into blocks whose ``text`` adds up to ``chars``
    bytes or is one row; each with a number that is its own among all partitions'."""
    first = TaskContext.get().partitionId() << 32
    held: list[pa.RecordBatch] = []
    size = 0

    def block():
        nonlocal first, held, size
        made = (first, pa.Table.from_batches(held))
        first, held, size = first + 1, [], 0
        return made
    for batch in batches:
        lengths = batch.column(batch.schema.get_field_index(text)).to_pylist()
        lengths = [len(t) if t else 0 for t in lengths]
        start = 0
        for i, n in enumerate(lengths):
            if size + n > chars and (held or i > start):
                if i > start:
                    held.append(batch.slice(start, i - start))
                yield block()
                start = i
            size += n
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield block()
