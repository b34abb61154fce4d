"""Arrow batches as Python columns, for the operators that run Python in tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(),
         "boolean": pa.bool_(), "binary": pa.binary()}


def arrow_schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, TYPES[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def record_batch(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def map_columns(df: DataFrame, fn: Callable[..., list], ddl: str, rows: int = 2_000) -> DataFrame:
    """``fn`` gets each column of up to ``rows`` rows as a list and returns the columns of ``ddl``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(ddl)
        for batch in batches:
            for a in range(0, batch.num_rows, rows):
                yield record_batch(fn(*(c.to_pylist() for c in batch.slice(a, rows).columns)), schema)
    return df.mapInArrow(run, ddl)


def map_text(df: DataFrame, fn: Callable[[str], str], column: str = "text") -> DataFrame:
    """``df`` with ``fn`` of each text that isn't null; other columns untouched."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i = batch.schema.get_field_index(column)
            made = pa.array([None if t is None else fn(t) for t in batch.column(i).to_pylist()], batch.schema.field(i).type)
            yield batch.set_column(i, batch.schema.field(i), made)
    return df.mapInArrow(run, df.schema)
