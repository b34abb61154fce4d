"""File-backed topics as a streaming source.

A position is the last committed batch of each writer, so it has one number per writer
however long the topic is. A micro-batch reads the batches between two positions, one
task for each file of the topic. Batches that aren't committed, or that a failed writer
left, are never seen, and a committed one is read once: it can't change any more.

``batchesPerTrigger`` limits how many batches of each writer a micro-batch takes. Spark
doesn't tell a source where a restarted query stands before it asks for the latest
position, so the first micro-batch after a restart takes all there is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from ordertide import schema as S
from ordertide.operators.commits import commit_folder, data_folder, parse

_NUMBERED = re.compile(r"(.*?)-?(\d+)$")


def writer_of(batch: str) -> tuple[str, int]:
    """A batch's writer and its number there; a name without a number is a writer's only batch."""
    m = _NUMBERED.fullmatch(batch)
    return (m[1], int(m[2])) if m else (batch, 0)


def _open(root: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"file:/(?!/)", root):
        root = root[5:]
    return fs.FileSystem.from_uri(root)


def _names(root: str, folder: str) -> list[str]:
    system, path = _open(folder)
    return [f.base_name for f in system.get_file_info(fs.FileSelector(path, allow_not_found=True))]


class File(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class TopicLogReader(DataSourceStreamReader):
    def __init__(self, root: str, topic: str, per_trigger: int | None):
        self.root, self.topic, self.per_trigger = root.rstrip("/"), topic, per_trigger
        self.at: dict | None = None  # the last position given or asked for

    def _committed(self) -> dict[str, list[tuple[int, str]]]:
        """Writer -> its batches (number, folder), ascending."""
        found: dict[str, list[tuple[int, str]]] = {}
        for batch, attempt in parse(_names(self.root, commit_folder(self.root, "log"))).items():
            writer, n = writer_of(batch)
            found.setdefault(writer, []).append((n, data_folder(self.root, "log", batch, attempt)))
        return {w: sorted(b) for w, b in found.items()}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        at = {} if self.at is None else dict(self.at)
        for writer, batches in self._committed().items():
            new = [n for n, _ in batches if n > at.get(writer, -1)]
            if self.per_trigger and self.at is not None:
                new = new[:self.per_trigger]
            if new:
                at[writer] = new[-1]
        self.at = at
        return at

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        if self.at is None or any(self.at.get(w, -1) < n for w, n in end.items()):
            self.at = dict(end)
        found = []
        for writer, batches in self._committed().items():
            for n, folder in batches:
                if start.get(writer, -1) < n <= end.get(writer, -1):
                    topic = f"{folder}/_topic={self.topic}"
                    found += [File(f"{topic}/{name}") for name in sorted(_names(self.root, topic)) if name.endswith(".parquet")]
        return found

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        system, path = _open(partition.path)
        target = pa.schema([("key", pa.string()), ("value", pa.string()), ("topic", pa.string()), ("partition", pa.int32()),
                            ("offset", pa.int64()), ("timestamp", pa.timestamp("us", tz="UTC"))])
        with system.open_input_file(path) as f:
            for batch in pq.ParquetFile(f).iter_batches():
                columns = []
                for field in target:
                    column = batch.column(batch.schema.get_field_index(field.name))
                    if pa.types.is_timestamp(column.type) and column.type.tz is None:
                        column = column.cast(pa.timestamp("us")).cast(field.type)
                    columns.append(column.cast(field.type))
                yield pa.RecordBatch.from_arrays(columns, schema=target)

    def commit(self, end: dict) -> None:
        pass


class TopicLog(DataSource):
    """``spark.readStream.format("ordertide-topic").option("path", root).option("topic", name)``."""

    @classmethod
    def name(cls) -> str:
        return "ordertide-topic"

    def schema(self) -> StructType:
        return S.ENVELOPE

    def streamReader(self, schema: StructType) -> TopicLogReader:
        limit = self.options.get("batchesPerTrigger")
        return TopicLogReader(self.options["path"], self.options["topic"], int(limit) if limit else None)
