"""Visibility of batches by one file each.

Data is written first, below a folder that names batch and attempt. The batch is there
once an empty file of that name is among the commits: making an empty file is one step
in every file system and object store, so nobody sees a part and nothing is renamed. An
attempt that ends early leaves data that nobody reads. If two attempts of a batch were
committed, readers take the first by name; both hold the same rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, root: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return path, path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def commit_folder(root: str, kind: str) -> str:
    return f"{root.rstrip('/')}/_commits/{kind}"


def parse(names: list[str]) -> dict[str, str]:
    """Batch -> attempt, in order of names, from names of commits."""
    found: dict[str, str] = {}
    for name in sorted(names):
        batch, _, attempt = name.rpartition(".")
        if batch and not batch.startswith("."):
            found.setdefault(batch, attempt)
    return found


def data_folder(root: str, kind: str, batch: str, attempt: str) -> str:
    return f"{root.rstrip('/')}/{kind}/batch={batch}.{attempt}"


def number(batch: int) -> str:
    """A batch's number as a name that sorts by it."""
    return f"{batch:012d}"


def commit(spark: SparkSession, root: str, kind: str, batch: str, attempt: str) -> None:
    path, fs = _fs(spark, root)
    fs.create(path(f"{commit_folder(root, kind)}/{batch}.{attempt}"), False).close()


def committed(spark: SparkSession, root: str, kind: str) -> dict[str, str]:
    """Batch -> attempt. The names only; a batch that isn't here isn't visible."""
    path, fs = _fs(spark, root)
    folder = path(commit_folder(root, kind))
    return parse([f.getPath().getName() for f in fs.listStatus(folder)]) if fs.exists(folder) else {}


def delete_batch(spark: SparkSession, root: str, kind: str, batch: str, attempt: str) -> None:
    """Takes a batch out: its commit first, then its data."""
    path, fs = _fs(spark, root)
    fs.delete(path(f"{commit_folder(root, kind)}/{batch}.{attempt}"), False)
    fs.delete(path(data_folder(root, kind, batch, attempt)), True)


def write_once(spark: SparkSession, root: str, kind: str, batch: str, write: Callable[[str], None]) -> bool:
    """``write`` gets a folder of its own; what it put there is visible when it is done. A
    batch that is there already isn't written again (False). If it fails, what it wrote is
    taken away; what a lost driver leaves is never read."""
    if batch in committed(spark, root, kind):
        return False
    attempt = uuid.uuid4().hex
    try:
        write(data_folder(root, kind, batch, attempt))
        commit(spark, root, kind, batch, attempt)
    except Exception:
        delete_batch(spark, root, kind, batch, attempt)
        raise
    return True
