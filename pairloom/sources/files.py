"""Files that tasks write themselves, on any file system the executors reach."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def file_system(uri: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow import fs

    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def write_jsonl_files(df: DataFrame, folder: str, name: str = "part") -> int:
    """One `name-<partition>.jsonl` per partition that has rows; nulls are written out. The number of rows.

    A file is written under the name of its attempt and then renamed, so a task that
    is run again replaces its file and a half-written one is never read.
    """
    lines = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("line"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        system, root = file_system(folder)
        final = f"{root}/{name}-{task.partitionId():05d}.jsonl"
        draft = f"{root}/_{name}-{task.partitionId():05d}-{task.taskAttemptId()}"
        n, out = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                system.create_dir(root, recursive=True)
                out = system.open_output_stream(draft)
            for line in batch.column("line").to_pylist():
                out.write(line.encode() + b"\n")
            n += batch.num_rows
        if out is not None:
            out.close()
            system.move(draft, final)
        yield pa.record_batch([pa.array([n], pa.int64())], names=["n"])

    return lines.mapInArrow(write, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
