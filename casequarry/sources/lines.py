"""JSON lines that many tasks write and one step replaces.

A table is a folder: each write is a folder of parts of its own, and the file CURRENT names the one that counts.  Tasks
write parts, the driver's commit moves CURRENT to its place, and an aborted write leaves only parts that no reader looks at.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

NAME = "casequarry_lines"


@dataclass
class _Part(WriterCommitMessage):
    path: str
    rows: int


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def current(path: str) -> str | None:
    """The folder of the last committed write."""
    store, base = _store(path)
    if store.get_file_info(f"{base}/CURRENT").type == pafs.FileType.NotFound:
        return None
    with store.open_input_stream(f"{base}/CURRENT") as f:
        return f"{base}/{json.loads(f.read())['folder']}"


class _Writer(DataSourceWriter):
    def __init__(self, path: str):
        self.path, self.folder = path, f"v-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        store, base = _store(self.path)
        store.create_dir(f"{base}/{self.folder}", recursive=True)
        part, n = f"{base}/{self.folder}/part-{uuid.uuid4().hex}.jsonl", 0
        with store.open_output_stream(part) as out:
            for row in iterator:
                out.write((json.dumps(row.asDict(recursive=True), default=str, ensure_ascii=False) + "\n").encode())
                n += 1
        return _Part(part, n)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, base = _store(self.path)
        store.create_dir(f"{base}/{self.folder}", recursive=True)
        done = {m.path for m in messages if m}
        for info in store.get_file_info(pafs.FileSelector(f"{base}/{self.folder}")):
            if info.path not in done:  # of an attempt that did not count
                store.delete_file(info.path)
        beside = f"{base}/CURRENT.{self.folder}"
        with store.open_output_stream(beside) as out:
            out.write(json.dumps({"folder": self.folder, "rows": sum(m.rows for m in messages if m)}).encode())
        before = current(self.path)
        store.move(beside, f"{base}/CURRENT")
        if before and before != f"{base}/{self.folder}":
            store.delete_dir(before)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, base = _store(self.path)
        if store.get_file_info(f"{base}/{self.folder}").type != pafs.FileType.NotFound:
            store.delete_dir(f"{base}/{self.folder}")


class Lines(DataSource):
    """Option: path, a folder that driver and executors share."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"])


def replace(rows: DataFrame, path: str) -> None:
    """Replace the table at ``path`` by ``rows`` in one step."""
    rows.sparkSession.dataSource.register(Lines)
    rows.write.format(NAME).mode("append").option("path", path).save()


def read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of the last committed write; none if there was none."""
    folder = current(path)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(folder) if folder else spark.createDataFrame([], schema)
