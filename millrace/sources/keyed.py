"""A sink of one file for each key: executors write them, a key that comes again replaces itself, and no other file is touched."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from millrace.session import ship_package


class KeyedFiles(DataSource):
    """Columns key (a path below the option ``path``) and body (text). Rows of one key must be one row: two tasks would race for the file."""

    @classmethod
    def name(cls) -> str:
        return "keyed_files"

    def schema(self) -> str:
        return "key string, body string"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"])


def file_system(path: str):
    """The file system that a path is on, and the path there."""
    from pyarrow import fs

    path = path.rstrip("/")
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else os.path.abspath(path))


def _store(system, base: str, key: str, body: str | None) -> None:
    folder, name = f"{base}/{key}".rsplit("/", 1)
    system.create_dir(folder, recursive=True)
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"  # hidden from readers until it is whole; a task that is run again starts afresh
    with system.open_output_stream(draft) as out:
        out.write((body or "").encode())
    system.move(draft, f"{folder}/{name}")


class _Writer(DataSourceWriter):
    def __init__(self, root: str):
        self.root = root

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        system, base = file_system(self.root)
        for row in iterator:
            _store(system, base, row["key"], row["body"])
        return WriterCommitMessage()


def try_write(rows: DataFrame, root: str) -> DataFrame:
    """key and fault (null if stored) of every row (key, body), one a key; a row that can't be stored doesn't fail the others. Rows
    are stored whenever the answer is evaluated, so write it down once."""
    ship_package(rows.sparkSession)

    def each(frames):
        for frame in frames:
            faults = []
            for key, body in zip(frame["key"], frame["body"]):
                try:
                    _store(*file_system(root), key, body)
                    faults.append(None)
                except OSError as e:
                    faults.append(str(e)[:500])
            yield frame[["key"]].assign(fault=faults)

    return rows.select("key", "body").mapInPandas(each, "key string, fault string")


def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        from pyarrow import fs

        at = self.root if "://" in self.root or self.root.startswith("file:") else os.path.abspath(self.root)
        system, base = fs.FileSystem.from_uri(at)
        for row in iterator:
            path = f"{base}/{row['key']}"
            folder, name = path.rsplit("/", 1)
            system.create_dir(folder, recursive=True)
            draft = f"{folder}/.{name}.{uuid.uuid4().hex}"  # hidden from readers until it is whole; a task that is run again starts afresh
            with system.open_output_stream(draft) as out:
                out.write((row["body"] or "").encode())
            system.move(draft, path)
        return WriterCommitMessage()


def write(rows: DataFrame, root: str) -> None:
    """Write rows (key, body), one a key, as files below ``root``."""
    spark = rows.sparkSession
    ship_package(spark)
    spark.dataSource.register(KeyedFiles)
    rows.select("key", "body").write.format("keyed_files").mode("append").option("path", root).save()
