"""Writing text lines: built in, and by a writer of our own.

``spark.dataSource.register(LineSink)`` makes ``format("lines")`` writable. Each task
writes one file into a staging folder; the commit moves the files of successful tasks
into place, so retried or speculative attempts leave nothing behind.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage


def write_lines(df: DataFrame, path: str) -> None:
    """Write a single text column, replacing what the path held."""
    df.write.mode("overwrite").text(path)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme Spark resolves it to, so that tasks write where Spark reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toString()


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of an address and the path in it; a plain path is local."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


@dataclass
class Written(WriterCommitMessage):
    name: str
    rows: int


class LineWriter(DataSourceWriter):
    """``open`` (by partition), then ``write_record`` per row, then ``close``."""

    def __init__(self, options: dict, overwrite: bool):
        self.path = options["path"]
        self.overwrite = overwrite
        self.job = uuid.uuid4().hex
        fs, base = filesystem(self.path)
        if not overwrite and fs.get_file_info(base).type != pafs.FileType.NotFound:
            raise FileExistsError(f"{self.path} exists; use mode overwrite")

    @property
    def staging(self) -> str:
        return f"_staging-{self.job}"

    def open(self, partition: int, attempt: int) -> str:
        fs, base = filesystem(self.path)
        fs.create_dir(f"{base}/{self.staging}", recursive=True)
        name = f"part-{partition:05d}-{attempt}-{self.job[:8]}.txt"
        self.stream = fs.open_output_stream(f"{base}/{self.staging}/{name}")
        return name

    def write_record(self, row) -> None:
        self.stream.write(("\t".join("" if v is None else str(v) for v in row) + "\n").encode())

    def close(self) -> None:
        self.stream.close()

    def write(self, iterator: Iterator) -> Written:
        context = TaskContext.get()
        name, rows = self.open(context.partitionId(), context.taskAttemptId()), 0
        try:
            for row in iterator:
                self.write_record(row)
                rows += 1
        finally:
            self.close()
        return Written(name, rows)

    def commit(self, messages: list) -> None:
        fs, base = filesystem(self.path)
        written = [m for m in messages if m is not None]
        fs.create_dir(base, recursive=True)
        before = [f.path for f in fs.get_file_info(pafs.FileSelector(base)) if f.is_file]
        for message in written:
            if message.rows:
                fs.move(f"{base}/{self.staging}/{message.name}", f"{base}/{message.name}")
        # The old files go only when the new ones are in place.
        for old in before if self.overwrite else ():
            fs.delete_file(old)
        self._drop_staging(fs, base)
        with fs.open_output_stream(f"{base}/_SUCCESS"):
            pass

    def abort(self, messages: list) -> None:
        self._drop_staging(*filesystem(self.path))

    def _drop_staging(self, fs: pafs.FileSystem, base: str) -> None:
        folder = f"{base}/{self.staging}"
        if fs.get_file_info(folder).type == pafs.FileType.Directory:
            fs.delete_dir(folder)


class LineSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "lines"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return LineWriter(self.options, overwrite)
