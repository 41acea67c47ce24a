"""Files of a folder tree as rows, listed by tasks: a Python data source whose partitions are folders.

Scans leave out empty files, and a list made by the driver grows with the files.  Here the driver only learns names of
folders, level by level until there are enough of them to share the work (or no more); each task lists the tree under
one folder and hands its files on in batches.  The path may be any that ``pyarrow.fs`` opens (local, ``hdfs``, ``s3``, ``gs``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "folder string, file string, size bigint"
ENOUGH_FOLDERS = 256
BATCH = 8192


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path; ``s3a`` and a bare ``file:`` are what Spark calls them."""
    uri = path.replace("s3a://", "s3://", 1)
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def _seen(name: str) -> bool:
    """Spark does not read files and folders whose names begin like this either."""
    return not name.startswith((".", "_")) or "=" in name


class Folder(InputPartition):
    def __init__(self, path: str, whole: bool):
        self.path, self.whole = path, whole


class FolderReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Folder]:
        system, base = _opened(self.path)
        out, level = [], [base.rstrip("/") or "/"]
        while level and len(out) + len(level) < ENOUGH_FOLDERS:
            below = [i.path for folder in level for i in system.get_file_info(fs.FileSelector(folder)) if i.type == fs.FileType.Directory and _seen(i.base_name)]
            out += [Folder(folder, False) for folder in level]
            level = below
        return out + [Folder(folder, True) for folder in level]

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        system, _ = _opened(self.path)
        left, rows = [partition.path], []

        def batch() -> pa.RecordBatch:
            columns = zip(*rows)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()))], ["folder", "file", "size"])

        while left:
            folder = left.pop()
            for info in system.get_file_info(fs.FileSelector(folder)):
                if not _seen(info.base_name):
                    continue
                if info.type == fs.FileType.Directory:
                    if partition.whole:
                        left.append(info.path)
                elif info.type == fs.FileType.File:
                    rows.append((folder, info.path, info.size))
                    if len(rows) == BATCH:
                        yield batch()
                        rows = []
        if rows:
            yield batch()


class FolderFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "folder_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FolderReader:
        return FolderReader(self.options["path"])


def folder_files(spark: SparkSession, path: str) -> DataFrame:
    """(folder, file, size) of every file below ``path``, empty ones included, without hidden ones."""
    spark.dataSource.register(FolderFiles)
    return spark.read.format("folder_files").option("path", path).load()
