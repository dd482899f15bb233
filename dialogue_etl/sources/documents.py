"""A sink of one named file a row, published all or nothing, and its reader, as a Spark data source.

Every task writes its files into a folder of its attempt and, once all are written, moves them into the job's staging
folder; what a killed or failed attempt leaves behind is never looked at. The driver publishes by exchanging the
staging folder for the old one: two renames, whatever the number of files. A job that fails removes its staging folder
and leaves the old output as it was. A task reads as many files as make up its share, however small they are.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

#: What a task reads at most, but one file at least; and what leaves it at once.
TASK_FILES, TASK_BYTES = 512, 64 << 20
BATCH_FILES, BATCH_BYTES = 64, 4 << 20


@dataclass
class _Written(WriterCommitMessage):
    files: int


def _folder(path: str) -> tuple[arrow_fs.FileSystem, str]:
    system, root = arrow_fs.FileSystem.from_uri(path)
    return system, root.rstrip("/")


def _there(system: arrow_fs.FileSystem, path: str) -> bool:
    return system.get_file_info(path).type != arrow_fs.FileType.NotFound


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path, self.job = path, uuid.uuid4().hex[:12]

    def _staging(self) -> tuple[arrow_fs.FileSystem, str, str]:
        system, root = _folder(self.path)
        return system, root, f"{posixpath.dirname(root)}/.{posixpath.basename(root)}-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        system, _, staging = self._staging()
        task = TaskContext.get()
        own = f"{staging}/attempts/{task.partitionId()}-{task.taskAttemptId()}"
        names: set[str] = set()
        made: set[str] = set()

        def ready(path: str) -> str:
            """The path, once its folder is there."""
            folder = posixpath.dirname(path)
            if folder not in made:
                system.create_dir(folder)
                made.add(folder)
            return path

        for batch in iterator:
            for name, text in zip(batch.column("name").to_pylist(), batch.column("text").to_pylist()):
                if not name or name.startswith("/") or ".." in name.split("/"):
                    raise ValueError(f"not a file name: {name!r}")
                if name in names:
                    raise ValueError(f"two documents are named {name!r}")
                names.add(name)
                with system.open_output_stream(ready(f"{own}/{name}")) as out:
                    out.write((text or "").encode())
        # All are there: they take their places. A repeated attempt moves the same names again.
        for name in names:
            system.move(f"{own}/{name}", ready(f"{staging}/files/{name}"))
        return _Written(len(names))

    def commit(self, messages: list) -> None:
        system, root, staging = self._staging()
        files, before = f"{staging}/files", f"{staging}/before"
        system.create_dir(files)
        if _there(system, root):
            system.move(root, before)
        try:
            system.move(files, root)
        except Exception:
            if _there(system, before):
                system.move(before, root)
            raise
        system.delete_dir(staging)

    def abort(self, messages: list) -> None:
        system, _, staging = self._staging()
        if _there(system, staging):
            system.delete_dir(staging)


@dataclass
class _Share(InputPartition):
    names: list[str]


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[_Share]:
        system, root = _folder(self.path)
        shares, size = [_Share([])], 0
        for info in system.get_file_info(arrow_fs.FileSelector(root, recursive=True)):
            if info.type != arrow_fs.FileType.File:
                continue
            if shares[-1].names and (len(shares[-1].names) >= TASK_FILES or size + info.size > TASK_BYTES):
                shares.append(_Share([]))
                size = 0
            shares[-1].names.append(info.path[len(root) + 1 :])
            size += info.size
        return shares

    def read(self, partition: _Share) -> Iterator[pa.RecordBatch]:
        system, root = _folder(self.path)
        names, texts, size = [], [], 0
        for name in partition.names:
            with system.open_input_stream(f"{root}/{name}") as file:
                texts.append(file.read())
            names.append(name)
            size += len(texts[-1])
            if len(names) == BATCH_FILES or size >= BATCH_BYTES:
                yield self._batch(names, texts)
                names, texts, size = [], [], 0
        if names:
            yield self._batch(names, texts)

    def _batch(self, names: list[str], texts: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.binary()).cast(pa.string())], names=["name", "text"])


class NamedFiles(DataSource):
    """Format `named_files`: rows (name, text), the option path; written in mode overwrite only."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "name string, text string"

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> _Writer:
        if not overwrite:
            raise ValueError("named_files replaces its folder: write with mode overwrite")
        return _Writer(self.options["path"])


def write_documents(texts: DataFrame, path: str, key: str, text: str = "text", suffix: str = ".md") -> None:
    """One file a row, path/<key><suffix>, its text with a line end; the folder is replaced as a whole or not at all.

    Rows of one key meet in one task, so a key that occurs twice fails the job, as do null and empty keys and keys
    that lead out of the folder. A null text is an empty one. The folder must be on a file system that the driver and
    all executors reach by the same address.
    """
    texts.sparkSession.dataSource.register(NamedFiles)
    name = F.when(F.col(key).cast("string") != "", F.concat(F.col(key).cast("string"), F.lit(suffix)))
    rows = texts.select(name.alias("name"), F.concat(F.coalesce(F.col(text), F.lit("")), F.lit("\n")).alias("text"))
    rows.repartition("name").write.format("named_files").mode("overwrite").save(path)


def read_documents(spark: SparkSession, path: str, key: str, suffix: str = ".md") -> DataFrame:
    """(key, text) of the files that write_documents() wrote, with the line end after the text.

    Spark's own readers count 4 MB for the opening of a file: small files would be read a few a task.
    """
    spark.dataSource.register(NamedFiles)
    files = spark.read.format("named_files").load(path)
    return files.select(F.substring("name", F.lit(1), F.length("name") - len(suffix)).alias(key), "text")
