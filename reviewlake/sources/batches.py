"""A data source for folders of JSON documents in batches: filters and limits choose files, a write appears whole or not at all.

A file holds the documents of one batch, a line each. A task lists its files in a list of its own; the commit names the
lists in one file. Only what is named exists for readers, so files of failed or repeated tasks are never read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    Filter,
    In,
    InputPartition,
    StringContains,
    StringStartsWith,
    WriterCommitMessage,
)

from reviewlake.operators.placement import ship_package
from reviewlake.sources.documents import PRODUCT_DOC
from reviewlake.sources.sinks import DOCUMENT_BATCH

FORMAT = "document_batches"
LISTS = "_lists.json"
#: Documents read by one task, and the size of an Arrow batch.
TASK_DOCUMENTS, ARROW_BYTES = 3_000, 4 << 20


def _store(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def _read_json(store: fs.FileSystem, path: str):
    with store.open_input_stream(path) as stream:
        return json.loads(stream.read())


def _write_json(store: fs.FileSystem, path: str, value) -> None:
    with store.open_output_stream(path) as stream:
        stream.write(json.dumps(value).encode())


def _lists(store: fs.FileSystem, folder: str) -> list[str]:
    known = store.get_file_info(f"{folder}/{LISTS}").type == fs.FileType.File
    return _read_json(store, f"{folder}/{LISTS}") if known else []


@dataclass
class _Files(InputPartition):
    names: list[str]


@dataclass
class _Listed(WriterCommitMessage):
    name: str


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.limit = options["path"], int(options.get("limit", -1))
        self.names: list[set[str]] = []
        self.prefixes: list[str] = []
        self.needles: list[str] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes over conditions on ``file`` and texts that ``value`` has to contain; Spark applies the rest."""
        for one in filters:
            if isinstance(one, EqualTo) and one.attribute == ("file",):
                self.names.append({one.value})
            elif isinstance(one, In) and one.attribute == ("file",):
                self.names.append(set(one.value))
            elif isinstance(one, StringStartsWith) and one.attribute == ("file",):
                self.prefixes.append(one.value)
            elif isinstance(one, StringContains) and one.attribute == ("value",):
                self.needles.append(one.value)
            else:
                yield one

    def partitions(self) -> list[_Files]:
        """Files that may hold rows, as many as the limit needs, in groups of about ``TASK_DOCUMENTS``."""
        store, folder = _store(self.path)
        groups, size, total = [_Files([])], 0, 0
        for listed in _lists(store, folder):
            if 0 <= self.limit <= total and not self.needles:
                break
            for name, count in _read_json(store, f"{folder}/{listed}"):
                if any(name not in wanted for wanted in self.names) or not all(map(name.startswith, self.prefixes)):
                    continue
                if 0 <= self.limit <= total and not self.needles:
                    break
                if size >= TASK_DOCUMENTS:
                    groups.append(_Files([]))
                    size = 0
                groups[-1].names.append(name)
                size, total = size + count, total + count
        return groups

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        store, folder = _store(self.path)
        needles = [needle.encode() for needle in self.needles]
        for name in partition.names:
            kept, held = [], 0
            with store.open_input_stream(f"{folder}/{name}") as stream:
                lines = stream.read().split(b"\n")[:-1]
            for at, line in enumerate(lines):
                if all(needle in line for needle in needles):
                    kept.append((at, line.decode()))
                    held += len(line)
                if kept and (held >= ARROW_BYTES or at == len(lines) - 1):
                    yield _record_batch(name, kept)
                    kept, held = [], 0
            if kept:
                yield _record_batch(name, kept)


def _record_batch(name: str, kept: list[tuple[int, str]]) -> pa.RecordBatch:
    position, value = zip(*kept)
    columns = [pa.array([name] * len(kept)), pa.array(position, pa.int32()), pa.array(value, pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["file", "position", "value"])


class _Writer(DataSourceWriter):
    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.size = int(options.get("batch_size", DOCUMENT_BATCH))

    def write(self, iterator: Iterator[T.Row]) -> _Listed:
        """One file per batch, then the list that names them; a task that fails before has written nothing that counts."""
        store, folder = _store(self.path)
        store.create_dir(folder, recursive=True)
        task, files, lines = uuid.uuid4().hex, [], []

        def flush() -> None:
            name = f"batch-{task}-{len(files):06d}.json"
            with store.open_output_stream(f"{folder}/{name}") as stream:
                stream.write("".join(f"{line}\n" for line in lines).encode())
            files.append((name, len(lines)))
            lines.clear()

        for row in iterator:
            lines.append(row.value)
            if len(lines) == self.size:
                flush()
        if lines:
            flush()
        _write_json(store, f"{folder}/list-{task}.json", files)
        return _Listed(f"list-{task}.json")

    def commit(self, messages: list[_Listed | None]) -> None:
        store, folder = _store(self.path)
        before = _lists(store, folder)
        fresh = sorted(m.name for m in messages if m is not None)
        _write_json(store, f"{folder}/{LISTS}", fresh if self.overwrite else before + fresh)
        if self.overwrite:
            self._remove(store, folder, before)

    def abort(self, messages: list[_Listed | None]) -> None:
        store, folder = _store(self.path)
        self._remove(store, folder, [m.name for m in messages if m is not None])

    def _remove(self, store: fs.FileSystem, folder: str, lists: list[str]) -> None:
        for listed in lists:
            for name, _ in _read_json(store, f"{folder}/{listed}"):
                store.delete_file(f"{folder}/{name}")
            store.delete_file(f"{folder}/{listed}")


class DocumentBatches(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "file string, position int, value string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(DocumentBatches)


def write_batches(df: DataFrame, path: str, batch_size: int = DOCUMENT_BATCH, append: bool = False) -> str:
    """Write rows as JSON documents, at most ``batch_size`` a file; what was there before goes unless ``append``.

    Receivers that take small uploads need so small files; ``sinks.write_documents`` suits large tables. Two writes to one
    folder at the same time are not protected from each other.
    """
    register(df.sparkSession)
    value = F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)), {"ignoreNullFields": "false"})
    writer = df.select(value.alias("value")).write.format(FORMAT).option("batch_size", batch_size)
    writer.mode("append" if append else "overwrite").save(path)
    return path


def scan_batches(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """(file, position, value): documents as text. Filters on ``file`` choose files, ``contains`` on ``value`` skips lines early.

    ``limit`` opens no more files than that many documents need. Python reads lines, Spark parses them.
    """
    register(spark)
    reader = spark.read.format(FORMAT)
    return reader.load(path) if limit is None else reader.option("limit", limit).load(path).limit(limit)


def read_batches(spark: SparkSession, path: str, schema: T.StructType | str = PRODUCT_DOC, limit: int | None = None) -> DataFrame:
    """Documents of a folder of batches with a declared schema; malformed ones have NULL fields."""
    return scan_batches(spark, path, limit).select(F.from_json("value", schema).alias("doc")).select("doc.*")
