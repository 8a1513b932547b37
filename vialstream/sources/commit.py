"""Transactions over many tables: all of them appear at once, or none does.

Two phases.  First each table is written by a Python data source: tasks write files of their own under a staging
folder, and when all have ended the driver's ``commit`` keeps the files that the winning attempts told of, gives
them names by partition, and notes them (prepared).  A failed job calls ``abort``, which deletes what its tasks
left.  Then ``Transaction.commit`` checks that every table is prepared and renames the staging folder to the next
version.  That rename is the only point at which anything becomes visible; of two transactions that began from
one version, one finds the name taken and fails (``Conflict``).

The file system must rename folders atomically (a local or shared disk, HDFS).  Cases: a table without rows has its
schema (one empty file) or, as text, one empty file; nulls in text lines are empty lines; a transaction left open
by a lost driver leaves a staging folder that no reader sees and ``sweep`` removes.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "vialstream_files"
ENDINGS = {"parquet": "parquet", "text": "txt"}
_PREPARED = "_prepared.json"
_BLOCK = 1 << 20


class Conflict(RuntimeError):
    """Another transaction committed first."""


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    fs, path = pafs.FileSystem.from_uri(uri)
    return fs, path.rstrip("/")


@dataclass
class Written(WriterCommitMessage):
    part: int
    name: str
    rows: int
    sha256: str


def _digest(fs: pafs.FileSystem, path: str) -> str:
    h = hashlib.sha256()
    with fs.open_input_stream(path) as f:
        while block := f.read(_BLOCK):
            h.update(block)
    return h.hexdigest()


class _Files(DataSourceArrowWriter):
    def __init__(self, folder: str, kind: str, schema: pa.Schema) -> None:
        self.folder, self.kind, self.schema = folder, kind, schema

    def _fill(self, fs: pafs.FileSystem, path: str, batches: Iterator[pa.RecordBatch]) -> int:
        rows = 0
        with fs.open_output_stream(path) as out:
            if self.kind == "text":
                for b in batches:
                    out.write("".join(f"{v or ''}\n" for v in b.column(0).to_pylist()).encode())
                    rows += b.num_rows
            else:
                with pq.ParquetWriter(out, self.schema, compression="zstd") as w:
                    for b in batches:
                        w.write_table(pa.Table.from_batches([b]).cast(self.schema))
                        rows += b.num_rows
        return rows

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """One attempt of one task: a file under a name that no other attempt has."""
        fs, folder = file_system(self.folder)
        part = TaskContext.get().partitionId()
        name = f"_try-{part:05d}-{uuid.uuid4().hex}"
        rows = self._fill(fs, f"{folder}/{name}", iterator)
        return Written(part, name, rows, _digest(fs, f"{folder}/{name}"))

    def commit(self, messages: list) -> None:
        """Phase one: the table is prepared.  Empty parts are left out, other attempts' files go."""
        fs, folder = file_system(self.folder)
        files, kept = [], set()
        for m in sorted((m for m in messages if m is not None and m.rows), key=lambda m: m.part):
            name = f"part-{m.part:05d}.{ENDINGS[self.kind]}"
            fs.move(f"{folder}/{m.name}", f"{folder}/{name}")
            files.append({"name": name, "rows": m.rows, "sha256": m.sha256})
            kept.add(name)
        if not files:
            name = f"part-00000.{ENDINGS[self.kind]}"
            self._fill(fs, f"{folder}/{name}", iter(()))
            files.append({"name": name, "rows": 0, "sha256": _digest(fs, f"{folder}/{name}")})
            kept.add(name)
        for f in fs.get_file_info(pafs.FileSelector(folder)):
            if f.base_name not in kept:
                fs.delete_file(f.path)
        with fs.open_output_stream(f"{folder}/{_PREPARED}") as out:
            out.write(json.dumps({"kind": self.kind, "files": files}).encode())

    def abort(self, messages: list) -> None:
        fs, folder = file_system(self.folder)
        if fs.get_file_info(folder).type != pafs.FileType.NotFound:
            fs.delete_dir(folder)


class FileSource(DataSource):
    """The data source behind a transaction's tables."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> _Files:
        from pyspark.sql.pandas.types import to_arrow_schema

        kind = self.options["kind"]
        if kind == "text" and [f.dataType.typeName() for f in schema.fields] != ["string"]:
            raise ValueError("text files take rows of one string column")
        return _Files(self.options["path"], kind, to_arrow_schema(schema))


def versions(root: str) -> list[str]:
    """Folders of the committed versions, oldest first."""
    fs, path = file_system(root)
    found = fs.get_file_info(pafs.FileSelector(f"{path}/versions", allow_not_found=True))
    return [f"{root.rstrip('/')}/versions/{f.base_name}" for f in sorted(found, key=lambda f: f.base_name) if f.type == pafs.FileType.Directory]


def read(spark: SparkSession, root: str, table: str, every: bool = False) -> DataFrame:
    """A table of the last version, or with ``every`` the rows that all versions have added."""
    found = versions(root)
    if not found:
        raise FileNotFoundError(f"{root} has no committed version")
    paths = [f"{v}/{table}" for v in (found if every else found[-1:])]
    kind = json.loads(_bytes(f"{paths[0]}/{_PREPARED}"))["kind"]
    return spark.read.text(paths) if kind == "text" else spark.read.parquet(*paths)


def _bytes(uri: str) -> bytes:
    fs, path = file_system(uri)
    with fs.open_input_stream(path) as f:
        return f.read()


def contents(version: str) -> dict[str, list[tuple[str, int, str]]]:
    """Of each table of a version: its files with rows and digests."""
    fs, path = file_system(version)
    tables = [f for f in fs.get_file_info(pafs.FileSelector(path)) if f.type == pafs.FileType.Directory]
    return {t.base_name: [(f["name"], f["rows"], f["sha256"]) for f in json.loads(_bytes(f"{version}/{t.base_name}/{_PREPARED}"))["files"]] for t in sorted(tables, key=lambda t: t.base_name)}


def sweep(root: str) -> None:
    """Removes what transactions left open; none may be running."""
    fs, path = file_system(root)
    if fs.get_file_info(f"{path}/_staging").type != pafs.FileType.NotFound:
        fs.delete_dir(f"{path}/_staging")


class Transaction:
    """``with Transaction(spark, root) as t: t.write("a", rows_a); t.write("b", rows_b)``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        spark.dataSource.register(FileSource)
        self.root, self.tables = root.rstrip("/"), []
        self.number = len(versions(root)) + 1
        self.stage = f"{self.root}/_staging/{uuid.uuid4().hex}"
        self.fs, self.path = file_system(self.root)
        self.staged = file_system(self.stage)[1]

    def write(self, table: str, rows: DataFrame, kind: str = "parquet") -> None:
        """Phase one of one table: parts in the order of the rows' partitions."""
        if table in self.tables:
            raise ValueError(f"{table} is written already")
        self.fs.create_dir(f"{self.staged}/{table}")
        rows.write.format(FORMAT).option("kind", kind).mode("append").save(f"{self.stage}/{table}")
        self.tables.append(table)

    def commit(self) -> str:
        """Phase two: the next version, all tables or none.  Returns its folder."""
        for table in self.tables:
            if self.fs.get_file_info(f"{self.staged}/{table}/{_PREPARED}").type != pafs.FileType.File:
                raise RuntimeError(f"{table} is not prepared")
        name = f"{self.number:08d}"
        self.fs.create_dir(f"{self.path}/versions")
        target = f"{self.path}/versions/{name}"
        if self.fs.get_file_info(target).type != pafs.FileType.NotFound:
            raise Conflict(f"version {name} is there already")
        try:
            self.fs.move(self.staged, target)
        except OSError as e:
            if self.fs.get_file_info(target).type == pafs.FileType.NotFound:
                raise
            raise Conflict(f"version {name} is there already") from e
        return f"{self.root}/versions/{name}"

    def abort(self) -> None:
        if self.fs.get_file_info(self.staged).type != pafs.FileType.NotFound:
            self.fs.delete_dir(self.staged)

    def __enter__(self) -> Transaction:
        return self

    def __exit__(self, kind, error, trace) -> None:
        try:
            if kind is None:
                self.commit()
        finally:
            self.abort()
