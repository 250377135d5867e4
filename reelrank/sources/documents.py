"""A document store as a Spark data source: named collections of JSON documents, keyed by an id.

It takes the options that connectors of document stores and search indexes take: one that
names the collection (``resource``), one that names the id field (``id``). An overwrite
replaces a collection; an append replaces the documents whose ids it brings and adds the
others. It works on any folder that the driver and all executors reach under one path, and
lets the jobs' connector paths run where no connector is at hand.

A write has two phases: tasks write files of their own, by hash of the id, and a commit of
the driver lists those of the tasks that counted. Readers see commits only, so files of
failed or repeated tasks are never read. A reader's task takes one share of the ids.

Register it with ``spark.dataSource.register(DocumentSource)``.
"""

from __future__ import annotations

import json
import os
import shutil
import time
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

FORMAT = "documents"
#: Shares of the ids, each read by one task; fixed by a collection's first write.
SHARES = 16
#: Documents that a reader hands on at once.
BATCH_DOCUMENTS = 4_096
_COMMIT, _PENDING = "commit.json", "pending-"


def _folder(options: dict) -> str:
    path = options["path"].removeprefix("file:")
    return os.path.join("/" + path.lstrip("/") if path.startswith("/") else path, options["resource"])


def _commits(folder: str) -> list[dict]:
    """The commits that count, oldest first: from the last overwrite on."""
    found = []
    for name in sorted(os.listdir(folder)) if os.path.isdir(folder) else []:
        path = os.path.join(folder, name, _COMMIT)
        if not name.startswith(_PENDING) and os.path.exists(path):
            with open(path, encoding="utf-8") as file:
                found.append(json.load(file) | {"folder": os.path.join(folder, name)})
    start = max((i for i, commit in enumerate(found) if commit["overwrite"]), default=0)
    return found[start:]


@dataclass
class _Written(WriterCommitMessage):
    files: list[tuple[int, str]]


@dataclass
class _Share(InputPartition):
    files: list[str]


class DocumentSource(DataSource):
    """See the module. Options: ``path``, ``resource``, ``id``, ``shares``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        raise ValueError("give the schema of the documents")

    def reader(self, schema: StructType) -> DocumentReader:
        return DocumentReader(schema, dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> DocumentWriter:
        return DocumentWriter(schema, dict(self.options), overwrite)


class DocumentWriter(DataSourceArrowWriter):
    def __init__(self, schema: StructType, options: dict, overwrite: bool):
        self.id, self.overwrite, self.folder = options.get("id"), overwrite, _folder(options)
        if self.id is not None and self.id not in schema.names:
            raise ValueError(f"documents have no field {self.id}")
        earlier = _commits(self.folder)
        if earlier and not overwrite:
            if earlier[0]["id"] != self.id:
                raise ValueError(f"the collection is keyed by {earlier[0]['id']}, not {self.id}")
            self.shares = earlier[0]["shares"]
        else:
            self.shares = int(options.get("shares", SHARES))
        self.pending = os.path.join(self.folder, f"{_PENDING}{uuid.uuid4().hex}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        os.makedirs(self.pending, exist_ok=True)
        part, files = uuid.uuid4().hex, {}
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    key = json.dumps(row[self.id]) if self.id else json.dumps(row, default=str)
                    share = zlib.crc32(key.encode()) % self.shares
                    if share not in files:
                        name = os.path.join(self.pending, f"{share}-{part}.jsonl")
                        files[share] = open(name, "w", encoding="utf-8")  # noqa: SIM115
                    files[share].write(json.dumps(row, default=str) + "\n")
        finally:
            for file in files.values():
                file.close()
        return _Written([(share, os.path.basename(file.name)) for share, file in files.items()])

    def commit(self, messages: list[_Written | None]) -> None:
        files = [file for message in messages if message for file in message.files]
        os.makedirs(self.pending, exist_ok=True)
        entry = {"overwrite": self.overwrite, "id": self.id, "shares": self.shares, "files": files}
        with open(os.path.join(self.pending, _COMMIT), "w", encoding="utf-8") as file:
            json.dump(entry, file)
        # The commit is seen from here on, whole.
        os.rename(self.pending, os.path.join(self.folder, f"{time.time_ns():020d}"))

    def abort(self, messages: list[_Written | None]) -> None:
        shutil.rmtree(self.pending, ignore_errors=True)


class DocumentReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.fields, self.commits = schema, _commits(_folder(options))
        self.id = self.commits[0]["id"] if self.commits else None

    def partitions(self) -> list[_Share]:
        shares: dict[int, list[str]] = {}
        for commit in self.commits:
            for share, name in commit["files"]:
                shares.setdefault(share, []).append(os.path.join(commit["folder"], name))
        return [_Share(files) for _, files in sorted(shares.items())] or [_Share([])]

    def _documents(self, files: list[str]) -> Iterator[dict]:
        for name in files:
            with open(name, encoding="utf-8") as file:
                yield from map(json.loads, file)

    def read(self, partition: _Share) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(self.fields)
        rows: list[dict] = []
        found = self._documents(partition.files)
        if self.id:  # of one id the last document counts; memory holds a share's documents
            found = {json.dumps(row[self.id]): row for row in found}.values()
        for row in found:
            rows.append({name: row.get(name) for name in self.fields.names})
            if len(rows) == BATCH_DOCUMENTS:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)
