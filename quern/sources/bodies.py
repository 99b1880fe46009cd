"""A log of raw bodies in a folder, as a data source for batches and streams.

The log's batches are subfolders numbered from 0, each written by Spark as lines of JSON; a batch counts
once its writer has committed it and all before it have been. A stream's offset is the number of batches.
Tasks read byte ranges of files.
"""

from __future__ import annotations

import io
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Bytes of a file that one task reads, unless the option ``split_bytes`` says otherwise.
SPLIT = 32 << 20
#: Bytes of lines in one Arrow batch; a longer line makes a batch by itself.
BATCH = 4 << 20


@dataclass
class Split(InputPartition):
    """The lines of a file that start in [start, end)."""

    file: str
    start: int
    end: int


def append_bodies(rows: DataFrame, folder: str, number: int) -> None:
    """Writes the log's batch of a number; the same number again replaces it, as after a failure."""
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{folder.rstrip('/')}/{number}")


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else os.path.abspath(folder))


def _complete(folder: str) -> int:
    """Batches 0, 1, ... that are committed without a gap."""
    files, root = _opened(folder)
    found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
    numbers = {int(f.base_name) for f in found if f.type == fs.FileType.Directory and f.base_name.isdigit()}
    n = 0
    while n in numbers and files.get_file_info(f"{root}/{n}/_SUCCESS").type == fs.FileType.File:
        n += 1
    return n


def _splits(folder: str, start: int, end: int, size: int) -> list[Split]:
    files, root = _opened(folder)
    out = []
    for n in range(start, end):
        for f in sorted(files.get_file_info(fs.FileSelector(f"{root}/{n}")), key=lambda f: f.base_name):
            if f.base_name.startswith("part-"):
                out += [Split(f.path, at, min(at + size, f.size)) for at in range(0, f.size, size)]
    return out


def split_lines(raw: io.BufferedReader, start: int, end: int) -> Iterator[bytes]:
    """The lines that start in [start, end)."""
    raw.seek(max(start - 1, 0))
    if start:
        raw.readline()  # the rest of a line that starts before, or only its end
    while raw.tell() < end and (line := raw.readline()):
        yield line.rstrip(b"\r\n")


def _row(line: bytes, names: list[str]) -> dict:
    try:
        value = json.loads(line)
    except ValueError:
        value = None
    return {n: value.get(n) for n in names} if isinstance(value, dict) else {n: line.decode("utf-8", "replace") if n == "body" else None for n in names}


def _read(folder: str, schema: StructType, part: Split) -> Iterator[pa.RecordBatch]:
    files, _ = _opened(folder)
    arrow, names = to_arrow_schema(schema), schema.fieldNames()
    rows, held = [], 0
    with files.open_input_file(part.file) as opened:
        for line in split_lines(io.BufferedReader(opened, 1 << 20), part.start, part.end):
            if rows and held + len(line) > BATCH:
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                rows, held = [], 0
            rows.append(_row(line, names))
            held += len(line)
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)


class _Log:
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.folder, self.size = schema, options["path"], int(options.get("split_bytes", SPLIT))


class BodyReader(_Log, DataSourceReader):
    def partitions(self) -> list[Split]:
        # one empty range where there is nothing: a reader must have a partition
        return _splits(self.folder, 0, _complete(self.folder), self.size) or [Split("", 0, 0)]

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        return _read(self.folder, self.schema, partition) if partition.file else iter(())


class BodyStream(_Log, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"batches": 0}

    def latestOffset(self) -> dict:
        return {"batches": _complete(self.folder)}

    def partitions(self, start: dict, end: dict) -> list[Split]:
        return _splits(self.folder, start["batches"], end["batches"], self.size)

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        return _read(self.folder, self.schema, partition)


class RawBodies(DataSource):
    """``spark.read.format("raw_bodies").load(folder)``, and ``readStream`` alike.

    Columns are address and body unless ``schema`` names others (strings, numbers, booleans) of the lines'
    fields. Absent fields are null; a line that is no JSON object is a row with the line as its body.
    """

    @classmethod
    def name(cls) -> str:
        return "raw_bodies"

    def schema(self) -> str:
        return "address string, body string"

    def reader(self, schema: StructType) -> BodyReader:
        return BodyReader(schema, self.options)

    def streamReader(self, schema: StructType) -> BodyStream:
        return BodyStream(schema, self.options)
