"""A data source for JSON records that reads in parts and names the place of what it can't read."""

from __future__ import annotations

import io
import json
import re
import sys
from codecs import getincrementaldecoder
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

PART_BYTES = 64 << 20
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20
CHUNK = 1 << 20
#: The longest piece of JSON that can be cut at the end of a buffer and look wrong: an escape or a literal.
CUT = 16
PACKED = (".gz", ".bz2", ".zst", ".lz4")
_SPACE = re.compile(r"[ \t\r\n]*")
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


class BadRecord(ValueError):
    """Something that is no record, with its file and line."""


def place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it. Raises for a scheme that Arrow can't open."""
    path = re.sub(r"^s3[an]:", "s3:", path)
    if re.match(r"^[a-z][a-z0-9+.-]*:", path):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


def files(path: str) -> list[tuple[str, int]]:
    """(path, size) of a file, or of the files below a folder but hidden ones, in order."""
    system, inner = place(path)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [(inner, info.size)]
    found = system.get_file_info(fs.FileSelector(inner, recursive=True))
    shown = [f for f in found if not any(p[:1] in "._" for p in f.path[len(inner) :].strip("/").split("/"))]
    return sorted((f.path, f.size) for f in shown if f.type == fs.FileType.File)


def shaped(value: Any, kind: T.DataType) -> Any:
    """A JSON value as ``kind``: text columns take any value as JSON, missing fields are null,
    further fields are left out. Raises ValueError for a value of another kind."""
    if value is None:
        return None
    if isinstance(kind, T.StringType):
        return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False, separators=(",", ":"))
    if isinstance(kind, T.BooleanType) and isinstance(value, bool):
        return value
    if isinstance(kind, _WHOLE) and isinstance(value, int) and not isinstance(value, bool):
        return value
    if isinstance(kind, (T.DoubleType, T.FloatType)) and isinstance(value, (int, float)) and not isinstance(value, bool):
        return float(value)
    if isinstance(kind, T.ArrayType) and isinstance(value, list):
        return [shaped(v, kind.elementType) for v in value]
    if isinstance(kind, T.MapType) and isinstance(value, dict):
        return [(k, shaped(v, kind.valueType)) for k, v in value.items()]
    if isinstance(kind, T.StructType) and isinstance(value, dict):
        return {f.name: shaped(value.get(f.name), f.dataType) for f in kind}
    raise ValueError(f"{type(value).__name__} where {kind.simpleString()} is declared")


def _record(value: Any, kind: T.StructType) -> dict:
    if not isinstance(value, dict):
        raise ValueError("not an object")
    return shaped(value, kind)


class _Document:
    """A JSON text read in chunks: a value at a time is held, not the file."""

    def __init__(self, stream: Any):
        self.stream, self.decode = stream, getincrementaldecoder("utf-8-sig")().decode
        self.text, self.at, self.line, self.done = "", 0, 1, False
        self.decoder = json.JSONDecoder()

    def _more(self, size: int) -> None:
        self.line += self.text.count("\n", 0, self.at)
        data = self.stream.read(size)
        self.done = not data
        self.text, self.at = self.text[self.at :] + self.decode(data, final=self.done), 0

    def peek(self) -> str:
        """The next sign that is no white space; empty at the end."""
        while True:
            self.at = _SPACE.match(self.text, self.at).end()
            if self.at < len(self.text) or self.done:
                return self.text[self.at : self.at + 1]
            self._more(CHUNK)

    def take(self, signs: str) -> str:
        sign = self.peek()
        if not sign or sign not in signs:
            raise ValueError(f"expected one of {' '.join(signs)}")
        self.at += 1
        return sign

    def value(self) -> Any:
        self.peek()
        size = CHUNK
        while True:
            try:
                value, end = self.decoder.raw_decode(self.text, self.at)
                if end < len(self.text) or self.done:
                    self.at = end
                    return value
            except json.JSONDecodeError as wrong:
                cut = wrong.pos >= len(self.text) - CUT or wrong.msg.startswith("Unterminated string")
                if self.done or not cut:
                    raise ValueError(wrong.msg) from None
            self._more(size)
            size *= 2

    @property
    def now(self) -> int:
        return self.line + self.text.count("\n", 0, self.at)


def listed(stream: Any, path: str, kind: T.StructType) -> Iterator[tuple[dict, int]]:
    """(record, characters) of a list of records, or of the ``records`` list of an object."""
    doc = _Document(stream)

    def items() -> Iterator[tuple[dict, int]]:
        doc.take("[")
        if doc.peek() == "]":
            doc.take("]")
            return
        while True:
            doc.peek()
            line, before = doc.now, doc.at
            value = doc.value()
            try:
                yield _record(value, kind), max(doc.at - before, 1)
            except ValueError as wrong:
                raise BadRecord(f"{path}, line {line}: {wrong}") from None
            if doc.take(",]") == "]":
                return

    try:
        if doc.peek() == "[":
            yield from items()
        elif doc.peek() == "{":
            doc.take("{")
            some = False
            while doc.peek() != "}":
                name = doc.value()
                if not isinstance(name, str):
                    raise ValueError("a name must be a string")
                doc.take(":")
                if name == "records" and doc.peek() == "[":
                    some = True
                    yield from items()
                else:
                    doc.value()
                if doc.take(",}") == "}":
                    break
                if doc.peek() == "}":
                    raise ValueError("expected a name")
            else:
                doc.take("}")
            if not some:
                raise ValueError("expected a list or an object with a 'records' list")
        else:
            raise ValueError("expected a list or an object with a 'records' list")
        if doc.peek():
            raise ValueError("text after the end")
    except BadRecord:
        raise
    except ValueError as wrong:
        raise BadRecord(f"{path}, line {doc.now}: {wrong}") from None


def lines(stream: Any, start: int, end: int | None) -> Iterator[tuple[int, bytes]]:
    """(first byte, line) of the lines that begin from ``start`` on and before ``end``."""
    at = start
    if start:
        stream.seek(start - 1)
        at = start - 1 + len(stream.readline())
    while end is None or at < end:
        line = stream.readline()
        if not line:
            return
        yield at, line
        at += len(line)


@dataclass
class Part(InputPartition):
    path: str
    start: int
    end: int | None


class RecordsReader(DataSourceReader):
    """Options: ``path``, ``format`` (``jsonl`` or ``json``) and ``partbytes``. Lines are read in
    parts of ``partbytes`` bytes; a list, or a packed file, is one part, read a record at a time."""

    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.kind, self.path = schema, options["path"]
        self.fmt = options.get("format", "jsonl")
        self.size = int(options.get("partbytes", PART_BYTES))
        if self.fmt not in ("json", "jsonl"):
            raise ValueError("format must be 'json' or 'jsonl'")
        if self.size < 1:
            raise ValueError("partbytes must be positive")

    def partitions(self) -> list[Part]:
        parts = []
        for path, size in files(self.path):
            if self.fmt == "json" or path.endswith(PACKED):
                parts.append(Part(path, 0, None))
            else:
                parts += [Part(path, at, min(at + self.size, size)) for at in range(0, size, self.size)]
        return parts or [Part("", 0, 0)]

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        schema, rows, held = to_arrow_schema(self.kind), [], 0
        for row, size in self._records(part) if part.path else ():
            rows.append(row)
            held += size
            if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    def _open(self, part: Part) -> Any:
        system = place(self.path)[0]
        if part.end is None:
            return system.open_input_stream(part.path, compression="detect")
        return system.open_input_file(part.path)

    def _records(self, part: Part) -> Iterator[tuple[dict, int]]:
        with io.BufferedReader(self._open(part), CHUNK) as stream:
            if self.fmt == "json":
                yield from listed(stream, part.path, self.kind)
                return
            for at, line in lines(stream, part.start, part.end):
                try:
                    text = line.decode("utf-8" if at else "utf-8-sig").strip()
                    if text:
                        yield _record(json.loads(text), self.kind), len(line)
                except ValueError as wrong:
                    what = wrong.msg if isinstance(wrong, json.JSONDecodeError) else wrong
                    raise BadRecord(f"{part.path}, line {self._number(part, at)}: {what}") from None

    def _number(self, part: Part, at: int) -> int:
        """The number of the line that begins at a byte. Only a failing read counts the lines before it."""
        number = 1
        with self._open(part) as stream:
            while at and (data := stream.read(min(at, CHUNK))):
                number += data.count(b"\n")
                at -= len(data)
        return number


class Records(DataSource):
    """``spark.read.format("lexcorpus_records").schema(...)``."""

    @classmethod
    def name(cls) -> str:
        return "lexcorpus_records"

    def schema(self) -> T.StructType:
        raise ValueError("declare the schema of the records")

    def reader(self, schema: T.StructType) -> RecordsReader:
        return RecordsReader(schema, self.options)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
