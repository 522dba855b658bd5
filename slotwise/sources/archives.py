"""Files and members of archives as a data source: the members are the partitions, rows come from a running decompressor.

`spark.read.format("members")` lists the files below a path and the members of ZIP archives among them, and deals them
to partitions of about TARGET bytes, a larger member being one of its own. A task opens a member through `pyarrow.fs`
(local paths, HDFS and object stores), never its archive as a whole, and yields batches of rows while it decompresses;
so what a task holds depends neither on the member's size nor on the archive's. Members are filtered by name before they
are opened; names that leave the archive's folder are left out. Bytes that are no UTF-8 become U+FFFD.

Options: pattern (of names, members' or files'), kind, roots, words, within, batch, target, most. Kinds and their rows:

- rows: path, member, pos, row (a map of strings) of CSV, JSON and JSON lines, by each name's suffix, of archives in
  archives too; a JSON text gives the objects of its list, or of the list under the first of `roots` that it has, or is
  one object itself; values that are no strings are JSON;
- content: path, member, content of whole members, which is for small ones: one of more than `most` bytes is an error;
- sheets: path, member, pos, row of the sheets of XLSX workbooks, below the first of `within` rows that has all `words`.
"""

from __future__ import annotations

import csv
import io
import json
import re
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from xml.etree import ElementTree

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Rows of a batch; bytes that a partition of several members holds; the largest content of one row.
BATCH, TARGET, MOST = 5_000, 64 << 20, 1 << 30
UNSAFE = re.compile(r"(^[/\\])|(^|[/\\])\.\.([/\\]|$)")
SHEET = r"xl/worksheets/[^/]+\.xml$"
_MAP = pa.map_(pa.string(), pa.string())
_SCHEMAS = {"rows": "path string, member string, pos long, row map<string,string>", "content": "path string, member string, content binary", "sheets": "path string, member string, pos long, row map<string,string>"}


def filesystem(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system and the path of an address that Spark has."""
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri).replace("s3a://", "s3://", 1))


def is_archive(name: str) -> bool:
    return name.lower().endswith((".zip", ".xlsx"))


# ---------------------------------------------------------------- JSON in pieces


class JsonText:
    """Reads the values of a JSON text one after another, holding one at a time."""

    def __init__(self, stream: io.TextIOBase, size: int = 1 << 16):
        self.stream, self.size, self.held, self.at, self.decoder = stream, size, "", 0, json.JSONDecoder()

    def more(self, n: int) -> bool:
        new = self.stream.read(n)
        self.held, self.at = self.held[self.at :] + new, 0
        return bool(new)

    def peek(self) -> str:
        """The next character that isn't blank; empty at the end."""
        while True:
            while self.at < len(self.held):
                if not self.held[self.at].isspace():
                    return self.held[self.at]
                self.at += 1
            if not self.more(self.size):
                return ""

    def take(self, sign: str) -> None:
        if self.peek() != sign:
            raise ValueError(f"{sign} expected in a JSON text")
        self.at += 1

    def value(self) -> object:
        self.peek()
        size = self.size
        while True:
            try:
                found, end = self.decoder.raw_decode(self.held, self.at)
                # a number may go on
                if end < len(self.held) and self.held[end] not in "0123456789.eE+-":
                    self.at = end
                    return found
                length = end - self.at
                if not self.more(size):
                    self.at = length
                    return found
                continue
            except json.JSONDecodeError:
                if not self.more(size):
                    raise
            size *= 2  # a long value is begun again few times

    def items(self) -> Iterator[object]:
        """The values of the list that comes next."""
        self.take("[")
        while self.peek() != "]":
            yield self.value()
            if self.peek() != "]":
                self.take(",")
        self.at += 1

    def keys(self) -> Iterator[str]:
        """The keys of the object that comes next; the caller takes each value."""
        self.take("{")
        while self.peek() != "}":
            yield self.value()
            if self.peek() != "}":
                self.take(",")
        self.at += 1


def json_objects(opened, roots: Sequence[str]) -> Iterator[dict]:
    """The objects of a JSON text: opened() gives it as a stream, and again if its list isn't under the first root."""
    text = JsonText(opened())
    if text.peek() == "[":
        yield from (x for x in text.items() if isinstance(x, dict))
        return
    there = set()
    for key in text.keys():
        text.take(":")
        if key in roots and text.peek() == "[":
            if key == roots[0]:
                yield from (x for x in text.items() if isinstance(x, dict))
                return
            there.add(key)
            for _ in text.items():
                pass
        else:
            text.value()
    wanted, text = next((r for r in roots if r in there), None), JsonText(opened())
    if wanted is None:
        yield text.value()
        return
    for key in text.keys():
        text.take(":")
        if key == wanted and text.peek() == "[":
            yield from (x for x in text.items() if isinstance(x, dict))
            return
        text.value()


# ---------------------------------------------------------------- rows of a member


def _text(stream) -> io.TextIOWrapper:
    return io.TextIOWrapper(stream, "utf-8-sig", errors="replace", newline="")


def _strings(row: dict) -> list[tuple[str, str | None]]:
    return [(str(k), v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False)) for k, v in row.items() if k is not None]


def rows_of(name: str, opened, roots: Sequence[str]) -> Iterator[list[tuple[str, str | None]]]:
    """The rows of a file or member by its suffix; opened() gives its bytes as a stream."""
    kind = name.lower()
    if kind.endswith(".zip"):
        with zipfile.ZipFile(opened()) as z:
            for m in z.infolist():
                if not UNSAFE.search(m.filename) and not m.is_dir():
                    yield from rows_of(m.filename, lambda m=m: z.open(m), roots)
    elif kind.endswith(".csv"):
        yield from map(_strings, csv.DictReader(_text(opened())))
    elif kind.endswith((".jsonl", ".ndjson")):
        yield from (_strings(x) for line in _text(opened()) if line.strip() and isinstance(x := json.loads(line), dict))
    elif kind.endswith(".json"):
        yield from map(_strings, json_objects(lambda: _text(opened()), roots))


_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def _ended(stream, name: str) -> Iterator[ElementTree.Element]:
    """The elements of a name as they end; what came before is dropped."""
    path = []
    for event, e in ElementTree.iterparse(stream, events=("start", "end")):
        if event == "start":
            path.append(e)
            continue
        path.pop()
        if e.tag == _NS + name:
            yield e
            if path:
                path[-1].remove(e)


def sheet_rows(z: zipfile.ZipFile, member: str, words: Sequence[str], within: int) -> Iterator[list[tuple[str, str]]]:
    """The rows of a sheet below its header."""
    shared: list[str] = []
    if "xl/sharedStrings.xml" in z.namelist():
        with z.open("xl/sharedStrings.xml") as stream:
            shared = ["".join(t.text or "" for t in si.iter(_NS + "t")) for si in _ended(stream, "si")]
    wanted, names, seen = {w.strip().lower() for w in words}, None, 0
    with z.open(member) as stream:
        for row in _ended(stream, "row"):
            cells: dict[int, str] = {}
            for c in row.findall(_NS + "c"):
                at = 0
                for x in re.match("[A-Z]+", c.get("r", "A"))[0]:
                    at = at * 26 + ord(x) - 64
                value = c.find(_NS + "v")
                text = "".join(t.text or "" for t in c.iter(_NS + "t")) if c.get("t") == "inlineStr" else (value.text or "" if value is not None else "")
                cells[at - 1] = shared[int(text)] if c.get("t") == "s" and text else text
            found = [cells.get(i, "") for i in range(max(cells, default=-1) + 1)]
            if names is not None:
                if any(x.strip() for x in found):
                    yield [(k, found[i] if i < len(found) else "") for i, k in enumerate(names) if k]
            elif wanted <= {x.strip().lower() for x in found}:
                names = [x.strip() for x in found]
            elif (seen := seen + 1) >= within:
                return


# ---------------------------------------------------------------- the data source


@dataclass
class Part(InputPartition):
    """Members (name and bytes; the name is empty for the file itself) of one file."""

    path: str
    members: list[tuple[str, int]]


def dealt(path: str, members: Sequence[tuple[str, int]], target: int) -> Iterator[Part]:
    """Consecutive members of at most `target` bytes together, one at least."""
    held, total = [], 0
    for m in members:
        if held and total + m[1] > target:
            yield Part(path, held)
            held, total = [], 0
        held.append(m)
        total += m[1]
    if held:
        yield Part(path, held)


class Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.kind = options["path"], options.get("kind", "rows")
        self.pattern, self.roots = options.get("pattern", ""), json.loads(options.get("roots", '["data", "results", "documents"]'))
        self.words, self.within = json.loads(options.get("words", "[]")), int(options.get("within", 30))
        self.batch, self.target, self.most = (int(options.get(k, v)) for k, v in (("batch", BATCH), ("target", TARGET), ("most", MOST)))

    def members(self, fs: pyarrow.fs.FileSystem, path: str, size: int) -> list[tuple[str, int]]:
        """The wanted members of an archive, from its directory alone; of another file itself."""
        wanted = re.compile(self.pattern)
        if not is_archive(path):
            return [("", size)] if self.kind == "rows" and wanted.search(path.rpartition("/")[2]) else []
        with fs.open_input_file(path) as f, zipfile.ZipFile(f) as z:
            return [(m.filename, m.file_size) for m in z.infolist() if not m.is_dir() and not UNSAFE.search(m.filename) and wanted.search(m.filename)]

    def partitions(self) -> Sequence[Part]:
        fs, path = filesystem(self.path)
        found = [fs.get_file_info(path)]
        if found[0].type == pyarrow.fs.FileType.Directory:
            found = [x for x in fs.get_file_info(pyarrow.fs.FileSelector(path, recursive=True)) if x.type == pyarrow.fs.FileType.File and not x.base_name.startswith(("_", "."))]
        elif found[0].type != pyarrow.fs.FileType.File:
            raise FileNotFoundError(self.path)
        found.sort(key=lambda x: x.path)
        return [p for x in found for p in dealt(x.path, self.members(fs, x.path, x.size), self.target)]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(self.path)
        with fs.open_input_file(partition.path) as f:
            if not is_archive(partition.path):
                yield from self.batches(partition.path, "", rows_of(partition.path, lambda: fs.open_input_stream(partition.path), self.roots))
                return
            with zipfile.ZipFile(f) as z:
                for name, size in partition.members:
                    if self.kind == "content":
                        if size > self.most:
                            raise ValueError(f"{name} of {partition.path} has {size} bytes, more than {self.most}")
                        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((partition.path, pa.string()), (name, pa.string()), (z.read(name), pa.binary()))], ["path", "member", "content"])
                    else:
                        rows = sheet_rows(z, name, self.words, self.within) if self.kind == "sheets" else rows_of(name, lambda name=name: z.open(name), self.roots)
                        yield from self.batches(partition.path, name, rows)

    def batches(self, path: str, member: str, rows: Iterator[list]) -> Iterator[pa.RecordBatch]:
        held, start = [], 0
        for row in rows:
            held.append(row)
            if len(held) == self.batch:
                yield self.made(path, member, start, held)
                start += len(held)
                held = []
        if held:
            yield self.made(path, member, start, held)

    def made(self, path: str, member: str, start: int, rows: list) -> pa.RecordBatch:
        n = len(rows)
        return pa.RecordBatch.from_arrays([pa.array([path] * n, pa.string()), pa.array([member] * n, pa.string()), pa.array(range(start, start + n), pa.int64()), pa.array(rows, _MAP)], ["path", "member", "pos", "row"])


class Members(DataSource):
    @classmethod
    def name(cls) -> str:
        return "members"

    def schema(self) -> str:
        return _SCHEMAS[self.options.get("kind", "rows")]

    def reader(self, schema) -> Reader:
        return Reader(dict(self.options))


def members(spark: SparkSession, path: str, **options: object) -> DataFrame:
    """Rows of the data source; options as above, lists as such."""
    spark.dataSource.register(Members)
    return spark.read.format("members").options(**{k: v if isinstance(v, str) else json.dumps(v) for k, v in options.items()}).load(path)
