"""A data source of landed payloads: spark.read.format("payloads"), a row for each file of a folder, or for each URL of a
list that a fetcher gets. Nothing is listed, opened or fetched by the driver: it knows the folders of sources alone, and
tasks list their share.

Options:

    path        folder of files, below folders source=NAME or not
    url_list    instead of it, text files of lines "source, tab, URL"
    fetcher     with url_list, "module:function" of a function from a URL to bytes (or None); it is imported in tasks
    most_bytes  payloads with more bytes are not read (10 MB by default; -1 for no limit)
    shards      tasks for each source's folder, or for a URL list (8 by default)

Columns: source, page_url, landed_at (a file's time; null for URLs), bytes, payload, drop_reason. A payload that is not
there has a reason: `too-large`, `empty`, or `failed: ...` with what the fetcher or the file system said. Conditions on
source, and on landed_at, reach the tasks where spark.sql.python.filterPushdown.enabled is set: folders and lines of other
sources, and files of other times, are not opened.
"""

from __future__ import annotations

import importlib
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

NAME = "payloads"
SCHEMA = "source string, page_url string, landed_at timestamp, bytes long, payload binary, drop_reason string"
#: As much as a producer's downloads may have.
MOST_BYTES = 10 << 20
SHARDS = 8
#: Payloads that go to Spark at a time: so many bytes, or one payload.
BATCH_BYTES = 8 << 20
ARROW = pa.schema([("source", pa.string()), ("page_url", pa.string()), ("landed_at", pa.timestamp("us", "UTC")), ("bytes", pa.int64()), ("payload", pa.binary()), ("drop_reason", pa.string())])


def opened(path: str) -> tuple[fs.FileSystem, str, str]:
    """(file system, path on it, what comes before a path in a URL)."""
    if re.match(r"^[A-Za-z][\w+.-]*:", path):
        system, inner = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
        scheme = path.split(":", 1)[0]
        return system, inner, "file:" if scheme == "file" else path[: path.rindex(inner)] if inner and inner in path else f"{scheme}://"
    return fs.LocalFileSystem(), path, "file:"


@dataclass
class Share(InputPartition):
    """What one task looks at: of a folder, or of a URL list, the names or lines of one remainder."""

    path: str
    source: str | None
    shard: int
    shards: int

    def has(self, name: str) -> bool:
        return zlib.crc32(name.encode()) % self.shards == self.shard


@dataclass
class Wanted:
    """Conditions that rows must meet: sources, and bounds of landed_at."""

    sources: set[str] | None = None
    bounds: list[tuple[str, datetime]] = field(default_factory=list)

    def source(self, name: str | None) -> bool:
        return self.sources is None or name in self.sources

    def time(self, at: datetime | None) -> bool:
        if not self.bounds:
            return True
        tests = {">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b}
        return at is not None and all(tests[how](at, bound) for how, bound in self.bounds)


class PayloadReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.url_list = options.get("path"), options.get("url_list")
        if (self.path is None) == (self.url_list is None):
            raise ValueError("either path or url_list says where payloads are")
        self.fetcher = options.get("fetcher")
        if self.url_list is not None and not self.fetcher:
            raise ValueError("a url_list needs a fetcher: module:function")
        self.most_bytes, self.shards = int(options.get("most_bytes", MOST_BYTES)), max(1, int(options.get("shards", SHARDS)))
        self.wanted = Wanted()

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        marks = {GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
        for f in filters:
            named = getattr(f, "attribute", None)
            if named == ("source",) and isinstance(f, (EqualTo, In)):
                names = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted.sources = names if self.wanted.sources is None else self.wanted.sources & names
            elif named == ("landed_at",) and type(f) in marks and isinstance(f.value, datetime):
                at = f.value if f.value.tzinfo else f.value.replace(tzinfo=timezone.utc)
                self.wanted.bounds.append((marks[type(f)], at))
            yield f  # Spark looks again: what is left out here is only never opened

    def partitions(self) -> list[Share]:
        where = self.path or self.url_list
        system, inner, _ = opened(where)
        folders = [(where, None)]
        if self.path and system.get_file_info(inner).type == fs.FileType.Directory:
            found = [x for x in system.get_file_info(fs.FileSelector(inner)) if x.type == fs.FileType.Directory and x.base_name.startswith("source=")]
            named = [(f"{where.rstrip('/')}/{x.base_name}", x.base_name.removeprefix("source=")) for x in sorted(found, key=lambda x: x.base_name)]
            folders = [x for x in named if self.wanted.source(x[1])] if named else folders if self.wanted.source(None) else []
        return [Share(path, source, k, self.shards) for path, source in folders for k in range(self.shards)] or [Share("", None, 0, 1)]

    def read(self, share: Share) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for row in self._rows(share) if share.path else ():
            rows.append(row)
            size += len(row[4] or b"") + 200
            if size >= BATCH_BYTES:
                yield self._batch(rows)
                rows, size = [], 0
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), ARROW, strict=True)], schema=ARROW)

    def _rows(self, share: Share) -> Iterator[tuple]:
        return self._fetched(share) if self.url_list else self._files(share)

    def _files(self, share: Share) -> Iterator[tuple]:
        system, inner, prefix = opened(share.path)
        one = system.get_file_info(inner)
        listed = system.get_file_info(fs.FileSelector(inner, recursive=True)) if one.type == fs.FileType.Directory else [one]
        for info in listed:
            name = info.path[len(inner) :].lstrip("/") or info.base_name
            hidden = any(x.startswith(("_", ".")) for x in name.split("/"))
            if info.type != fs.FileType.File or hidden or not share.has(name):
                continue
            at = info.mtime.astimezone(timezone.utc) if info.mtime else None
            if self.wanted.time(at):
                yield share.source, prefix + info.path, at, info.size, *self._payload(info.size, lambda path=info.path: system.open_input_stream(path).read())

    def _fetched(self, share: Share) -> Iterator[tuple]:
        module, _, name = self.fetcher.partition(":")
        fetch: Callable[[str], bytes | None] = getattr(importlib.import_module(module), name)
        system, inner, _ = opened(share.path)
        one = system.get_file_info(inner)
        files = [one] if one.type == fs.FileType.File else [x for x in system.get_file_info(fs.FileSelector(inner, recursive=True)) if x.type == fs.FileType.File and not x.base_name.startswith(("_", "."))]
        for info in files:
            with system.open_input_stream(info.path) as f:
                for line in _lines(f):
                    source, tab, url = line.partition("\t")
                    source, url = (source, url) if tab else (None, line)
                    if url and share.has(url) and self.wanted.source(source) and self.wanted.time(None):
                        data, reason = self._payload(None, lambda url=url: fetch(url))
                        yield source, url, None, None if data is None else len(data), data, reason

    def _payload(self, size: int | None, get: Callable[[], bytes | None]) -> tuple[bytes | None, str | None]:
        limit = self.most_bytes
        if size is not None and 0 <= limit < size:
            return None, "too-large"
        try:
            data = get()
        except Exception as error:  # whatever a service or a file system says
            return None, f"failed: {type(error).__name__}: {str(error)[:200]}"
        if not data:
            return None, "empty"
        return (None, "too-large") if 0 <= limit < len(data) else (data, None)


def _lines(stream, step: int = 1 << 20) -> Iterator[str]:
    """The lines of a stream, a piece at a time."""
    rest = b""
    while data := stream.read(step):
        *whole, rest = (rest + data).split(b"\n")
        yield from (x.decode("utf-8", "replace").rstrip("\r") for x in whole)
    if rest:
        yield rest.decode("utf-8", "replace").rstrip("\r")


class PayloadSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PayloadReader:
        return PayloadReader(dict(self.options))


def payloads(spark: SparkSession, **options: str | int) -> DataFrame:
    """The source's rows; it is registered with the session, and conditions are pushed down from now on."""
    spark.dataSource.register(PayloadSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format(NAME).options(**{k: str(v) for k, v in options.items() if v is not None}).load()
