"""Sources as Spark data sources: ``spark.read.format("weft_local")`` and SQL's ``using weft_local options (...)``.

A scan is planned from a listing: one partition for some whole files, or for a byte range of a file of lines. Filters
on the place of a document (path, kind, bytes) drop files before any is opened and are taken from Spark; what they
can't say stays with it. ``limit`` ends each partition after as many documents. What can't be read is a row without text that says why in ``error``,
so a broken file or a busy index never ends the scan.

``crawl_source(get)`` makes a data source of a crawl index from whatever asks for pages; a partition is a pattern, or one
of its ``splits``. Register both with ``register(spark, get)``.
"""

from __future__ import annotations

import gzip
import io
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fnmatch import fnmatchcase

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith
from pyspark.sql.types import StructType

from weft import uris
from weft.sources import remote
from weft.sources.files import KINDS, main_text, pdf_pages

#: Bytes of files that make a partition, of lines that make a batch.
SPLIT, BATCH = 64 << 20, 4 << 20
FILES = "text string, kind string, path string, bytes long, place long, error string"
PAGES = "text string, pattern string, url string, error string"
_FILES = pa.schema([("text", pa.string()), ("kind", pa.string()), ("path", pa.string()), ("bytes", pa.int64()), ("place", pa.int64()), ("error", pa.string())])
_PAGES = pa.schema([("text", pa.string()), ("pattern", pa.string()), ("url", pa.string()), ("error", pa.string())])
_COMPARE = {EqualTo: lambda x, y: x == y, GreaterThan: lambda x, y: x > y, GreaterThanOrEqual: lambda x, y: x >= y, LessThan: lambda x, y: x < y, LessThanOrEqual: lambda x, y: x <= y, In: lambda x, y: x in y, StringStartsWith: str.startswith, StringEndsWith: str.endswith, StringContains: lambda x, y: y in x}


def told(f: Filter, names: tuple[str, ...]) -> Callable[[dict], bool] | None:
    """A pushed filter as a test of a row of known values; None if it asks for anything else."""
    if isinstance(f, Not):
        inner = told(f.child, names)
        return None if inner is None else lambda row: not inner(row)
    test, column = _COMPARE.get(type(f)), ".".join(getattr(f, "attribute", ()))
    if isinstance(f, IsNotNull) and column in names:
        return lambda row: row[column] is not None
    if test is None or column not in names:
        return None
    value = f.value
    return lambda row: test(row[column], value)


@dataclass
class Span(InputPartition):
    """Whole files, or bytes of one file of lines from ``start`` to ``end``."""

    files: list[tuple[str, str, int]]
    start: int = 0
    end: int | None = None


class FilesReader(DataSourceReader):
    def __init__(self, options: dict):
        if not options.get("path"):
            raise ValueError("weft_local needs a path")
        self.path, self.field = options["path"], options.get("text_field", "text")
        self.glob, self.limit, self.split = options.get("glob", "*"), int(options.get("limit", 0)), int(options.get("split", SPLIT))
        self.tests: list[Callable[[dict], bool]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            test = told(f, ("path", "kind", "bytes"))
            if test is None:
                yield f
            else:
                self.tests.append(test)

    def partitions(self) -> list[InputPartition]:
        scheme = self.path.partition("://")[0] + "://" if "://" in self.path and not self.path.startswith("file:") else ""
        spans, held, size = [], [], 0
        for f in uris.files(self.path):
            name = f.base_name.lower()
            kind = next((k for k, ends in KINDS.items() if name.endswith(tuple(f".{e}" for e in ends))), None)
            path = scheme + f.path
            if kind is None or not fnmatchcase(f.base_name, self.glob) or not all(t({"path": path, "kind": kind, "bytes": f.size}) for t in self.tests):
                continue
            if kind == "json" and not name.endswith(".gz") and f.size > self.split:
                spans += [Span([(path, kind, f.size)], a, min(a + self.split, f.size)) for a in range(0, f.size, self.split)]
                continue
            if held and size + f.size > self.split:
                spans.append(Span(held))
                held, size = [], 0
            held.append((path, kind, f.size))
            size += f.size
        spans += [Span(held)] if held else []
        return spans

    def read(self, partition: Span | None) -> Iterator[pa.RecordBatch]:
        n, rows, held = 0, [], 0
        if partition is None:  # nothing was planned
            return
        for path, kind, size in partition.files:
            try:
                for place, text in self._documents(path, kind, partition):
                    if not text.strip():
                        continue
                    rows.append({"text": text, "kind": kind, "path": path, "bytes": size, "place": place, "error": None})
                    n, held = n + 1, held + len(text)
                    if held >= BATCH:
                        yield pa.RecordBatch.from_pylist(rows, _FILES)
                        rows, held = [], 0
                    if self.limit and n >= self.limit:
                        yield pa.RecordBatch.from_pylist(rows, _FILES)
                        return
            except Exception as why:
                rows.append({"text": None, "kind": kind, "path": path, "bytes": size, "place": None, "error": f"{type(why).__name__}: {why}"})
        yield pa.RecordBatch.from_pylist(rows, _FILES)

    def _documents(self, path: str, kind: str, span: Span) -> Iterator[tuple[int, str]]:
        fs, at = uris.filesystem(path)
        with fs.open_input_file(at) as f:
            if kind == "json":
                lines = gzip.open(f, "rb") if path.endswith(".gz") else _lines(f, span)
                for k, line in enumerate(lines):
                    if line.strip():
                        value = json.loads(line).get(self.field)
                        yield k, "" if value is None else str(value)
            elif kind == "pdf":
                yield from enumerate(pdf_pages(f.read()))
            else:
                text = f.read().decode("utf-8", "replace")
                yield 0, main_text(text) if kind == "html" else text


def _lines(f, span: Span) -> Iterator[bytes]:
    """Lines that begin in the span: a line belongs to where its first byte is."""
    end = span.end
    if span.start:
        f.seek(span.start - 1)
    reader = io.BufferedReader(f, 1 << 20)
    at = span.start
    if span.start:
        at = span.start - 1 + len(reader.readline())
    while end is None or at < end:
        line = reader.readline()
        if not line:
            return
        at += len(line)
        yield line


class LocalFiles(DataSource):
    """Documents of files: options path, and text_field, glob, limit, split (bytes of a partition)."""

    @classmethod
    def name(cls) -> str:
        return "weft_local"

    def schema(self) -> str:
        return FILES

    def reader(self, schema: StructType) -> DataSourceReader:
        return FilesReader(dict(self.options))


@dataclass
class Pattern(InputPartition):
    pattern: str
    nth: int
    of: int


def crawl_source(get: remote.Get, waits: tuple = remote.WAITS) -> type[DataSource]:
    """A data source of the pages that a crawl index knows: options url_patterns (separated by blanks), crawl, limit, splits."""

    class Pages(DataSourceReader):
        def __init__(self, options: dict):
            self.patterns, self.crawl = options.get("url_patterns", "").split(), options.get("crawl")
            self.limit, self.splits = int(options.get("limit", 100)), int(options.get("splits", 1))
            if not self.patterns:
                raise ValueError("weft_crawl needs url_patterns")
            self.tests: list = []

        def pushFilters(self, filters):
            for f in filters:
                test = told(f, ("pattern", "url"))
                if test is None or isinstance(f, IsNotNull):
                    yield f
                else:
                    # what asks for the pattern alone says which requests are made
                    self.tests.append((".".join(f.child.attribute if isinstance(f, Not) else f.attribute), test))

        def partitions(self):
            wanted = [p for p in self.patterns if all(t({"pattern": p}) for c, t in self.tests if c == "pattern")]
            return [Pattern(p, k, self.splits) for p in wanted for k in range(self.splits)]

        def read(self, partition):
            if partition is None:
                return
            crawl = self.crawl or remote.newest_crawl(get, waits)
            found = remote.index_rows(get, crawl, 0, partition.pattern, self.limit, waits)
            for r in found[partition.nth :: partition.of]:
                text, why = (None, r["error"]) if r.get("error") else (None, None)
                if not why and not all(t({"url": r["url"]}) for c, t in self.tests if c == "url"):
                    continue
                if not why:
                    text, why = remote.page_text(get, r["file"], r["offset"], r["length"], waits)
                if text or why:
                    yield pa.RecordBatch.from_pylist([{"text": text or None, "pattern": partition.pattern, "url": r.get("url"), "error": why}], _PAGES)

    class Crawl(DataSource):
        @classmethod
        def name(cls) -> str:
            return "weft_crawl"

        def schema(self) -> str:
            return PAGES

        def reader(self, schema):
            return Pages(dict(self.options))

    return Crawl


def register(spark: SparkSession, get: remote.Get | None = None, waits: tuple = remote.WAITS) -> None:
    """Makes the sources known to the session and lets Spark push filters to them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(LocalFiles)
    if get is not None:
        spark.dataSource.register(crawl_source(get, waits))
