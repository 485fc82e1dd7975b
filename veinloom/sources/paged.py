"""A data source for services that answer page by page, in batches and as a stream.

A page is a JSON text with a list of records and, but for the last, the token of the next page. Each page is a partition,
read on an executor. To plan, the driver follows the tokens, one page at a time, and keeps nothing else of them; where
tokens can be counted (option pages), it asks for nothing at all. As a stream, the offset is the number of pages read; the pages of a batch are found again by their tokens,
so one that is run again after a failure reads the same pages.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from veinloom.sources.files import read_bytes


@dataclass
class Page(InputPartition):
    token: str


class _Service:
    """url has {token} in it; records and next are the names of a page's fields; first is the first token; with pages,
    tokens are the numbers from `first` on."""

    def __init__(self, options: dict):
        self.url, self.records, self.next = options["url"], options.get("records", "records"), options.get("next", "nextPageToken")
        self.first, self.pages = options.get("first", "0"), options.get("pages")
        if "{token}" not in self.url:
            raise ValueError("the option url needs {token} in it")

    def page(self, token: str) -> dict | None:
        try:
            return json.loads(read_bytes(self.url.replace("{token}", token)))
        except FileNotFoundError:
            return None  # not there yet

    def tokens(self, start: str | None, at_most: int | None = None) -> list[str]:
        """Tokens from start on, as far as there are pages now; a page without a next token is the last."""
        if self.pages:
            return [str(int(self.first) + i) for i in range(int(self.pages))]
        out: list[str] = []
        while start is not None and (at_most is None or len(out) < at_most) and (page := self.page(start)) is not None:
            out.append(start)
            start = page.get(self.next)
            start = None if start is None else str(start)
        return out


def _converted(value, kind: T.DataType):
    if value is None:
        return None
    if isinstance(kind, T.StringType):
        return value if isinstance(value, str) else json.dumps(value)
    if isinstance(kind, T.StructType):
        return {f.name: _converted(value.get(f.name), f.dataType) for f in kind.fields}
    if isinstance(kind, T.ArrayType):
        return [_converted(x, kind.elementType) for x in value]
    if isinstance(kind, (T.LongType, T.IntegerType, T.ShortType)):
        return int(value)
    return float(value) if isinstance(kind, (T.DoubleType, T.FloatType)) else value


def _rows(service: _Service, schema: T.StructType, partition: Page | None) -> Iterator[tuple]:
    if partition is None:  # no pages at all
        return
    page = service.page(partition.token)
    if page is None:
        raise FileNotFoundError(f"page {partition.token} is gone")
    for record in page.get(service.records) or ():
        yield tuple(_converted(record.get(f.name), f.dataType) for f in schema.fields)


class _Reader(DataSourceReader):
    def __init__(self, service: _Service, schema: T.StructType):
        self.service, self.fields = service, schema

    def partitions(self) -> list[Page]:
        return [Page(t) for t in self.service.tokens(self.service.first)]

    def read(self, partition: Page) -> Iterator[tuple]:
        return _rows(self.service, self.fields, partition)


class _StreamReader(DataSourceStreamReader):
    """Offsets are {"n": pages so far, "last": the token of the last of them}."""

    def __init__(self, service: _Service, schema: T.StructType):
        self.service, self.fields = service, schema
        self.known: dict = {"n": 0, "last": None}

    def initialOffset(self) -> dict:
        return {"n": 0, "last": None}

    def _after(self, offset: dict, at_most: int | None = None) -> list[str]:
        if offset["last"] is None:
            return self.service.tokens(self.service.first, at_most)
        page = self.service.page(offset["last"])
        start = None if page is None or page.get(self.service.next) is None else str(page[self.service.next])
        return self.service.tokens(start, at_most)

    def latestOffset(self) -> dict:
        if new := self._after(self.known):
            self.known = {"n": self.known["n"] + len(new), "last": new[-1]}
        return self.known

    def partitions(self, start: dict, end: dict) -> list[Page]:
        if end["n"] > self.known["n"]:
            self.known = end  # after a restart, what has been planned before is not looked for again
        return [Page(t) for t in self._after(start, end["n"] - start["n"])]

    def read(self, partition: Page) -> Iterator[tuple]:
        return _rows(self.service, self.fields, partition)


class PagedSource(DataSource):
    """spark.read.format("paged").schema(...).option("url", "…/{token}.json").load(), and readStream alike."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(_Service(dict(self.options)), schema)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        if "pages" in self.options:
            raise ValueError("a stream follows tokens; the option pages is for batches")
        return _StreamReader(_Service(dict(self.options)), schema)


def registered(spark: SparkSession) -> SparkSession:
    spark.dataSource.register(PagedSource)
    return spark
