"""A paged feed as a Spark data source: one input partition for each page, read in parallel.

A landing folder holds page files ``page-<offset>.json`` (arrays of objects), as a crawler of the feed leaves them. The
reader asks for the count first and plans a partition for each page; a page that is missing or unreadable, or has another
number of rows than its place says, fails the query instead of leaving rows out. The folder is on any store that Arrow reaches.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition
from pyspark.sql.types import StructType

from .stores import text_of


class Page(InputPartition):
    def __init__(self, offset: int) -> None:
        super().__init__(offset)
        self.offset = offset


class PagedFeed(DataSource):
    """Options: ``path`` (folder), ``count`` (rows in all), ``limit`` (rows of a page, 1000)."""

    @classmethod
    def name(cls) -> str:
        return "paged_feed"

    def schema(self) -> str:
        return "label string, year string, week string, cases double"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(schema, dict(self.options))


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]) -> None:
        self.names = schema.fieldNames()
        self.types = {f.name: f.dataType.simpleString() for f in schema.fields}
        self.path, self.count = options["path"], int(options["count"])
        self.limit = int(options.get("limit", "1000"))
        self.equal: list[tuple[str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Equalities on top-level columns are tested here; the rest goes back to Spark."""
        for f in filters:
            if isinstance(f, EqualTo) and len(f.attribute) == 1:
                self.equal.append((f.attribute[0], f.value))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        return [Page(k) for k in range(0, self.count, self.limit)]

    def read(self, partition: Page) -> Iterator[tuple]:
        page = text_of(f"{self.path}/page-{partition.offset}.json")
        if page is None:
            raise FileNotFoundError(f"page-{partition.offset}.json is missing from {self.path}")
        rows = json.loads(page)
        expected = min(self.limit, self.count - partition.offset)
        if len(rows) != expected:
            raise ValueError(f"page-{partition.offset}.json has {len(rows)} rows, and not {expected}")
        for row in rows:
            if all(row.get(c) == v for c, v in self.equal):
                yield tuple(self._value(row.get(n), self.types[n]) for n in self.names)

    @staticmethod
    def _value(value: object, kind: str) -> object:
        if value is None or kind == "string":
            return value if value is None else str(value)
        return float(value) if kind == "double" else int(value)


def register(spark: SparkSession) -> None:
    """Makes the format known to a session, and lets its readers see filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedFeed)
