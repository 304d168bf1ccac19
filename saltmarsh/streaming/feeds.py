"""Streams: a polled feed whose cursor is the stream's offset, late data by look-back, windowed aggregates."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from ..session import new_folder
from ..sources.stores import text_of


class ChangeFeed(DataSource):
    """Emits (cursor) each time that the text of a marker file changes; the offset is the text itself.

    Option ``path``: the marker, on any store that Arrow reaches, which a crawler updates with the feed's own "last updated" value. The checkpoint keeps
    the offset, so a failed batch is run again with the same cursor, and an unchanged marker starts none.
    """

    @classmethod
    def name(cls) -> str:
        return "change_feed"

    def schema(self) -> str:
        return "cursor string"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _ChangeReader(self.options["path"])


class _Change(InputPartition):
    def __init__(self, cursor: str) -> None:
        super().__init__(cursor)
        self.cursor = cursor


class _ChangeReader(DataSourceStreamReader):
    def __init__(self, path: str) -> None:
        self.path = path

    def initialOffset(self) -> dict:
        return {"cursor": ""}

    def latestOffset(self) -> dict:
        return {"cursor": (text_of(self.path) or "").strip()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [_Change(end["cursor"])] if end["cursor"] and end["cursor"] != start["cursor"] else []

    def read(self, partition: _Change) -> Iterator[tuple]:
        yield (partition.cursor,)


def changes(spark: SparkSession, folder: str, within: str = "30 days") -> DataFrame:
    """(cursor): each "last updated" text of a feed once, from a folder on any store in which a crawler leaves a small file
    for each poll. A text that comes again within the time named starts nothing.
    """
    marked = spark.readStream.text(folder).select(F.trim("value").alias("cursor"), F.current_timestamp().alias("at")).where("cursor <> ''")
    return marked.withWatermark("at", within).dropDuplicatesWithinWatermark(["cursor"]).select("cursor")


def late_readings(stream: DataFrame, keys: list[str], time: str, lookback: str = "2 days") -> DataFrame:
    """Each reading once, however often its file is read again within the look-back; older ones are too late."""
    return stream.withWatermark(time, lookback).dropDuplicatesWithinWatermark([*keys, time])


def windowed(stream: DataFrame, time: str, keys: list[str], aggregates: list[Column], length: str, slide: str | None = None, lateness: str = "2 days") -> DataFrame:
    """Tumbling or sliding windows; a window is final once the watermark has passed it."""
    window = F.window(time, length, slide) if slide else F.window(time, length)
    return stream.withWatermark(time, lateness).groupBy(window, *keys).agg(*aggregates)


def sessions(stream: DataFrame, time: str, keys: list[str], aggregates: list[Column], gap: str, lateness: str = "2 days") -> DataFrame:
    return stream.withWatermark(time, lateness).groupBy(F.session_window(time, gap), *keys).agg(*aggregates)


def run_to_end(stream: DataFrame, mode: str = "append", batch=None, checkpoint: str | None = None) -> DataFrame | None:
    """Drains the stream (AvailableNow) into a table and reads it back; with ``batch(df, id)``, calls that instead. With
    ``checkpoint``, goes on where the run before it ended.
    """
    spark = stream.sparkSession
    out, checkpoint = new_folder(spark, "stream"), checkpoint or new_folder(spark, "offsets")
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if batch:
        writer.foreachBatch(batch).start().awaitTermination()
        return None
    writer.format("parquet").option("path", out).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def file_stream(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A test table's files as a stream."""
    path = f"{sf_dir}/{table}.parquet"
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path.replace(".parquet", ".parque[t]"))
