"""Alerts: rows over a level that have not been published, batch by batch.

``new_alerts`` keeps, for each key (a station, say), the newest time it has passed on and the ids that it has at that time.
So two alerts of one time in different batches both go out, a station that reports late isn't held up by the others, and
what is read again starts nothing. ``publisher`` writes each batch to a folder of its own, so a batch that is run again
after a failure replaces what it had written.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.relational import newer_than

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Fresh(StatefulProcessor):
    """State of a key: ``mark``, the newest time passed on in microseconds, and ``ids``, those passed on at that time."""

    def __init__(self, time: str, id_column: str) -> None:
        self.time, self.id = time, id_column

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.mark = handle.getValueState("mark", "at long")
        self.ids = handle.getMapState("ids", "id string", "seen boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        mark = self.mark.get()[0] if self.mark.exists() else None
        newest, now = mark, set()
        for row in rows:
            at = _micros(row[self.time])
            if mark is not None and (at < mark or at == mark and self.ids.containsKey((str(row[self.id]),))):
                continue
            if newest is None or at > newest:
                newest, now = at, set()
            if at == newest:
                if str(row[self.id]) in now:
                    continue  # twice in this batch
                now.add(str(row[self.id]))
            yield row
        if newest is None:
            return
        if newest != mark:
            self.ids.clear()
            self.mark.update((newest,))
            for old in list(self.handle.listTimers()):
                self.handle.deleteTimer(old)
            self.handle.registerTimer(newest // 1000 + 1)
        for one in now:
            self.ids.updateValue((one,), (True,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """The watermark has passed the mark: whatever might come again is too late, so nothing need be known of it."""
        self.mark.clear()
        self.ids.clear()
        return iter(())

    def close(self) -> None:
        pass


def _micros(at: datetime) -> int:
    at = at.replace(tzinfo=UTC) if at.tzinfo is None else at
    return int((at - datetime(1970, 1, 1, tzinfo=UTC)).total_seconds()) * 1_000_000 + at.microsecond


def new_alerts(stream: DataFrame, level: Column, keys: list[str], time: str, id_column: str, lateness: str = "7 days") -> DataFrame:
    """The rows of a stream that satisfy ``level`` and have not been passed on: (columns of the stream).

    A row is new if it is later than all of its key's that were passed on, or as late as the newest and of another id. Rows
    of one batch go out together, in any order of time, each id once at the newest time. ``time`` is a timestamp (without
    one, a row is no alert); a null key is a key; rows that are ``lateness`` older than the newest of the stream are dropped,
    and with them the state of keys that have been quiet for so long. State is kept in RocksDB, outside the heap.
    """
    spark = stream.sparkSession
    spark.conf.set(_STORE, _ROCKSDB)  # the only store that takes this kind of state
    rows = stream.where(level & F.col(time).isNotNull()).withWatermark(time, lateness)
    return rows.groupBy(*keys).transformWithState(_Fresh(time, id_column), stream.schema, "append", "EventTime")


def publisher(folder: str, notify: Callable[[DataFrame], None] | None = None) -> Callable[[DataFrame, int], None]:
    """A function for foreachBatch: a batch's rows become the Parquet folder ``batch=<id>`` of ``folder``, and ``notify`` gets them
    as read back from there. Empty batches leave nothing.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        path = f"{folder}/batch={batch_id}"
        batch.write.mode("overwrite").parquet(path)
        if notify:
            notify(batch.sparkSession.read.schema(batch.schema).parquet(path))

    return run


def alert_batches(stream: DataFrame, level: Column, time: str, published: str, notify: Callable[[DataFrame], None] | None = None):
    """A function for foreachBatch with no state but what it has published: appends the batch's alerts that are newer than
    the newest one in ``published``, or as new and not there.

    ``published`` is a Parquet folder, so a restart goes on from it. One mark holds for all rows: what is older than it is not
    published any more. Where keys report at their own pace, ``new_alerts`` has a mark for each. A batch that is run again
    adds nothing. ``notify`` gets the new alerts as a DataFrame.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        alerts = batch.where(level)
        fresh = alerts
        if _exists(spark, published):
            before = spark.read.schema(batch.schema).parquet(published)
            newest = before.agg(F.max(time)).first()[0]
            # the mark is a value: a plan that read ``published`` would see what this batch writes
            mark = spark.createDataFrame([(newest,)], f"mark {batch.schema[time].dataType.simpleString()}")
            again = alerts.join(mark, F.col(time) == F.col("mark")).drop("mark").exceptAll(before.where(F.col(time) == F.lit(newest)).select(*batch.columns))
            fresh = newer_than(alerts, time, mark).unionByName(again)
        fresh = fresh.persist()
        try:
            fresh.count()  # before the folder that it is compared with gets a file
            fresh.write.mode("append").parquet(published)
            if notify:
                notify(fresh)
        finally:
            fresh.unpersist()

    return run


def _exists(spark, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
