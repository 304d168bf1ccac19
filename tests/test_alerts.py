"""Alerts: none lost, none twice, stations at their own pace, state that goes."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from saltmarsh.streaming import alerts, feeds

START = datetime(2024, 5, 1)
SCHEMA = "site string, id int, at timestamp, value double"


def at(hours, site="a", number=1, value=50.0):
    return (site, number, START + timedelta(hours=hours), value)


class Feed:
    def __init__(self, spark, tmp_path, lateness="7 days"):
        self.spark, self.tmp, self.lateness = spark, tmp_path, lateness
        self.out, self.sent = str(tmp_path / "out"), []

    def run(self, *rows):
        """One more file, and what it starts."""
        self.spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(str(self.tmp / "in"))
        stream = self.spark.readStream.schema(SCHEMA).parquet(str(self.tmp / "in"))
        new = alerts.new_alerts(stream, F.col("value") >= 30, ["site"], "at", "id", self.lateness)
        self.sent.clear()
        notify = lambda df: self.sent.extend((r["site"], r["id"], int((r["at"] - START).total_seconds() // 3600)) for r in df.collect())
        feeds.run_to_end(new, "append", alerts.publisher(self.out, notify), str(self.tmp / "offsets"))
        return sorted(self.sent, key=str)


def test_two_alerts_of_one_time_in_two_batches(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    assert feed.run(at(1, number=1), at(1, number=9, value=3.0)) == [("a", 1, 1)]
    assert feed.run(at(1, number=2)) == [("a", 2, 1)]
    assert feed.run(at(1, number=1), at(1, number=2), at(1, number=3)) == [("a", 3, 1)]
    assert feed.run(at(0, number=4), at(2, number=1), at(2, number=1)) == [("a", 1, 2)]
    assert feed.run(at(2, number=1), (None, 1, START, 99.0), ("b", 1, None, 99.0)) == [(None, 1, 0)]
    assert spark.read.parquet(feed.out).count() == 5


def test_stations_have_marks_of_their_own(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    assert feed.run(at(30, "a"), at(31, "a", 2)) == [("a", 1, 30), ("a", 2, 31)]
    assert feed.run(at(5, "b"), at(29, "a", 3)) == [("b", 1, 5)]  # late, but b's first


def test_a_batch_that_runs_again_adds_nothing(spark, tmp_path):
    write = alerts.publisher(str(tmp_path / "out"))
    df = spark.createDataFrame([at(1), at(2)], SCHEMA)
    write(df, 0)
    write(df, 0)
    write(spark.createDataFrame([at(3)], SCHEMA), 1)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_state_of_quiet_stations_goes(spark, tmp_path):
    feed = Feed(spark, tmp_path, "1 hour")
    feed.run(at(0, "quiet"), at(0, "busy"))
    feed.run(at(100, "busy"))
    feed.run(at(101, "busy"))  # the watermark has passed the quiet station's mark
    state = spark.read.format("statestore").option("stateVarName", "mark").load(str(tmp_path / "offsets"))
    assert {r["key"]["site"] for r in state.collect()} == {"busy"}
    assert feed.run(at(0, "quiet")) == []  # too late


def test_one_mark_for_all(spark, tmp_path):
    """Without state but the published rows: the same two batches."""
    out = str(tmp_path / "alerts")
    run = alerts.alert_batches(spark.createDataFrame([], SCHEMA), F.col("value") >= 30, "at", out)
    first, second = spark.createDataFrame([at(1, number=1)], SCHEMA), spark.createDataFrame([at(1, number=2)], SCHEMA)
    for batch, expected in ((first, 1), (second, 2), (second, 2), (first, 2), (spark.createDataFrame([at(0, number=7)], SCHEMA), 2)):
        run(batch, 0)
        assert spark.read.parquet(out).count() == expected
