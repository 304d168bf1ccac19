import json

import pytest
from pyspark.sql import functions as F

from saltmarsh.plans import stateful
from saltmarsh.plans.registry import CheckFailed, Registry
from saltmarsh.sources import html_tables, sinks
from saltmarsh.sources.paged import PagedFeed
from saltmarsh.streaming import alerts, feeds


def pages(tmp_path, n, limit=10):
    for k in range(0, n, limit):
        rows = [{"label": "Mpox" if i % 2 else "Flu", "year": "2024", "week": str(i), "cases": i / 2} for i in range(k, min(n, k + limit))]
        (tmp_path / f"page-{k}.json").write_text(json.dumps(rows))


def test_paged_feed(spark, tmp_path):
    pages(tmp_path, 35)
    spark.dataSource.register(PagedFeed)
    read = spark.read.format("paged_feed").option("path", str(tmp_path)).option("count", 35).option("limit", 10).load()
    assert read.rdd.getNumPartitions() == 4 and read.count() == 35
    assert read.where("label = 'Mpox'").count() == 17
    (tmp_path / "page-20.json").unlink()
    with pytest.raises(Exception, match="page-20"):
        read.count()


def test_change_feed(spark, tmp_path):
    spark.dataSource.register(feeds.ChangeFeed)
    marker, out, offsets = tmp_path / "marker", str(tmp_path / "out"), str(tmp_path / "offsets")

    def poll():
        stream = spark.readStream.format("change_feed").option("path", str(marker)).load()
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", offsets).trigger(availableNow=True).start().awaitTermination()
        return [r["cursor"] for r in spark.read.schema("cursor string").parquet(out).orderBy("cursor").collect()]

    marker.write_text("2024-01-01")
    assert poll() == ["2024-01-01"]
    assert poll() == ["2024-01-01"]
    marker.write_text("2024-01-02")
    assert poll() == ["2024-01-01", "2024-01-02"]


def test_alerts_are_published_once(spark, tmp_path):
    out = str(tmp_path / "alerts")
    sent = []
    batch = spark.createDataFrame([(1, 40.0), (2, 3.0), (3, 50.0)], "t int, v double")
    run = alerts.alert_batches(batch, F.col("v") >= 30, "t", out, lambda df: sent.append(df.count()))
    run(batch, 0)
    run(batch, 0)
    run(spark.createDataFrame([(4, 31.0), (2, 99.0)], "t int, v double"), 1)
    assert sent == [2, 0, 1] and sorted(r["t"] for r in spark.read.parquet(out).collect()) == [1, 3, 4]


def test_sessions_and_windows_equal_batch(spark):
    events = feeds.file_stream(spark, "/root/testdata/sf0.001", "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    grouped = feeds.sessions(events, "ts", ["user_id"], [F.count(F.lit(1)).alias("n")], "30 minutes")
    found = feeds.run_to_end(grouped)
    batch = spark.read.parquet("/root/testdata/sf0.001/events.parquet").groupBy(F.session_window(F.col("ts").cast("timestamp"), "30 minutes"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    shown = lambda df: {(r["session_window"]["start"], r["user_id"], r["n"]) for r in df.collect()}
    assert shown(found) <= shown(batch) and found.count() > 0


def test_documents_and_metadata(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", -117.0, 32.0), (2, None, None, None)], "id int, name string, longitude double, latitude double")
    sinks.document(df.select(sinks.feature(df)), str(tmp_path / "doc"), "features", "2024-01-01", type="FeatureCollection")
    (part,) = (tmp_path / "doc").glob("part-*")
    whole = json.loads(part.read_text())
    assert whole["lastUpdated"] == "2024-01-01" and len(whole["features"]) == 2
    assert {f["properties"]["id"]: f["geometry"] for f in whole["features"]}[2] is None
    assert json.loads(sinks.metadata("n", "d", source="s"))["isBasedOn"] == "s"


def test_nested_and_empty_html_tables(spark):
    page = "<table><tr><td>a<table><tr><td>in</td></tr></table></td></tr></table><table></table>"
    rows = html_tables.table_rows(spark.createDataFrame([(1, page), (2, None), (3, "no")], "id int, html string"), "html").collect()
    assert [(r["id"], r["table"], r["cells"]) for r in rows] == [(1, 0, ["a"]), (1, 1, ["in"])]


def test_registry(spark, tmp_path):
    tables = stateful.sensor_tables("/root/testdata/sf0.001")
    assert [t.name for t in tables.order(["latest"])] == ["readings", "levels", "latest"]
    assert [t.name for t in tables.order(["latest"], upstream=False)] == ["latest"]
    assert [t.name for t in tables.order(group="raw")] == ["readings"]
    done = tables.run(spark, str(tmp_path), ["daily"])
    assert {tuple(r) for r in done.collect()} == {("readings", "keys are given", True), ("readings", "is fresh", True)}
    assert (tmp_path / "daily.metadata").exists()


def test_registry_stops_on_failure(spark, tmp_path):
    tables, told = Registry(), []

    @tables.table("a")
    def a(spark):
        return spark.createDataFrame([(None,)], "x int")

    @tables.check("a", "given")
    def given(df):
        return df.agg((F.count("x") > 0).alias("passed"))

    @tables.table("b", deps=("a",), partition="day")
    def b(spark, a, day):
        return a

    with pytest.raises(CheckFailed):
        tables.run(spark, str(tmp_path), ["b"], partition="2024-01-01", on_failure=lambda n, e: told.append(n))
    assert told == ["a"]
    tables.tables["a"].checks.clear()
    for day in ("2024-01-01", "2024-01-02", "2024-01-02"):
        tables.run(spark, str(tmp_path), ["b"], partition=day)
    assert tables.read(spark, str(tmp_path), "b").count() == 2
    with pytest.raises(ValueError):
        tables.table("a")(a)
