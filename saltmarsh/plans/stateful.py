"""Queries: streams drained to their end, and a run of the table registry."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import domain
from ..operators import relational as op
from ..session import new_folder
from ..streaming import alerts, feeds
from .catalogue import query
from .checks import expect_all, expect_fresh, expect_no_nulls, expect_rows
from .registry import CheckFailed, Registry, environment, partition_key


@query("SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS cursor FROM events")
def change_feed_cursors(spark, events: DataFrame) -> DataFrame:
    """A poll's file for each event, with the feed's day of change; each day starts one update."""
    folder = new_folder(spark, "polls")
    events.select(F.date_format("ts", "yyyy-MM-dd").alias("value")).write.text(folder)
    return feeds.run_to_end(feeds.changes(spark, folder))


@query("SELECT event_id, ts, value FROM events WHERE event_type = 'error' AND value >= 30")
def stream_alerts(spark, sf_dir) -> DataFrame:
    events = feeds.file_stream(spark, sf_dir, "events").select("event_id", "ts", "value", "event_type")
    published = new_folder(spark, "alerts")
    level = (F.col("event_type") == "error") & (F.col("value") >= 30)
    feeds.run_to_end(events, batch=alerts.alert_batches(events, level, "ts", published))
    return spark.read.parquet(published).drop("event_type")


@query("""WITH a AS (SELECT user_id, event_id, ts, value FROM events WHERE event_type = 'error' AND value >= 30), w AS (SELECT *, max(ts) OVER (PARTITION BY user_id) AS newest FROM a)
SELECT user_id, event_id, ts, value, CASE WHEN event_id % 2 = 0 THEN 1 WHEN ts = newest THEN 2 ELSE 1 END AS batch FROM w""")
def keyed_alerts(spark, sf_dir) -> DataFrame:
    """Two runs of one stream: the odd ids of each user's newest time are held back in the first one and go out in the second, in
    which all rows are read again.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "event_id", "ts", "value", "event_type")
    level = (F.col("event_type") == "error") & (F.col("value") >= 30)
    newest = events.where(level).groupBy("user_id").agg(F.max("ts").alias("newest"))
    held = events.join(newest, "user_id", "left").where(~level | (F.col("ts") < F.col("newest")) | (F.col("event_id") % 2 == 0)).drop("newest")
    feed, published, offsets = new_folder(spark, "feed"), new_folder(spark, "alerts"), new_folder(spark, "offsets")
    for rows in (held, events):
        rows.write.mode("append").parquet(feed)
        stream = spark.readStream.schema(events.schema).parquet(feed)
        found = alerts.new_alerts(stream.withColumn("ts", F.col("ts").cast("timestamp")), level, ["user_id"], "ts", "event_id", "1000 days")
        feeds.run_to_end(found, "append", alerts.publisher(published), offsets)
    read = spark.read.parquet(published)
    order = read.agg(F.min("batch")).scalar()
    return read.select("user_id", "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "value", F.when(F.col("batch") == order, 1).otherwise(2).alias("batch"))


@query("SELECT DISTINCT user_id, event_type, ts FROM events")
def stream_late_readings(spark, sf_dir) -> DataFrame:
    events = feeds.file_stream(spark, sf_dir, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    found = feeds.run_to_end(feeds.late_readings(events, ["user_id", "event_type"], "ts"))
    return found.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("SELECT time_bucket(INTERVAL 6 HOUR, ts) AS start, event_type, count(*) AS n, sum(value::DECIMAL(18,2))::DOUBLE AS total FROM events GROUP BY 1, 2")
def stream_windows(spark, sf_dir) -> DataFrame:
    """Extension: tumbling windows. The last windows stay open in a stream, so they are completed by a full output."""
    events = feeds.file_stream(spark, sf_dir, "events").select("event_type", "value", F.col("ts").cast("timestamp").alias("ts"))
    sums = [F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total")]
    out = new_folder(spark, "windows")

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.select(F.col("window.start").cast("timestamp_ntz").alias("start"), "event_type", "n", "total").write.mode("overwrite").parquet(out)

    feeds.run_to_end(feeds.windowed(events, "ts", ["event_type"], sums, "6 hours"), "complete", replace)
    return spark.read.parquet(out)


def sensor_tables(sf_dir: str) -> Registry:
    """A small graph: readings, their levels, the newest of each user, daily counts."""
    tables = Registry()

    @tables.table("readings", description="Raw readings", group="raw")
    def readings(spark) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value")

    tables.expect("readings", **{"keys are given": expect_no_nulls("event_id", "ts"), "is fresh": expect_fresh("ts", datetime(2024, 2, 1), timedelta(days=3))})

    @tables.table("levels", deps=("readings",), description="Readings with their guidance level")
    def levels(spark, readings: DataFrame) -> DataFrame:
        return readings.withColumn("level", domain.threshold_level(F.col("value")))

    @tables.table("latest", deps=("levels",), description="The newest reading of each user")
    def latest(spark, levels: DataFrame) -> DataFrame:
        return op.last_per_group(levels, ["user_id"], [F.desc("ts"), F.desc("event_id")])

    @tables.table("daily", deps=("levels",), description="Readings a day and level")
    def daily(spark, levels: DataFrame) -> DataFrame:
        return levels.groupBy(F.to_date("ts").alias("day"), "level").agg(F.count("event_id").alias("n"))

    return tables


@query("""SELECT user_id, event_id, CASE WHEN value < 5 THEN 'green' WHEN value < 30 THEN 'yellow' ELSE 'orange' END AS level FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def registry_run(spark, sf_dir) -> DataFrame:
    root, tables = new_folder(spark, "tables"), sensor_tables(sf_dir)
    tables.run(spark, root, ["latest"])
    return tables.read(spark, root, "latest").select("user_id", "event_id", "level")


@query("""SELECT 'orders' AS name, 'keys' AS expectation, count(*) FILTER (WHERE o_orderkey IS NULL OR o_custkey IS NULL) = 0 AS passed FROM orders
UNION ALL SELECT 'orders', 'priced', count(*) FILTER (WHERE o_totalprice > 1000) = count(*) FROM orders UNION ALL SELECT 'orders', 'size', count(*) BETWEEN 10 AND 100000000 FROM orders
UNION ALL SELECT 'orders', 'recent', max(o_orderdate) >= DATE '2030-01-01' FROM orders""")
def observed_checks(spark, sf_dir) -> DataFrame:
    """Four checks taken by the job that writes the table, two of which may fail."""
    tables, root = Registry(), new_folder(spark, "tables")

    @tables.table("orders")
    def orders(spark) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/orders.parquet")

    day = spark.read.parquet(f"{sf_dir}/orders.parquet").schema["o_orderdate"].dataType.simpleString()
    as_of = datetime(2030, 1, 1) if day.startswith("timestamp") else date(2030, 1, 1)
    checks = {"keys": expect_no_nulls("o_orderkey", "o_custkey"), "priced": expect_all(F.col("o_totalprice") > 1000), "size": expect_rows(10, 100_000_000), "recent": expect_fresh("o_orderdate", as_of, timedelta(0))}
    tables.expect("orders", **checks)
    return tables.run(spark, root, stop=False).select(F.col("table").alias("name"), F.col("check").alias("expectation"), "passed")


@query("""SELECT o_orderdate::DATE - dayofweek(o_orderdate)::INT AS week, count(*) AS n FROM orders WHERE o_orderdate::DATE - dayofweek(o_orderdate)::INT IN (DATE '1995-03-12', DATE '1995-03-19') GROUP BY 1""")
def partition_by_schedule(spark, sf_dir) -> DataFrame:
    """A weekly table run for two scheduled times, the first one twice: each run replaces its week."""
    tables, root = Registry(), new_folder(spark, "tables")

    @tables.table("weekly", partition="week")
    def weekly(spark, week: str) -> DataFrame:
        day = F.to_date("o_orderdate")
        return spark.read.parquet(f"{sf_dir}/orders.parquet").where((day >= F.lit(week).cast("date")) & (day < F.date_add(F.lit(week).cast("date"), 7))).select("o_orderkey")

    for scheduled in (datetime(1995, 3, 16, 0, 20), datetime(1995, 3, 19), datetime(1995, 3, 18, 23, 59)):
        tables.run(spark, root, partition=partition_key(scheduled, "week"))
    return tables.read(spark, root, "weekly").groupBy(F.col("week").cast("date").alias("week")).agg(F.count("o_orderkey").alias("n"))


@query("""SELECT 'priced' AS name, count(*) FILTER (WHERE o_totalprice < 1000) > 0 AS told, false AS below_built FROM orders WHERE o_totalprice IS NOT NULL HAVING count(*) FILTER (WHERE o_totalprice < 1000) > 0
UNION ALL SELECT 'priced', false, true FROM orders HAVING count(*) FILTER (WHERE o_totalprice < 1000) = 0""")
def failure_notice(spark, sf_dir) -> DataFrame:
    """A table whose check fails if any order is cheap: who is told, and whether the table below it is built."""
    tables, root, told, built = Registry(), new_folder(spark, "tables"), [], []

    @tables.table("priced")
    def priced(spark) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/orders.parquet")

    @tables.table("below", deps=("priced",))
    def below(spark, priced: DataFrame) -> DataFrame:
        built.append("below")
        return priced

    tables.expect("priced", dear=expect_all(F.col("o_totalprice") >= 1000))
    try:
        tables.run(spark, root, on_failure=lambda name, error: told.append(name))
    except CheckFailed:
        pass
    return spark.createDataFrame([("priced", told == ["priced"], bool(built))], "name string, told boolean, below_built boolean")


@query("SELECT column_name AS variable, 'https://example.org/orders' AS based_on FROM (DESCRIBE orders)")
def table_metadata(spark, sf_dir) -> DataFrame:
    """The metadata that stands beside a table: its columns, and what it is based on."""
    tables, root = Registry(), new_folder(spark, "tables")

    @tables.table("orders", description="Orders as they are", source="https://example.org/orders")
    def orders(spark) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/orders.parquet")

    tables.run(spark, root)
    shape = "isBasedOn string, variableMeasured array<struct<name: string>>"
    about = spark.read.text(f"{root}/orders.metadata").select(F.from_json("value", shape).alias("m"))
    return about.select(F.explode("m.variableMeasured.name").alias("variable"), F.col("m.isBasedOn").alias("based_on"))


@query("SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice >= 150000 GROUP BY 1")
def environment_resources(spark, sf_dir) -> DataFrame:
    """A table that needs a limit, which the environment of the run gives."""
    settings = {"default": {"limit": 150_000, "site": "all"}, "test": {"site": "one"}, "production": {"limit": 10}}
    tables, root = Registry(), new_folder(spark, "tables")

    @tables.table("dear", requires=("limit",))
    def dear(spark, limit: float) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/orders.parquet").where(F.col("o_totalprice") >= limit)

    tables.run(spark, root, resources=environment(settings, "test"))
    return tables.read(spark, root, "dear").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
