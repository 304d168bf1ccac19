"""Queries: dates and times."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import times
from .catalogue import query


@query("SELECT event_id, ts FROM (SELECT event_id, date_trunc('millisecond', ts) AS ts FROM events)")
def epoch_ms(events: DataFrame) -> DataFrame:
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return events.select("event_id", times.from_epoch_ms(ms).cast("timestamp_ntz").alias("ts"))


@query("SELECT event_id, (ts AT TIME ZONE 'America/Los_Angeles') AT TIME ZONE 'UTC' AS utc, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' AS pacific FROM events")
def zone_convert(events: DataFrame) -> DataFrame:
    zone = "America/Los_Angeles"
    return events.select("event_id", times.localized(F.col("ts"), zone).cast("timestamp_ntz").alias("utc"), times.in_zone(F.col("ts"), zone).cast("timestamp_ntz").alias("pacific"))


@query("""WITH t AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN TIMESTAMP '2024-03-10 08:00:00' ELSE TIMESTAMP '2024-11-03 07:00:00' END + to_minutes(event_id % 241) AS u FROM events),
p AS (SELECT event_id, u, (u AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' AS pacific FROM t)
SELECT event_id, pacific, strftime(pacific, '%Y-%m-%dT%H:%M:%S') || CASE date_diff('hour', u, pacific) WHEN -8 THEN '-08:00' WHEN -7 THEN '-07:00' END AS iso FROM p""")
def zone_clock_changes(events: DataFrame) -> DataFrame:
    """Instants in the hours around both clock changes of a year."""
    zone = "America/Los_Angeles"
    start = F.when(F.col("event_id") % 2 == 0, "2024-03-10 08:00:00").otherwise("2024-11-03 07:00:00").cast("timestamp_ntz")
    at = events.select("event_id", F.timestamp_add("MINUTE", (F.col("event_id") % 241).cast("int"), start).alias("u"))
    return at.select("event_id", times.in_zone(F.col("u"), zone).cast("timestamp_ntz").alias("pacific"), times.iso_text(F.col("u"), zone).alias("iso"))


@query("SELECT o_orderkey, o_orderdate::DATE + INTERVAL 8 HOUR + INTERVAL 1 HOUR * (o_orderkey % 24) AS instant FROM orders")
def fixed_offset_hour(orders: DataFrame) -> DataFrame:
    return orders.select("o_orderkey", times.report_hour(F.to_date("o_orderdate"), (F.col("o_orderkey") % 24).cast("int")).alias("instant"))


@query("""SELECT o_orderkey, CASE WHEN w <= 52 OR isoyear(m) = y THEN m END AS monday FROM (SELECT o_orderkey, y, w, (date_trunc('week', make_date(y, 1, 4)) + INTERVAL 7 DAY * (w - 1))::DATE + 3 AS t,
(date_trunc('week', make_date(y, 1, 4)) + INTERVAL 7 DAY * (w - 1))::DATE AS m FROM (SELECT o_orderkey, year(o_orderdate)::INT AS y, (1 + o_orderkey % 53)::INT AS w FROM orders)) WHERE w < 53
UNION ALL SELECT o_orderkey, CASE WHEN year(m + 3) = y THEN m END FROM (SELECT o_orderkey, y, (date_trunc('week', make_date(y, 1, 4)) + INTERVAL 364 DAY)::DATE AS m FROM (SELECT o_orderkey, year(o_orderdate)::INT AS y, 1 + o_orderkey % 53 AS w FROM orders) WHERE w = 53)""")
def iso_week_monday(orders: DataFrame) -> DataFrame:
    week = (F.col("o_orderkey") % 53 + 1).cast("int")
    return orders.select("o_orderkey", times.iso_week_monday(F.year("o_orderdate"), week).alias("monday"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderdate::DATE END AS day FROM orders")
def try_parse_date(orders: DataFrame) -> DataFrame:
    raw = F.when(F.col("o_orderkey") % 4 != 0, F.date_format("o_orderdate", "MM/dd/yyyy")).otherwise("13/45/soon")
    return orders.select("o_orderkey", times.try_date(raw, "MM/dd/yyyy").alias("day"))


@query("SELECT o_orderkey, o_orderdate::DATE + INTERVAL 1 HOUR * (o_orderkey % 24) + INTERVAL 1 MINUTE * (o_orderkey % 60) AS at FROM orders")
def date_plus_time(orders: DataFrame) -> DataFrame:
    clock = F.format_string("%02d:%02d:00", F.col("o_orderkey") % 24, F.col("o_orderkey") % 60)
    return orders.select("o_orderkey", times.date_plus_time(F.to_date("o_orderdate"), clock).alias("at"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, strftime(ts, '%Y%m%d') AS compact, strftime(ts, '%Y-%m-%dT%H') AS hour FROM events")
def format_ts(events: DataFrame) -> DataFrame:
    shown = lambda p: F.date_format("ts", p)
    return events.select("event_id", shown("yyyy-MM-dd'T'HH:mm:ss").alias("iso"), shown("yyyyMMdd").alias("compact"), shown("yyyy-MM-dd'T'HH").alias("hour"))


@query("SELECT event_id, strftime((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles', '%Y-%m-%dT%H:%M:%S') || '-08:00' AS iso FROM events")
def iso_text_offset(events: DataFrame) -> DataFrame:
    return events.select("event_id", times.iso_text(F.col("ts"), "America/Los_Angeles").alias("iso"))


@query("SELECT event_id, hour(ts)::INT AS hour FROM events")
def hour_of_day(events: DataFrame) -> DataFrame:
    return events.select("event_id", F.hour("ts").alias("hour"))


@query("SELECT o_orderkey, o_orderdate::DATE + (o_orderkey % 90)::INT AS day FROM orders")
def relative_day(orders: DataFrame) -> DataFrame:
    return orders.select("o_orderkey", F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 90).cast("int")).alias("day"))


@query("SELECT n_nationkey, unnest(range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * n_nationkey, INTERVAL 1 HOUR)) AS at FROM nation")
def regular_grid(nation: DataFrame) -> DataFrame:
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    return nation.select("n_nationkey", F.explode(times.regular_grid(start, F.timestamp_add("HOUR", F.col("n_nationkey"), start), 3600)).alias("at"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN strftime(greatest(o_orderdate, TIMESTAMP '1998-01-01'), '%Y-%m-%dT%H:%M:%S') || '/' || strftime(o_orderdate + INTERVAL 2 DAY, '%Y-%m-%dT%H:%M:%S') END AS span FROM orders""")
def interval_string(orders: DataFrame) -> DataFrame:
    end = F.when(F.col("o_orderkey") % 5 != 0, F.timestamp_add("DAY", F.lit(2), F.col("o_orderdate")))
    return orders.select("o_orderkey", times.interval_text(F.col("o_orderdate"), end, F.lit("1998-01-01").cast("timestamp_ntz")).alias("span"))


@query("SELECT o_orderkey, coalesce(nullif(o_custkey % 3, 0), 0) AS n, coalesce(nullif(o_orderstatus, 'F'), '') AS status, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate END, TIMESTAMP '2001-01-01') AS done FROM orders")
def fill_null(orders: DataFrame) -> DataFrame:
    holes = orders.select(
        "o_orderkey",
        F.nullif(F.col("o_custkey") % 3, F.lit(0)).alias("n"),
        F.nullif("o_orderstatus", F.lit("F")).alias("status"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderdate")).alias("done"),
    )
    return holes.na.fill({"n": 0, "status": ""}).withColumn("done", F.coalesce("done", F.lit("2001-01-01").cast("timestamp_ntz")))


@query("""WITH t AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN TIMESTAMP '2024-03-10 00:00:00' ELSE TIMESTAMP '2024-11-03 00:00:00' END + to_minutes(event_id % 300) AS local FROM events)
SELECT event_id, local, local + CASE WHEN event_id % 2 = 0 THEN CASE WHEN local < TIMESTAMP '2024-03-10 03:00:00' THEN INTERVAL 8 HOUR ELSE INTERVAL 7 HOUR END
  ELSE CASE WHEN local < TIMESTAMP '2024-11-03 02:00:00' THEN INTERVAL 7 HOUR ELSE INTERVAL 8 HOUR END END AS utc FROM t""")
def localize_clock_changes(events: DataFrame) -> DataFrame:
    """Local times around both clock changes: one that is skipped counts as if the clock had not changed yet, one that comes
    twice is the first of the two.
    """
    start = F.when(F.col("event_id") % 2 == 0, F.lit("2024-03-10").cast("timestamp_ntz")).otherwise(F.lit("2024-11-03").cast("timestamp_ntz"))
    local = F.timestamp_add("MINUTE", (F.col("event_id") % 300).cast("int"), start)
    return events.select("event_id", local.alias("local"), times.localized(local, "America/Los_Angeles").cast("timestamp_ntz").alias("utc"))
