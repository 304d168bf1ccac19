"""Queries: pivots, unpivots, calendars, windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import relational as op
from ..operators import reshape
from .catalogue import query

KINDS = ["click", "error", "purchase", "signup", "view"]


@query("SELECT day, " + ", ".join(f"max(value) FILTER (WHERE event_type = '{k}') AS \"{k}\"" for k in KINDS) + " FROM (SELECT ts::DATE AS day, * FROM events) GROUP BY day")
def pivot_max(events: DataFrame) -> DataFrame:
    return reshape.pivot(events.select(F.to_date("ts").alias("day"), "event_type", "value"), ["day"], "event_type", KINDS, F.max("value"))


@query("SELECT day, " + ", ".join(f"round(avg(value) FILTER (WHERE event_type = '{k}'), 6) AS \"{k}\"" for k in KINDS) + " FROM (SELECT ts::DATE AS day, * FROM events) GROUP BY day")
def pivot_mean(events: DataFrame) -> DataFrame:
    wide = reshape.pivot(events.select(F.to_date("ts").alias("day"), "event_type", "value"), ["day"], "event_type", KINDS, F.avg("value"))
    return wide.select("day", *(F.round(k, 6).alias(k) for k in KINDS))


@query("SELECT ts::DATE AS day, 'h' || hour(ts) AS hour, count(*) AS n FROM events GROUP BY 1, 2")
def unpivot_hours(events: DataFrame) -> DataFrame:
    hours = [f"h{h}" for h in range(24)]
    named = events.select(F.to_date("ts").alias("day"), F.concat(F.lit("h"), F.hour("ts")).alias("hour"))
    wide = reshape.pivot(named, ["day"], "hour", hours, F.count(F.lit(1)))
    return reshape.unpivot(wide, ["day"], hours, "hour", "n").where(F.col("n").isNotNull())


@query("""WITH d AS (SELECT user_id, ts::DATE AS day, count(*) AS n FROM events GROUP BY 1, 2),
s AS (SELECT user_id, unnest(generate_series(min(day), max(day), INTERVAL 1 DAY))::DATE AS day FROM d GROUP BY user_id)
SELECT user_id, day, coalesce(n, 0) AS n FROM s LEFT JOIN d USING (user_id, day)""")
def resample_daily_zero_fill(events: DataFrame) -> DataFrame:
    daily = events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return reshape.daily_zero_filled(daily, "user_id", "day", "n")


@query("""WITH d AS (SELECT ts::DATE AS day, count(*) AS n FROM events WHERE event_type = 'signup' GROUP BY 1), m AS (SELECT max(day) AS b FROM d)
SELECT day, n FROM (SELECT unnest(generate_series(b - 89, b, INTERVAL 1 DAY))::DATE AS day FROM m) LEFT JOIN d USING (day)""")
def calendar_spine(events: DataFrame) -> DataFrame:
    daily = events.where("event_type = 'signup'").groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return reshape.calendar(daily, "day", 90)


@query("""WITH i AS (SELECT o_orderkey, o_orderdate, max(l_shipdate) - INTERVAL 30 DAY AS done FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2)
SELECT week, count(*) AS n FROM (SELECT unnest(generate_series(date_trunc('week', o_orderdate), date_trunc('week', done), INTERVAL 7 DAY))::DATE AS week FROM i WHERE done >= o_orderdate) GROUP BY week""")
def explode_weeks_count(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    shipped = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg((F.max("l_shipdate") - F.expr("INTERVAL 30 DAYS")).alias("done"))
    return reshape.per_week(orders.select("o_orderkey", "o_orderdate").join(shipped, "o_orderkey"), "o_orderdate", "done")


@query("SELECT o_orderkey, date_trunc('week', o_orderdate)::DATE AS week FROM orders")
def week_trunc(orders: DataFrame) -> DataFrame:
    return orders.select("o_orderkey", F.date_trunc("week", "o_orderdate").cast("date").alias("week"))


@query("""WITH d AS (SELECT ts::DATE AS day, count(*) AS n FROM events GROUP BY 1)
SELECT day, n, sum(n) OVER (ORDER BY day ROWS 2 PRECEDING)::BIGINT AS n3 FROM d""")
def rolling_sum(events: DataFrame) -> DataFrame:
    # the window has one partition of one row a day
    daily = events.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return op.rolling_sum(daily, "n", ["day"], 3, "n3")


@query("""SELECT event_id, user_id, last_value(nullif(event_type, 'view') IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS event_type FROM events""")
def forward_fill(events: DataFrame) -> DataFrame:
    rows = events.select("event_id", "user_id", "ts", "event_type")
    return op.forward_fill(rows, "event_type", ["user_id"], ["ts", "event_id"], blank=F.col("event_type") == "view").drop("ts")
