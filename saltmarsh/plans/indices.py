"""Queries: levels, indices, models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import domain
from ..operators.relational import union_all
from .catalogue import query


@query("""SELECT event_id, CASE WHEN v IS NULL THEN 'white' WHEN v < 0 THEN NULL WHEN v < 5 THEN 'green' WHEN v < 30 THEN 'yellow' WHEN v < 27000 THEN 'orange' ELSE 'purple' END AS level
FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN floor(value) - 5 WHEN 2 THEN value * 100 ELSE value / 10 END AS v FROM events)""")
def threshold_level(events: DataFrame) -> DataFrame:
    k = F.col("event_id") % 4
    v = F.when(k == 1, F.floor("value") - 5).when(k == 2, F.col("value") * 100).when(k == 3, F.col("value") / 10)
    return events.select("event_id", domain.threshold_level(v).alias("level"))


# The two sub-indices written out by hand, each branch from the public table.
_AQI = """WITH v AS (SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN value END AS a, CASE WHEN event_id % 11 <> 0 THEN value * 1.3 END AS b FROM events),
t AS (SELECT event_id, a, b, floor(a * 10) / 10 AS fine, floor(b) AS coarse FROM v),
i AS (SELECT event_id, CASE WHEN a IS NULL OR a < 0 THEN NULL
  WHEN fine <= 12.0 THEN round(50 / 12.0::DOUBLE * fine) WHEN fine <= 35.4 THEN round(49 / 23.3::DOUBLE * (fine - 12.1) + 51) WHEN fine <= 55.4 THEN round(49 / 19.9::DOUBLE * (fine - 35.5) + 101)
  WHEN fine <= 150.4 THEN round(49 / 94.9::DOUBLE * (fine - 55.5) + 151) WHEN fine <= 250.4 THEN round(99 / 99.9::DOUBLE * (fine - 150.5) + 201)
  WHEN fine <= 350.4 THEN round(99 / 99.9::DOUBLE * (fine - 250.5) + 301) WHEN fine <= 500.4 THEN round(99 / 149.9::DOUBLE * (fine - 350.5) + 401) ELSE 500 END AS pm25,
  CASE WHEN b IS NULL OR b < 0 THEN NULL
  WHEN coarse <= 54 THEN round(50 / 54::DOUBLE * coarse) WHEN coarse <= 154 THEN round(49 / 99::DOUBLE * (coarse - 55) + 51) WHEN coarse <= 254 THEN round(49 / 99::DOUBLE * (coarse - 155) + 101)
  WHEN coarse <= 354 THEN round(49 / 99::DOUBLE * (coarse - 255) + 151) WHEN coarse <= 424 THEN round(99 / 69::DOUBLE * (coarse - 355) + 201)
  WHEN coarse <= 504 THEN round(99 / 79::DOUBLE * (coarse - 425) + 301) WHEN coarse <= 604 THEN round(99 / 99::DOUBLE * (coarse - 505) + 401) ELSE 500 END AS pm10 FROM t)
SELECT event_id, greatest(pm25, pm10)::INT AS aqi FROM i"""


@query(_AQI)
def aqi_index(events: DataFrame) -> DataFrame:
    a = F.when(F.col("event_id") % 7 != 0, F.col("value"))
    b = F.when(F.col("event_id") % 11 != 0, F.col("value") * 1.3)
    return events.select("event_id", domain.aqi(a, b).alias("aqi"))


@query("""SELECT event_id, CASE WHEN u <> 0 THEN round(100 / (2 * pi() * u * 20 * 10) * exp(-(y * y) / 800) * (exp(-((1.5 - 5) * (1.5 - 5)) / 200) + exp(-((1.5 + 5) * (1.5 + 5)) / 200)), 9) END AS c
FROM (SELECT event_id, (event_id % 9)::DOUBLE AS u, value / 10 AS y FROM events)""")
def gaussian_plume(events: DataFrame) -> DataFrame:
    u, y = (F.col("event_id") % 9).cast("double"), F.col("value") / 10
    c = domain.gaussian_plume(F.lit(100.0), u, y, F.lit(1.5), F.lit(5.0), F.lit(20.0), F.lit(10.0))
    return events.select("event_id", F.round(c, 9).alias("c"))


@query("""SELECT event_type, CASE event_type WHEN 'error' THEN 1 ELSE 3 END AS days_allowed, max(ts) AS newest, floor(epoch(TIMESTAMP '2024-02-02' - max(ts)))::BIGINT AS age_seconds,
TIMESTAMP '2024-02-02' - max(ts) <= to_days(CASE event_type WHEN 'error' THEN 1 ELSE 3 END) AS passed FROM events WHERE event_type <> 'view' OR ts < TIMESTAMP '2024-01-15' GROUP BY event_type""")
def freshness_check(events: DataFrame) -> DataFrame:
    """Whether each kind of event is fresh; views end a fortnight before."""
    from .checks import freshness

    kept = events.where("event_type <> 'view' OR ts < TIMESTAMP_NTZ '2024-01-15'")
    kinds = [r[0] for r in kept.select("event_type").distinct().collect()]  # a table each, as its check is
    as_of = F.lit("2024-02-02").cast("timestamp_ntz")
    days = {k: 1 if k == "error" else 3 for k in kinds}
    found = [freshness(kept.where(F.col("event_type") == k), "ts", as_of, f"{days[k]} days").select(F.lit(k).alias("event_type"), F.lit(days[k]).alias("days_allowed"), "newest", F.col("age_seconds").cast("long").alias("age_seconds"), "passed") for k in kinds]
    return union_all(*found)


@query()
def forest_regression(lineitem: DataFrame) -> DataFrame:
    """Mean absolute error and R2 of a random forest on a fixed split: a metric, not a bit-comparable result."""
    from .model import fit_forest

    features = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
    return fit_forest(lineitem.select(*features, "l_extendedprice"), features, "l_extendedprice", trees=20)
