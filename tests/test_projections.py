"""Map projections: a published example, round trips, nulls."""

import math

import pytest
from pyspark.sql import functions as F

from saltmarsh.functions import projections as p


def test_published_example(spark):
    """The worked example of the public guidance note on conic conformal projections with two parallels (Clarke 1866, feet)."""
    zone = p.Conic(28 + 23 / 60, 30 + 17 / 60, 27 + 50 / 60, -99.0, 2000000.0, 0.0, p.SURVEY_FOOT, 6378206.4, 1 / 294.9786982)
    row = spark.range(1).select(zone.forward(F.lit(-96.0), F.lit(28.5)).alias("p"), zone.inverse(F.lit(2963503.91), F.lit(254759.80)).alias("q")).first()
    assert row["p"]["x"] == pytest.approx(2963503.91, abs=0.01) and row["p"]["y"] == pytest.approx(254759.80, abs=0.01)
    assert row["q"]["longitude"] == pytest.approx(-96.0, abs=1e-7) and row["q"]["latitude"] == pytest.approx(28.5, abs=1e-7)


@pytest.mark.parametrize("zone", [*p.CRS.values(), p.Conic(45.0, 45.0, 45.0, 0.0, 0.0, 0.0), p.Conic(-20.0, -40.0, -30.0, 140.0, 500.0, 700.0)], ids=str)
def test_round_trip(spark, zone):
    grid = spark.range(400).select((F.col("id") % 20 - 10 + zone.lon_0).cast("double").alias("lon"), (F.floor(F.col("id") / 20) * 0.9 - 9 + zone.lat_0).alias("lat"))
    there = grid.withColumn("p", zone.forward(F.col("lon"), F.col("lat")))
    back = there.select("lon", "lat", zone.inverse(F.col("p.x"), F.col("p.y")).alias("q"))
    worst = back.agg(F.max(F.abs(F.col("lon") - F.col("q.longitude"))), F.max(F.abs(F.col("lat") - F.col("q.latitude"))), F.count("q")).first()
    assert worst[2] == 400 and worst[0] < 1e-9 and worst[1] < 1e-9


def test_origin_and_nulls(spark):
    rows = [(6561666.667, 1640416.667), (None, 1.0), (1.0, None)]
    at = [r["p"] for r in spark.createDataFrame(rows, "x double, y double").select(p.to_degrees(F.col("x"), F.col("y"), "EPSG:2230").alias("p")).collect()]
    assert at[0]["longitude"] == -116.25 and math.isclose(at[0]["latitude"], 32 + 10 / 60, abs_tol=1e-12) and at[1:] == [None, None]
    bad = spark.createDataFrame([(0.0, 91.0), (None, 1.0), (1.0, None)], "x double, y double").select(p.from_degrees(F.col("x"), F.col("y"), "EPSG:2229").alias("p"))
    assert [r["p"] for r in bad.collect()] == [None] * 3
