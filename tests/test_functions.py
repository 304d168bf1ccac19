from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from saltmarsh.functions import domain, text, times


def one(spark, column, **values):
    kinds = {str: "string", float: "double", int: "int", date: "date", datetime: "timestamp_ntz", type(None): "string"}
    schema = ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "raw, want",
    [("1.2 million gallons", 1.2e6), ("3,500 gallons", 3500.0), ("TBD", -1.0), ("Ongoing spill", -1.0), ("2billion", 2e9), ("garbage", None), (None, None), ("7", 7.0)],
)
def test_quantity(spark, raw, want):
    assert one(spark, text.parse_quantity(F.col("a")), a=raw) == want


@pytest.mark.parametrize(
    "raw, value, qualifier", [("<5", 5, "<"), ("<=5", 5, "<="), (">5", 5, ">"), ("5", 5, ""), ("M", None, ""), ("<", None, "<"), (">=5", None, ""), ("-3.5", -3.5, ""), (None, None, "")]
)
def test_qualifier(spark, raw, value, qualifier):
    found = one(spark, text.parse_qualifier(F.col("a")), a=raw)
    assert (found["value"], found["qualifier"], found["original"]) == (value, qualifier, raw)


@pytest.mark.parametrize("v, level", [(None, "white"), (0.0, "green"), (5.0, "yellow"), (30.0, "orange"), (27000.0, "purple"), (-1.0, None), (29.99, "yellow")])
def test_level(spark, v, level):
    assert one(spark, domain.threshold_level(F.col("a").try_cast("double")), a=v) == level


def test_aqi(spark):
    both = lambda a, b: one(spark, domain.aqi(F.col("a").try_cast("double"), F.col("b").try_cast("double")), a=a, b=b)
    assert both(12.0, 54.0) == 50 and both(35.5, None) == 101 and both(None, None) is None and both(9999.0, 1.0) == 500


def test_plume_without_wind(spark):
    c = lambda u: one(spark, domain.gaussian_plume(F.lit(1.0), F.col("a"), *(F.lit(1.0) for _ in range(5))), a=u)
    assert c(0.0) is None and c(2.0) > 0


def test_texts(spark):
    assert one(spark, text.title_case(F.col("a")), a="o'NEIL-x é") == "O'Neil-X É"
    assert one(spark, text.ascii_fold(F.col("a")), a="a ñb") == "ab"
    assert one(spark, text.composite_key(F.col("a"), F.col("b")), a="x", b=None) is None
    assert one(spark, text.split_once(F.col("a")), a="Homo sapiens x") == ("Homo", "sapiens x")
    assert one(spark, text.split_once(F.col("a")), a="Homo") == ("Homo", "")
    assert one(spark, text.last_strong(F.col("a")), a="<strong>a</strong><strong>b\nc</strong>") == "b\nc"
    assert one(spark, text.last_strong(F.col("a")), a="none") == ""
    assert one(spark, text.status_since(F.col("a")), a="<strong>Status Since:</strong>&nbsp;&nbsp;April 8, 2025") == "Apr 8, 2025"
    assert one(spark, text.status_since(F.col("a")), a="x") == ""
    assert one(spark, text.strip_fragments(F.col("a"), [("<p>", ""), ("b", " ")]), a=None) == ""
    assert one(spark, text.map_lookup(F.col("a"), {1: "x"}), a=2) is None
    assert one(spark, text.text_after_marker(F.col("a"), "Last Updated:"), a="<div>Last updated: 3 May</div>") == "3 May"


def test_clock_changes(spark):
    zone = "America/Los_Angeles"
    at = lambda d: str(one(spark, times.localized(F.col("a"), zone).cast("timestamp_ntz"), a=d))
    assert at(datetime(2024, 3, 10, 2, 30)) == "2024-03-10 10:30:00" and at(datetime(2024, 11, 3, 1, 30)) == "2024-11-03 08:30:00"
    for d in (date(2024, 1, 1), date(2024, 3, 10), date(2024, 7, 1), date(2024, 11, 3)):
        assert one(spark, times.report_hour(F.col("a"), F.lit(5)), a=d).hour == 13
    assert one(spark, times.iso_text(F.col("a"), zone), a=datetime(2024, 7, 1, 12)) == "2024-07-01T05:00:00-07:00"


def test_iso_weeks(spark):
    monday = lambda y, w: one(spark, times.iso_week_monday(F.col("a"), F.col("b")), a=y, b=w)
    assert monday(2020, 53) == date.fromisocalendar(2020, 53, 1) and monday(2021, 53) is None and monday(2021, 0) is None
    assert all(monday(y, w) == date.fromisocalendar(y, w, 1) for y, w in ((1998, 1), (2015, 20), (2026, 52)))


def test_dates(spark):
    assert one(spark, times.try_date(F.col("a"), "MM/dd/yyyy"), a="13/45/2024") is None
    assert one(spark, times.date_plus_time(F.col("a"), F.col("b")), a=date(2024, 1, 2), b="25:00:00") is None
    grid = one(spark, times.regular_grid(F.col("a"), F.col("b"), 3600), a=datetime(2024, 1, 1), b=datetime(2024, 1, 1, 2))
    assert len(grid) == 2
    assert one(spark, times.regular_grid(F.col("a"), F.col("b"), 3600), a=datetime(2024, 1, 2), b=datetime(2024, 1, 1)) == []
