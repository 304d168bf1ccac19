"""Checks taken while a table is written, partition keys, and what a failure stops."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from saltmarsh.plans import checks
from saltmarsh.plans.registry import CheckFailed, Registry, partition_key


def jobs(spark, action):
    """How many jobs the action starts."""
    tracker, group = spark.sparkContext.statusTracker(), f"g{datetime.now().timestamp()}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(tracker.getJobIdsForGroup(group))


def test_three_checks_in_the_job_that_writes(spark, tmp_path):
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 != 0, F.col("id")).alias("some"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("at"))
    watched = {
        "rows": checks.expect_rows(1000, 1000), "given": checks.expect_no_nulls("id", "some"),
        "fresh": checks.expect_fresh("at", datetime(1970, 1, 1, 0, 16, 40), timedelta(seconds=1)), "small": checks.expect_all(F.col("some") < 999),
    }
    seen, results = checks.observed(df, watched)
    plain = jobs(spark, lambda: df.write.mode("overwrite").parquet(str(tmp_path / "plain")))
    assert jobs(spark, lambda: seen.write.mode("overwrite").parquet(str(tmp_path / "seen"))) == plain == 1
    found = results()
    assert {k: ok for k, (ok, _) in found.items()} == {"rows": True, "given": False, "fresh": True, "small": False}
    assert found["given"][1] == {"id": 0, "some": 100} and found["small"][1] == {"failing": 101}
    assert spark.read.parquet(str(tmp_path / "seen")).count() == 1000


def test_empty_tables_are_not_fresh(spark, tmp_path):
    seen, results = checks.observed(spark.createDataFrame([], "at timestamp_ntz"), {"fresh": checks.expect_fresh("at", datetime(2024, 1, 1), timedelta(days=9)), "rows": checks.expect_rows(), "given": checks.expect_no_nulls("at")})
    seen.write.parquet(str(tmp_path / "empty"))
    assert {k: ok for k, (ok, _) in results().items()} == {"fresh": False, "rows": False, "given": True}


def test_a_failed_expectation_stops_what_depends_on_it(spark, tmp_path):
    tables, built, told = Registry(), [], []

    @tables.table("a")
    def a(spark):
        return spark.range(3)

    @tables.table("b", deps=("a",))
    def b(spark, a):
        built.append("b")
        return a

    tables.expect("a", many=checks.expect_rows(10), some=checks.expect_rows(1))
    with pytest.raises(CheckFailed, match="a: many"):
        tables.run(spark, str(tmp_path), on_failure=lambda name, e: told.append(name))
    assert built == [] and told == ["a"]
    rows = tables.run(spark, str(tmp_path), stop=False).collect()
    assert sorted(map(tuple, rows)) == [("a", "many", False), ("a", "some", True)] and built == ["b"]


def test_partition_keys():
    assert partition_key(datetime(2024, 2, 29, 23, 59)) == "2024-02-29"
    assert [partition_key(datetime(2024, 3, d), "week") for d in (2, 3, 9, 10)] == ["2024-02-25", "2024-03-03", "2024-03-03", "2024-03-10"]
    assert partition_key(datetime(2024, 3, 3), "week", week_start=0) == "2024-02-26" and partition_key(datetime(2024, 3, 31), "month") == "2024-03-01"


def test_environments(spark, tmp_path):
    from saltmarsh.plans.registry import environment

    tables = Registry()

    @tables.table("a", requires=("limit", "notifier"))
    def a(spark, limit, notifier):
        notifier.append(limit)
        return spark.range(limit)

    settings = {"default": {"limit": 3}, "test": {"notifier": []}, "production": {"limit": 5}}
    with pytest.raises(ValueError, match=r"notifier \(for a\)"):
        tables.run(spark, str(tmp_path), resources=environment(settings, "production"))
    assert not list(tmp_path.iterdir())
    given = environment(settings, "test")
    tables.run(spark, str(tmp_path), resources=given)
    assert tables.read(spark, str(tmp_path), "a").count() == 3 and given["notifier"] == [3]
    with pytest.raises(ValueError, match="no environment x"):
        environment(settings, "x")
