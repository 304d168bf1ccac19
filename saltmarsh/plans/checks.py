"""Data-quality checks.

A check of a table that is there gives one row with ``passed``. An ``Expectation`` is checked while the table is written: its
metrics are aggregates that Spark observes as the rows pass, so no row is read again for it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def freshness(df: DataFrame, time: str, as_of: Column, at_most: str) -> DataFrame:
    """(newest, age_seconds, passed): whether the newest row is at most this old. An empty table fails."""
    newest = df.agg(F.max(time).alias("newest"))
    age = F.timestamp_diff("SECOND", F.col("newest"), as_of)
    passed = F.coalesce(as_of - F.expr(f"INTERVAL {at_most}") <= F.col("newest"), F.lit(False))
    return newest.select("newest", age.alias("age_seconds"), passed.alias("passed"))


def no_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column counts of nulls, passed)."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return counts.withColumn("passed", F.lit(0) == sum((F.col(c) for c in columns), F.lit(0)))


@dataclass(frozen=True)
class Expectation:
    """Aggregates by name, and whether their values will do. Names are the expectation's own."""

    metrics: dict[str, Column]
    passed: Callable[[dict], bool]


def expect_fresh(time: str, as_of: datetime, at_most: timedelta) -> Expectation:
    """The newest row is at most this old; an empty table fails. ``as_of`` is in the zone of the column, or without one."""
    return Expectation({"newest": F.max(time)}, lambda m: m["newest"] is not None and as_of - m["newest"] <= at_most)


def expect_no_nulls(*columns: str) -> Expectation:
    return Expectation({c: F.count_if(F.col(c).isNull()) for c in columns}, lambda m: not any(m.values()))


def expect_rows(at_least: int = 1, at_most: int | None = None) -> Expectation:
    return Expectation({"rows": F.count(F.lit(1))}, lambda m: m["rows"] >= at_least and (at_most is None or m["rows"] <= at_most))


def expect_all(condition: Column) -> Expectation:
    """The condition holds for each row; null counts as not."""
    return Expectation({"failing": F.count_if(~F.coalesce(condition, F.lit(False)))}, lambda m: m["failing"] == 0)


def observed(df: DataFrame, expectations: dict[str, Expectation]) -> tuple[DataFrame, Callable[[], dict[str, tuple[bool, dict]]]]:
    """``df`` with the expectations' metrics watched, and a function that gives (passed, metrics) for each once some action
    has run over all its rows. One action for any number of expectations.
    """
    if not expectations:
        return df, dict
    names = {(e, m): f"m{k}" for k, (e, m) in enumerate((e, m) for e, x in expectations.items() for m in x.metrics)}
    watch = Observation()
    seen = df.observe(watch, *(expectations[e].metrics[m].alias(n) for (e, m), n in names.items()))

    def results() -> dict[str, tuple[bool, dict]]:
        values = watch.get
        found = {e: {m: values[n] for (own, m), n in names.items() if own == e} for e in expectations}
        return {e: (bool(x.passed(found[e])), found[e]) for e, x in expectations.items()}

    return seen, results
