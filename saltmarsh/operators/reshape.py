"""Pivots, unpivots and calendars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pivot(df: DataFrame, keys: list[str], names: str, values: list, aggregate: Column) -> DataFrame:
    """A column for each listed value (listing them saves a pass over the data); rows with a null key go."""
    return df.na.drop(subset=keys).groupBy(*keys).pivot(names, values).agg(aggregate)


def unpivot(df: DataFrame, keys: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    return df.unpivot(keys, columns, name, value)


def daily_zero_filled(df: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """A row for each day between a key's first and last one, missing values as 0. ``df`` has one row for a key and day."""
    span = df.na.drop(subset=[key, day]).groupBy(key).agg(F.min(day).alias("_a"), F.max(day).alias("_b"))
    days = span.select(key, F.explode(F.sequence("_a", "_b")).alias(day))
    return days.join(df, [key, day], "left").withColumn(value, F.coalesce(value, F.lit(0)))


def calendar(df: DataFrame, day: str, days: int) -> DataFrame:
    """``df`` on a spine of the last ``days`` days up to its last day; days without a row have nulls."""
    spine = df.agg(F.max(day).alias("_b")).select(F.explode(F.sequence(F.date_sub("_b", days - 1), F.col("_b"))).alias(day))
    return spine.join(df, day, "left")


def weeks_spanned(start: Column, end: Column) -> Column:
    """array of the Mondays from start's week to end's; empty if the end is before the start or either is null."""
    a, b = F.date_trunc("week", start).cast("date"), F.date_trunc("week", end).cast("date")
    # sequence() fails on bounds in the wrong order, so the end is held at the start first
    weeks = F.sequence(a, F.greatest(a, b), F.expr("INTERVAL 7 DAYS"))
    return F.when(start.isNotNull() & end.isNotNull() & (end >= start), weeks).otherwise(F.expr("cast(array() as array<date>)"))


def per_week(df: DataFrame, start: str, end: str) -> DataFrame:
    """(week, n): how many of the rows' intervals touch each week."""
    return df.select(F.explode(weeks_spanned(F.col(start), F.col(end))).alias("week")).groupBy("week").agg(F.count(F.lit(1)).alias("n"))


def running(df: DataFrame, value: str, order: list[str], name: str, by: list[str]) -> DataFrame:
    window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(value).over(window))
