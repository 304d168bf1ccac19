"""Filters, equi-joins, aggregates, ordering, deduplication and unions, with explicit null and tie rules."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import new_folder


def last_days(df: DataFrame, time: str, days: int, as_of: Column) -> DataFrame:
    """Rows strictly newer than ``days`` before ``as_of``."""
    return df.where(F.col(time) > F.timestamp_add("DAY", F.lit(-days), as_of))


def newer_than(df: DataFrame, time: str, mark: DataFrame) -> DataFrame:
    """Rows newer than the one value in ``mark`` (all rows if it is null): the incremental read after a stored maximum."""
    (column,) = mark.columns
    newest = mark.agg(F.max(column)).scalar()
    return df.where(newest.isNull() | (F.col(time) > newest))


def equi_join(left: DataFrame, right: DataFrame, on: list[tuple[str, str]], how: str = "inner", null_safe: bool = False, suffix: str = "_y") -> DataFrame:
    """A join on pairs of column names. Other columns of ``right`` that clash get ``suffix``; null keys match only if ``null_safe``."""
    renamed = {c: f"{c}{suffix}" for c in right.columns if c in left.columns}
    right = right.withColumnsRenamed(renamed)
    pairs = [(left[a], right[renamed.get(b, b)]) for a, b in on]
    condition = reduce(Column.__and__, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])
    return left.join(right, condition, how)


def unmatched(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    return left.join(right, key, "left_anti")


def grouped(df: DataFrame, keys: list[str | Column], *aggregates: Column) -> DataFrame:
    """A grouping that drops rows with a null key."""
    named = [F.col(k) if isinstance(k, str) else k for k in keys]
    present = reduce(Column.__and__, [k.isNotNull() for k in named])
    return df.where(present).groupBy(*keys).agg(*aggregates)


def max_of_all(df: DataFrame, key: str) -> DataFrame:
    """Each column's own maximum in a group."""
    return grouped(df, [key], *(F.max(c).alias(c) for c in df.columns if c != key))


def count_of_all(df: DataFrame, key: str) -> DataFrame:
    """Each column's non-null count in a group."""
    return grouped(df, [key], *(F.count(c).alias(c) for c in df.columns if c != key))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return grouped(df, [column], F.count(F.lit(1)).alias("n")).orderBy(column)


def top_groups(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n largest groups; ties go to the smaller key."""
    return grouped(df, [key], F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), key).limit(n)


def describe(df: DataFrame, column: str) -> DataFrame:
    """One row: count, mean, sample deviation, min, exact quartiles, max; null and NaN as Spark's aggregates treat them."""
    c = F.col(column)
    basic = [F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).alias("min"), F.max(c).alias("max")]
    whole = df.agg(*basic, *(x.alias(f"_{k}") for k, x in enumerate(_ends(c.cast("double")))))
    found, kinds = whole.first(), whole.schema
    quartiles = exact_quantiles(df, column, [0.25, 0.5, 0.75], tuple(found)[len(basic) :])
    shape = ", ".join(f"{n} {'double' if n[0] == 'p' else kinds[n].dataType.simpleString()}" for n in ("n", "mean", "std", "min", "p25", "p50", "p75", "max"))
    return df.sparkSession.createDataFrame([(found["n"], found["mean"], found["std"], found["min"], *quartiles, found["max"])], shape)


#: Bins of one round, and values that are looked at one by one.
BINS, FEW = 4096, 10_000


def _ends(v: Column) -> list[Column]:
    """Aggregates: how many values there are, how many of them are minus infinity and how many finite, the least and the greatest
    finite one, and how many are infinity.
    """
    finite = v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    number = F.when(finite, v)
    return [F.count(v), F.count_if(v == float("-inf")), F.count_if(finite), F.min(number), F.max(number), F.count_if(v == float("inf"))]


def exact_quantiles(df: DataFrame, column: str, shares: list[float], ends: tuple | None = None) -> list[float | None]:
    """Quantiles with linear interpolation, exact, in bounded memory whatever the number of rows or of different values.

    Each round counts the rows in BINS bins of the stretch that holds a wanted rank, with map-side combining, and goes on with
    the one bin that has it, from its least to its greatest value, until the bin is one value or holds FEW different ones at
    most, which are counted one by one. All ranks are narrowed in the same scan; most columns take two or three scans. Nulls
    are left out; NaN is greater than all numbers; without rows, all are null. ``ends``: what ``_ends`` gives, if it is known.
    """
    v = F.col("v")
    rows = df.select(F.col(column).cast("double").alias("v")).where(v.isNotNull())
    n, below, finite, low, high, above = ends or rows.agg(*_ends(v)).first()
    if not n:
        return [None] * len(shares)
    spots = [(n - 1) * s for s in shares]
    ranks = sorted({r for x in spots for r in (math.floor(x), math.ceil(x))})
    values: dict[int, float] = {}
    open_: dict[int, tuple[float, float, int]] = {}  # rank -> stretch, and the rows before it
    for r in ranks:
        if r < below:
            values[r] = float("-inf")
        elif r < below + finite:
            open_[r] = (low, high, below)
        else:
            values[r] = float("inf") if r < below + finite + above else float("nan")
    while open_:
        for r, (a, b, _) in list(open_.items()):
            if a == b:
                values[r] = a
                del open_[r]
        stretches = sorted({s for s in open_.values()})
        if not stretches:
            break
        # halves, so that the width of a stretch is a number
        bins = [F.when(v.between(a, b), F.struct(F.lit(k).alias("k"), F.least(F.floor((v / 2 - a / 2) / (b / 2 - a / 2) * BINS), F.lit(BINS - 1)).alias("bin"))) for k, (a, b, _) in enumerate(stretches)]
        placed = rows.select("v", F.explode(F.array_compact(F.array(*bins))).alias("p"))
        counted = placed.groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("a"), F.max("v").alias("b"), F.approx_count_distinct("v").alias("d")).collect()
        by_stretch: dict[int, list] = {}
        for row in sorted(counted, key=lambda x: (x["p"]["k"], x["p"]["bin"])):
            by_stretch.setdefault(row["p"]["k"], []).append(row)
        few: dict[tuple[float, float, int], list[int]] = {}
        for r, stretch in list(open_.items()):
            before = stretch[2]
            for row in by_stretch[stretches.index(stretch)]:
                if r < before + row["n"]:
                    open_[r] = (row["a"], row["b"], before)
                    if row["d"] <= FEW / 2 and row["a"] < row["b"]:
                        few.setdefault(open_[r], []).append(r)
                    break
                before += row["n"]
        if few:
            wanted = reduce(Column.__or__, [v.between(a, b) for a, b, _ in few])
            single = sorted(map(tuple, rows.where(wanted).groupBy("v").agg(F.count(F.lit(1))).collect()))
            for (a, b, before), own in few.items():
                for value, times in single:
                    if a <= value <= b:
                        values |= {r: value for r in own if before <= r < before + times}
                        before += times
                for r in own:
                    del open_[r]
    between = lambda x: values[math.floor(x)] if x == math.floor(x) else (math.ceil(x) - x) * values[math.floor(x)] + (x - math.floor(x)) * values[math.ceil(x)]
    return [between(x) for x in spots]


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order; null keys form a key."""
    return n_per_key(df, keys, order, 1)


def n_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def row_numbers(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with its rows numbered from 1 in this order, without one window over all rows: sorted by ranges, written, and
    numbered inside each range from the number of rows in those before it. Equal rows are numbered in any order.
    """
    path = new_folder(df.sparkSession, "sorted")
    df.orderBy(*order).withColumn("_m", F.monotonically_increasing_id()).write.parquet(path)
    rows = df.sparkSession.read.parquet(path).withColumns({"_p": F.shiftright("_m", 33), "_at": F.col("_m").bitwiseAND((1 << 33) - 1)})
    offsets, before = [], 0
    for p, n in sorted(map(tuple, rows.groupBy("_p").count().collect())):
        offsets.append((p, before + 1))
        before += n
    starts = df.sparkSession.createDataFrame(offsets, "_p long, _first long")
    return rows.join(F.broadcast(starts), "_p").withColumn(name, F.col("_first") + F.col("_at")).drop("_p", "_at", "_m", "_first")


def last_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first n rows in ``order`` (give it descending) of each group; rows with a null key go."""
    return n_per_key(df.na.drop(subset=keys), keys, order, n)


def without_first(df: DataFrame, position: str) -> DataFrame:
    """Drops the row with the smallest position: a table's cumulative first row."""
    return df.where(F.col(position) > df.agg(F.min(position)).scalar())


def rolling_sum(df: DataFrame, value: str, order: list[str], rows: int, name: str, by: list[str] | None = None) -> DataFrame:
    """The sum of this and the rows - 1 rows before it; fewer at the start. Without ``by``, all rows are one sequence."""
    window = Window.partitionBy(*(by or [])).orderBy(*order).rowsBetween(1 - rows, 0)
    return df.withColumn(name, F.sum(value).over(window))


def forward_fill(df: DataFrame, column: str, by: list[str], order: list[str], blank: Column | None = None) -> DataFrame:
    """Fills nulls (and values where ``blank`` holds) with the last value before; rows before the first value stay null."""
    value = F.when(~blank, F.col(column)) if blank is not None else F.col(column)
    window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(column, F.last(value, ignorenulls=True).over(window))


def union_all(*tables: DataFrame | None) -> DataFrame:
    """The union by column name of the tables that are there; a column that a table lacks is null in its rows."""
    present = [t for t in tables if t is not None]
    if not present:
        raise ValueError("no table")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), present)


def upsert(base: DataFrame, updates: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """``base`` with rows replaced, by key, and added from ``updates``; of repeated keys, the first in ``order`` counts."""
    if order:
        updates = first_per_key(updates, keys, order)
    return base.join(updates, keys, "left_anti").unionByName(updates)


def row_sum(*columns: Column) -> Column:
    """The sum across columns, nulls as 0."""
    return reduce(Column.__add__, [F.coalesce(c, F.lit(0)) for c in columns])


def row_max(*columns: Column) -> Column:
    return F.greatest(*(F.coalesce(c, F.lit(0)) for c in columns))


def columns_like(df: DataFrame, part: str) -> list[str]:
    return [c for c in df.columns if part in c]


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """``drop`` that fails on a name that isn't there."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    return df.drop(*names)
