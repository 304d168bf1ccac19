"""As-of join to the nearest row in time, without a range join.

1. Times of both sides are brought to one row for each key and time: the right rows with the largest and the smallest id, and
whether a left row asks. Equal times are combined before they are shuffled, so a time that a third of all rows share is one row.
2. These rows lie in slices of time that hold about equally many of them, wherever they are dense: the bounds are approximate
quantiles. Inside a slice of a key, one window in each direction of time carries the last right row along; both look back only,
so they take linear time. 3. A table of a row for each key and slice carries right rows across slices that have none. 4. Left rows
get their time's answer by an equi-join, which Spark splits where one time is common.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import new_folder

#: Slices of time for each shuffle partition, and in all.
SLICES, MOST_SLICES = 4, 4096


def _micros(df: DataFrame, name: str) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast(df.schema[name].dataType), F.col(name))


def _slice(t: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds are at or below t, found in two steps of a root of their number each."""
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    coarse = F.array(*(F.lit(b) for b in bounds[step - 1 :: step]))
    fine = F.array(*(F.array(*(F.lit(b) for b in bounds[a : a + step])) for a in range(0, len(bounds) + 1, step) if bounds[a : a + step]))
    at = F.size(F.filter(coarse, lambda b: b <= t))
    return at * step + F.coalesce(F.size(F.filter(F.get(fine, at), lambda b: b <= t)), F.lit(0))


def asof_nearest(
    left: DataFrame,
    right: DataFrame,
    left_time: str,
    right_time: str,
    right_id: str,
    by: list[str] | None = None,
    tolerance: str | None = None,
    name: str = "nearest",
    slices: int | None = None,
) -> DataFrame:
    """``left`` with a struct ``name`` of the right row (all its columns) that is nearest in time, or null.

    Equally near: the one before. Several at one time: the one with the largest ``right_id`` if it is before or equal,
    else the smallest. ``by``: columns of both that must be equal (null keys match nothing); ``tolerance``: an interval,
    such as '2 hours', beyond which there is no match. Right rows without a time match nothing; left rows without a time
    or with a null key keep a null. ``slices``: of time; by default four for each shuffle partition.
    """
    by = by or []
    spark = left.sparkSession
    keys = [f"_k{i}" for i in range(len(by))]
    named = lambda: [F.col(c).alias(k) for c, k in zip(by, keys)]
    rights = right.select(*named(), _micros(right, right_time).alias("_u"), F.struct(F.col(right_id).alias("id")).alias("_i"), F.struct(*right.columns).alias("_row"))
    lefts = left.select(*named(), _micros(left, left_time).alias("_u"))
    both = rights.withColumn("_asks", F.lit(False)).unionByName(lefts.withColumn("_asks", F.lit(True)), allowMissingColumns=True).na.drop(subset=[*keys, "_u"])
    slices = slices or min(SLICES * int(spark.conf.get("spark.sql.shuffle.partitions")), MOST_SLICES)
    bounds = both.agg(F.percentile_approx("_u", [k / slices for k in range(1, slices)], 10 * slices)).first()[0] if slices > 1 else None
    # left rows have no ``_i``, so they are neither
    times = both.groupBy(*keys, "_u").agg(F.max_by("_row", "_i").alias("hi"), F.min_by("_row", "_i").alias("lo"), F.bool_or("_asks").alias("asks"))
    path = new_folder(spark, "times")
    times.withColumn("_s", _slice(F.col("_u"), sorted(set(bounds or [])))).write.parquet(path)
    times = spark.read.parquet(path)
    spot = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.col("_u").alias("u"), F.col(c).alias("row")))
    part = Window.partitionBy(*keys, "_s")
    so_far = lambda order: part.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    inside = times.select(*keys, "_s", "_u", "asks", spot("hi").alias("hi"), spot("lo").alias("lo"))
    inside = inside.withColumn("before", F.last("hi", ignorenulls=True).over(so_far(F.asc("_u"))))
    inside = inside.withColumn("after", F.last("lo", ignorenulls=True).over(so_far(F.desc("_u")))).where("asks").drop("hi", "lo")
    has = F.col("hi").isNotNull()
    ends = times.groupBy(*keys, "_s").agg(F.max_by(spot("hi"), F.when(has, F.col("_u"))).alias("hi"), F.min_by(spot("lo"), F.when(has, F.col("_u"))).alias("lo"))
    order = Window.partitionBy(*keys).orderBy("_s") if keys else Window.partitionBy(F.lit(0)).orderBy("_s")
    back = Window.partitionBy(*keys).orderBy(F.desc("_s")) if keys else Window.partitionBy(F.lit(0)).orderBy(F.desc("_s"))
    carried = ends.select(
        *keys,
        "_s",
        F.last("hi", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("earlier"),
        F.last("lo", ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, -1)).alias("later"),
    )
    joined = inside.join(carried, [*keys, "_s"])
    joined = joined.select(*keys, "_u", F.coalesce("before", "earlier").alias("b"), F.coalesce("after", "later").alias("a"))
    use_before = F.col("a").isNull() | (F.col("_u") - F.col("b.u") <= F.col("a.u") - F.col("_u"))
    answers = joined.select(*(F.col(k).alias(f"_a{k}") for k in keys), F.col("_u").alias("_au"), F.when(F.col("b").isNotNull() & use_before, F.col("b")).otherwise(F.col("a")).alias("_c"))
    asked = left.select(F.struct(*left.columns).alias("_l"), *named(), _micros(left, left_time).alias("_u"), F.col(left_time).alias("_t"))
    same = F.col("_u") == F.col("_au")
    for k in keys:
        same = same & (F.col(k) == F.col(f"_a{k}"))
    out = asked.join(answers, same, "left")
    found = F.col("_c.row")
    if tolerance:
        limit = F.expr(f"INTERVAL {tolerance}")
        at = F.col(f"_c.row.{right_time}")
        found = F.when((at >= F.col("_t") - limit) & (at <= F.col("_t") + limit), found)
    return out.select("_l.*", found.alias(name))
