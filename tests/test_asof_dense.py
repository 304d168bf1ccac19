"""As-of joins where time is dense: brute force, slices, and no window that looks at all rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from saltmarsh.operators.asof import _slice, asof_nearest

T0 = datetime(2024, 1, 1)


def brute(left, right, by):
    out = {}
    for i, k, t in left:
        best = None
        for j, k2, t2 in right:
            if t is None or t2 is None or by and (k is None or k != k2):
                continue
            before = t2 <= t
            rank = (abs((t2 - t).total_seconds()), not before, -j if before else j)
            best = min(best, (rank, j)) if best else (rank, j)
        out[i] = best and best[1]
    return out


@pytest.mark.parametrize("seed, by, spread", [(1, False, 900), (2, True, 900), (3, False, 3), (4, True, 40), (5, False, 10**9)])
def test_all_rows_in_little_time(spark, seed, by, spread):
    """Microseconds of one second, most rows at a few times, and rows years apart."""
    rnd = random.Random(seed)
    time = lambda: None if rnd.random() < 0.05 else T0 + timedelta(microseconds=rnd.randrange(spread) if rnd.random() < 0.9 else rnd.randrange(10**13))
    key = lambda: rnd.choice(["a", "b", "c", None])
    left, right = [(i, key(), time()) for i in range(400)], [(j, key(), time()) for j in range(150)]
    a, b = spark.createDataFrame(left, "id int, k string, t timestamp_ntz").withColumn("lo", F.lit(0)), spark.createDataFrame(right, "rid int, k string, rt timestamp_ntz").withColumn("_u", F.lit(0)).drop("_u")
    for slices in (None, 1, 37):
        found = asof_nearest(a, b, "t", "rt", "rid", by=["k"] if by else None, slices=slices)
        assert {r["id"]: r["nearest"] and r["nearest"]["rid"] for r in found.collect()} == brute(left, right, by)
        assert found.columns == ["id", "k", "t", "lo", "nearest"]


def test_dense_rows_are_dealt_evenly(spark):
    """A hundred thousand rows of one second lie in slices of like size."""
    times = spark.range(100_000).select(F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("id") * 10).alias("t"), "id")
    bounds = sorted(times.agg(F.percentile_approx(F.unix_micros("t"), [k / 32 for k in range(1, 32)], 1000)).first()[0])
    sizes = [r["count"] for r in times.groupBy(_slice(F.unix_micros("t"), bounds).alias("s")).count().collect()]
    assert len(sizes) == 32 and max(sizes) < 2 * min(sizes)


def test_slices(spark):
    for n in (1, 2, 3, 7, 16, 50):
        bounds = [10 * k for k in range(n)]
        rows = spark.range(-5, 10 * n + 5).select("id", _slice(F.col("id"), bounds).alias("s")).collect()
        assert all(r["s"] == sum(b <= r["id"] for b in bounds) for r in rows)


def test_windows_look_back_only(spark):
    a = spark.createDataFrame([(1, T0)], "id int, t timestamp_ntz")
    plan = asof_nearest(a, a.withColumnsRenamed({"id": "rid", "t": "rt"}), "t", "rt", "rid")._jdf.queryExecution().executedPlan().toString()
    assert "unboundedfollowing" not in plan.lower() and "NestedLoop" not in plan
