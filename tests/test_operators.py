from datetime import date, datetime, timedelta

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saltmarsh.operators import relational as op
from saltmarsh.operators import reshape, spatial
from saltmarsh.operators.asof import asof_nearest
from saltmarsh.operators.transform import transformed

T0 = datetime(2024, 1, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def asof(spark, left, right, **more):
    a = spark.createDataFrame([(i, T0 + timedelta(minutes=m)) for i, m in enumerate(left)], "id int, t timestamp_ntz")
    b = spark.createDataFrame([(i, T0 + timedelta(minutes=m)) for i, m in enumerate(right)], "rid int, rt timestamp_ntz")
    return asof_nearest(a, b, "t", "rt", "rid", **more)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 6000), min_size=1, max_size=30), st.lists(st.integers(0, 6000), min_size=1, max_size=12))
def test_asof_equals_pandas(spark, left, right):
    # pandas takes the last of equal times before and the first after; ours by id, which is the position here
    right = sorted(right)
    a = pd.DataFrame({"id": range(len(left)), "t": [T0 + timedelta(minutes=m) for m in left]}).sort_values("t")
    b = pd.DataFrame({"rid": range(len(right)), "rt": [T0 + timedelta(minutes=m) for m in right]})
    want = pd.merge_asof(a, b, left_on="t", right_on="rt", direction="nearest").set_index("id")["rid"].to_dict()
    assert {r["id"]: r["nearest"]["rid"] for r in asof(spark, left, right).collect()} == want


def test_asof_edges(spark):
    near = lambda left, right, **m: [r["nearest"] and r["nearest"]["rid"] for r in asof(spark, left, right, **m).orderBy("id").collect()]
    assert near([10], []) == [None]
    assert near([10], [5, 15]) == [0]
    assert near([10, 4000], [10, 20]) == [0, 1]
    assert near([10, 4000], [9], tolerance="5 minutes") == [0, None]
    assert "CartesianProduct" not in plan(asof(spark, [1], [2])) and "NestedLoop" not in plan(asof(spark, [1], [2]))


SQUARE = [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)], [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0), (1.0, 1.0)]]


@pytest.mark.parametrize(
    "x, y, inside, touching",
    [(3.0, 3.0, True, True), (5.0, 5.0, False, False), (4.0, 2.0, False, True), (0.0, 0.0, False, True), (1.5, 1.5, False, False), (1.0, 1.5, False, True), (None, 1.0, False, False)],
)
def test_points(spark, x, y, inside, touching):
    points = spark.createDataFrame([(x, y)], "px double, py double")
    regions = spark.createDataFrame([("a", SQUARE)], f"name string, rings {spatial.RINGS}")
    for predicate, want in ((spatial.contains, inside), (spatial.intersects, touching)):
        found = spatial.join_points(points, regions, "px", "py", 1.0, predicate)
        assert (found.count() == 1) is want
        assert "CartesianProduct" not in plan(found) and "NestedLoop" not in plan(found)


def test_weeks_spanned_guards(spark):
    rows = [(date(2024, 1, 3), date(2024, 1, 15)), (date(2024, 1, 5), date(2024, 1, 1)), (date(2024, 1, 5), None)]
    df = spark.createDataFrame(rows, "a date, b date").select(reshape.weeks_spanned(F.col("a"), F.col("b")).alias("w"))
    assert [r["w"] for r in df.collect()] == [[date(2024, 1, 1), date(2024, 1, 8), date(2024, 1, 15)], [], []]


def test_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c")], "k int, v string")
    assert op.grouped(df, ["k"], F.count("v").alias("n")).collect() == [(1, 1)]
    other = spark.createDataFrame([(None, "x"), (1, "y")], "k int, v string")
    assert op.equi_join(df, other, [("k", "k")]).count() == 1
    joined = op.equi_join(df, other, [("k", "k")], null_safe=True)
    assert joined.count() == 3 and joined.columns == ["k", "v", "k_y", "v_y"]
    assert op.last_per_group(df, ["k"], [F.desc("v")]).count() == 1


def test_small_windows_and_fill(spark):
    df = spark.createDataFrame([(1, 5, ""), (2, 6, "x"), (3, None, None)], "i int, n int, p string")
    assert [r["s"] for r in op.rolling_sum(df, "n", ["i"], 3, "s").collect()] == [5, 11, 11]
    filled = op.forward_fill(df.withColumn("g", F.lit(1)), "p", ["g"], ["i"], blank=F.col("p") == "")
    assert [r["p"] for r in filled.orderBy("i").collect()] == [None, "x", "x"]


def test_upsert_and_union(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (2, "d"), (3, "e")], "k int, v string")
    assert sorted(op.upsert(base, new, ["k"], [F.desc("v")]).collect()) == [(1, "a"), (2, "d"), (3, "e")]
    assert op.union_all(base, None, new.drop("v")).count() == 5
    with pytest.raises(ValueError):
        op.drop_columns(base, "nothing")
    with pytest.raises(ValueError):
        op.union_all(None, None)


def test_newer_than_nothing(spark):
    df = spark.createDataFrame([(1,), (2,)], "t int")
    assert op.newer_than(df, "t", df.where("t > 5").agg(F.max("t").alias("m"))).count() == 2
    assert op.newer_than(df, "t", df.where("t = 1").agg(F.max("t").alias("m"))).collect() == [(2,)]


def test_transform_sends_each_text_once(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("",)], "t string")
    assert [r["o"] for r in transformed(df, "t", lambda t: t * 2, "o").collect()] == ["aa", "aa", "", ""]
