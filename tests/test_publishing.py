"""Documents, series and objects as they are published; pages whose number of rows is checked; row numbers; quantiles."""

import json
import math
import os

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saltmarsh.operators import relational as op
from saltmarsh.sources import readers, sinks


def loaded(path):
    (part,) = [n for n in os.listdir(path) if n.startswith("part-")]
    assert not [n for n in os.listdir(path) if n.startswith("_parts")]
    with open(os.path.join(path, part), encoding="utf-8") as f:
        return json.load(f)


def test_document_keeps_order_over_many_tasks(spark, tmp_path):
    path = str(tmp_path / "doc")
    rows = spark.range(200_000, numPartitions=9).where("id >= 30000").select(F.to_json(F.struct("id", F.lit('é "\n').alias("t"))).alias("v"))  # the first task has none
    sinks.document(rows, path, "data", "2024-01-01", type="x")
    found = loaded(path)
    assert [r["id"] for r in found["data"]] == list(range(30_000, 200_000)) and found["type"] == "x" and found["data"][0]["t"] == 'é "\n'
    assert "Window" not in rows._jdf.queryExecution().executedPlan().toString()
    sinks.document(rows.limit(0), path, "data", "2024-01-02")
    assert loaded(path) == {"lastUpdated": "2024-01-02", "data": []}
    sinks.document(spark.createDataFrame([(None,), ("1",)], "v string"), path, "data", "2024-01-03")
    assert loaded(path)["data"] == [1]


def test_series(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, 'q"u,o\nte'), (4, "")], "id int, name string").coalesce(1)
    written = sinks.to_series(df, "name", str(tmp_path / "names"), "2024-01-01")
    assert loaded(written["json"]) == {"lastUpdated": "2024-01-01", "data": ["a", None, 'q"u,o\nte', ""]}
    (part,) = (tmp_path / "names.csv").glob("part-*")
    assert part.read_text().split("\n")[:3] == ["name", "a", '""']
    with pytest.raises(ValueError, match="parquet"):
        sinks.to_series(df, "name", str(tmp_path / "x"), "2024-01-01", ("parquet",))


def test_objects(spark, tmp_path):
    rows = [("a/b.bin", bytearray(b"\x00\xff" * 3)), ("c", None), ("d e.txt", bytearray(b""))]
    df = spark.createDataFrame(rows, "name string, content binary")
    for _ in range(2):  # again: replaced
        put = {r["name"]: r for r in sinks.put_objects(df, str(tmp_path), "name", "content").collect()}
        assert {n: r["length"] for n, r in put.items()} == {"a/b.bin": 6, "c": 0, "d e.txt": 0}
        files = {os.path.relpath(os.path.join(d, n), tmp_path) for d, _, names in os.walk(tmp_path) for n in names}
        assert files == {"a/b.bin", "c", "d e.txt"} and (tmp_path / "a/b.bin").read_bytes() == b"\x00\xff" * 3
    for name in ("../up", "/root", None):
        with pytest.raises(Exception, match="no name"):
            sinks.put_objects(spark.createDataFrame([(name, "x")], "name string, content string"), str(tmp_path), "name", "content")


def test_pages_with_gaps_or_repeats_fail(spark, tmp_path):
    for k, n in ((0, 10), (10, 9)):
        (tmp_path / f"page-{k}.json").write_text(json.dumps([{"a": i} for i in range(n)]))
    with pytest.raises(ValueError, match="19 rows, and not 20"):
        readers.paged(spark, str(tmp_path), "a long", 20, 10)
    assert readers.paged(spark, str(tmp_path), "a long", 19, page=None).count() == 19
    (tmp_path / "more.json").write_text('[{"a": 1}]')
    with pytest.raises(ValueError, match="20 rows, and not 19"):
        readers.paged(spark, str(tmp_path), "a long", 19, page=None)


def test_row_numbers(spark):
    rows = spark.range(5000).select((F.hash("id") % 700).alias("k"), "id").repartition(7)
    found = op.row_numbers(rows, ["k", "id"], "n").collect()
    assert [r["n"] for r in sorted(found, key=lambda r: (r["k"], r["id"]))] == list(range(1, 5001))
    assert op.row_numbers(rows.limit(0), ["k"], "n").count() == 0


SHARES = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1, max_size=60))
def test_quantiles_of_any_numbers(spark, values):
    found = op.exact_quantiles(spark.createDataFrame([(v,) for v in values], "x double"), "x", SHARES)
    expected = [np.quantile(values, s) for s in SHARES]
    assert all(math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-300) for a, b in zip(found, expected))


def test_quantiles_by_narrowing(spark, monkeypatch):
    """Few bins and no short cut, so that the ranks are found by many rounds; values of all sizes, many of them equal."""
    monkeypatch.setattr(op, "BINS", 4)
    monkeypatch.setattr(op, "FEW", 0)
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.exp(F.col("id") % 41 - 20) * F.when(F.col("id") % 2 == 0, 1).otherwise(-1)).alias("x"))
    assert op.exact_quantiles(df, "x", SHARES) == pytest.approx(list(np.quantile([r[0] for r in df.collect()], SHARES)))


def test_quantiles_of_odd_columns(spark):
    inf, nan = float("inf"), float("nan")
    one = lambda *v: op.exact_quantiles(spark.createDataFrame([(x,) for x in v], "x double"), "x", [0.0, 0.5, 1.0])
    assert one() == [None] * 3 and one(None, None) == [None] * 3 and one(None, 2.0) == [2.0] * 3
    assert one(-inf, 1.0, inf) == [-inf, 1.0, inf] and one(1.0, 2.0, nan)[:2] == [1.0, 2.0] and math.isnan(one(1.0, 2.0, nan)[2])
    row = op.describe(spark.createDataFrame([(1,), (2,), (4,), (None,)], "x int"), "x").first()
    assert (row["n"], row["min"], row["p25"], row["p50"], row["p75"], row["max"]) == (3, 1, 1.5, 2.0, 3.0, 4)
    assert op.describe(spark.createDataFrame([], "x double"), "x").first()["n"] == 0
