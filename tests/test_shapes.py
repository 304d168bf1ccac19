"""Shapes of several parts, simplified and dissolved rings, and feeds on shared stores."""

import json

import pytest
from pyspark.sql import functions as F

from saltmarsh.functions import text
from saltmarsh.operators import spatial
from saltmarsh.sources import readers
from saltmarsh.streaming import feeds


def square(x, y, side):
    return [[x, y], [x + side, y], [x + side, y + side], [x, y + side], [x, y]]


def test_points_in_multipolygons(spark, tmp_path):
    shape = {"type": "MultiPolygon", "coordinates": [[square(0, 0, 10), square(4, 4, 2)], [square(20, 0, 10)]]}
    features = [{"type": "Feature", "properties": {"name": "two"}, "geometry": shape}, {"type": "Feature", "properties": {"name": "none"}, "geometry": None}]
    (tmp_path / "a.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    regions = readers.geojson(spark, str(tmp_path), "name: string")
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, 5.0, 5.0), (3, 25.0, 5.0), (4, 15.0, 5.0), (5, None, 1.0)], "id int, x double, y double")
    found = spatial.join_points(points, regions.select("name", "rings"), "x", "y", 5.0)
    assert sorted((r["id"], r["name"]) for r in found.collect()) == [(1, "two"), (3, "two")]


def test_kml_shapes(spark, tmp_path):
    ring = "<LinearRing><coordinates>0,0 4,0 4,4 0,0</coordinates></LinearRing>"
    polygon = f"<Polygon><outerBoundaryIs>{ring}</outerBoundaryIs><innerBoundaryIs>{ring}</innerBoundaryIs><innerBoundaryIs>{ring}</innerBoundaryIs></Polygon>"
    marks = [f"<name>a</name>{polygon}", "<name>b</name><Point><coordinates> 1,2,3 </coordinates></Point>", f"<name>c</name><MultiGeometry><Point><coordinates>5,6</coordinates></Point>{polygon}{polygon}</MultiGeometry>", "<name>d</name>"]
    (tmp_path / "a.kml").write_text("<kml><Document>" + "".join(f"<Placemark>{m}</Placemark>" for m in marks) + "</Document></kml>")
    found = {r["name"]: (r["longitude"], r["latitude"], r["rings"] and [len(x) for x in r["rings"]]) for r in readers.kml_shapes(spark, str(tmp_path)).collect()}
    assert found == {"a": (None, None, [4, 4, 4]), "b": (1.0, 2.0, None), "c": (5.0, 6.0, [4] * 6)}
    assert {r["name"] for r in readers.kml_polygons(spark, str(tmp_path)).collect()} == {"a", "c"}


def test_simplified_rings(spark):
    ring = [(0.0, 0.0), (1.0, 0.01), (2.0, 0.0), (2.0, 2.0), (1.0, 2.5), (0.0, 2.0), (0.0, 0.0)]
    df = spark.createDataFrame([(1, [ring, []]), (2, None)], f"id int, rings {spatial.RINGS}")
    got = {r["id"]: r["s"] for r in df.select("id", spatial.simplified(F.col("rings"), 0.1).alias("s")).collect()}
    assert [tuple(p) for p in got[1][0]] == [p for p in ring if p != (1.0, 0.01)] and got[1][1] == [] and got[2] is None
    assert spatial.dissolved(df.where("false"), ["id"]).count() == 0


def test_dissolved_regions(spark):
    df = spark.createDataFrame([("a", [[(float(x), float(y)) for x, y in square(k, 0, 1)]]) for k in range(3)] + [("b", [[(0.0, 0.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0)]])], f"k string, rings {spatial.RINGS}")
    assert {r["k"]: len(r["edges"]) for r in spatial.dissolved(df, ["k"]).collect()} == {"a": 8, "b": 3}


def test_changes_of_a_feed(spark, tmp_path):
    folder, out, offsets = tmp_path / "polls", str(tmp_path / "out"), str(tmp_path / "offsets")
    folder.mkdir()

    def poll(name, cursor):
        (folder / name).write_text(cursor)
        feeds.changes(spark, str(folder)).writeStream.format("parquet").option("path", out).option("checkpointLocation", offsets).trigger(availableNow=True).start().awaitTermination()
        return sorted(r["cursor"] for r in spark.read.schema("cursor string").parquet(out).collect())

    assert poll("1", "2024-01-01\n") == ["2024-01-01"]
    assert poll("2", "2024-01-01\n") == ["2024-01-01"]
    assert poll("3", "2024-01-02\n") == ["2024-01-01", "2024-01-02"]


def test_paged_and_raw(spark, tmp_path):
    for k in (0, 10):
        (tmp_path / f"page-{k}.json").write_text(json.dumps([{"a": i} for i in range(k, k + 10)]))
    assert readers.paged(spark, str(tmp_path), "a long", 20, 10).count() == 20 and readers.paged(spark, str(tmp_path), "a long", 0).count() == 0
    with pytest.raises(Exception, match="page-20"):
        readers.paged(spark, str(tmp_path), "a long", 21, 10).count()
    raw = str(tmp_path / "raw")
    for n in (1, 2):  # each call gives its own copies, and the table keeps all
        assert readers.landed(spark, f"{tmp_path}/page-*.json", raw).count() == 2
        assert spark.read.parquet(raw).count() == 2 * n


def test_list_after_header(spark):
    pages = [("<h2>A</h2><p>x</p><ul><li>one</li><li>t<b>w</b>o</ul><ul><li>no</li></ul>",), ("<h2>B</h2><ul><li>one</li></ul>",), ("<h2>A</h2>",), (None,)]
    found = [r[0] for r in spark.createDataFrame(pages, "h string").select(text.list_after_header(F.col("h"), "a")).collect()]
    assert found == [["one", "two"], None, None, None]
