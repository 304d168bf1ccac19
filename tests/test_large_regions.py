"""Regions of very many corners: what one task holds, and points in them by brute force."""

import math
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from saltmarsh.operators import spatial, topology


def star(n, turn=0.0, size=30.0):
    at = [(size * (0.55 + 0.45 * (k % 2)) * math.cos(2 * math.pi * k / n + turn), size * (0.55 + 0.45 * (k % 2)) * math.sin(2 * math.pi * k / n + turn)) for k in range(n)]
    return [{"x": x, "y": y} for x, y in [*at, at[0]]]


def odd(rings, x, y):
    ax, ay, bx, by = (np.concatenate([[p[c] for p in (r[1:] if end else r[:-1])] for r in rings]) for end in (0, 1) for c in "xy")
    with np.errstate(divide="ignore", invalid="ignore"):
        return bool(np.count_nonzero(((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / (by - ay) + ax)) % 2)


def test_points_meet_only_the_sides_at_their_height(spark):
    rings = {"star": [star(800), star(200, 0.1, 9.0)], "turned": [star(300, 0.3)], "small": [star(10)]}
    regions = spark.createDataFrame(list(rings.items()), f"g string, rings {spatial.RINGS}")
    rng = np.random.default_rng(5)
    places = [(float(x), float(y)) for x, y in rng.uniform(-35, 35, (300, 2))]
    corners = [(p["x"], p["y"]) for r in rings["star"] for p in r[:20]]
    points = spark.createDataFrame(places + corners, "x double, y double")
    for cell in (10.0, 100.0):
        found = {(r["x"], r["y"], r["g"]) for r in spatial.join_points(points, regions, "x", "y", cell).select("x", "y", "g").collect()}
        assert {f for f in found if f[:2] in set(places)} == {(x, y, g) for x, y in places for g, r in rings.items() if odd(r, x, y)}
        assert not any((*c, "star") in found for c in corners)
        touched = {(r["x"], r["y"], r["g"]) for r in spatial.join_points(points, regions, "x", "y", cell, spatial.intersects).select("x", "y", "g").collect()}
        assert found <= touched and all((*c, "star") in touched for c in corners)
    found = spatial.join_points(points.limit(5), regions, "x", "y", 10.0)
    assert found.columns == ["x", "y", "g", "rings"]


def test_rows_are_short_however_many_corners_a_region_has():
    tall = [{"x": float(k % 2), "y": k / 2} for k in range(20_000)]
    tall += [{"x": 5.0, "y": 9_999.5}, {"x": 5.0, "y": 0.0}, tall[0]]
    pieces = spatial._rows_of(pa.array([tall], spatial._listed(np.zeros(1), pa.array([], spatial._POINT)).type), 10.0).to_pylist()
    assert len(pieces) >= 1000 and max(len(p["rings"]) for p in pieces) <= 30


def test_boundary_of_many_sides_takes_little_memory():
    n = 60_000  # squares apart from one another, and one around a hole
    x = np.repeat(np.arange(n) * 2.0, 4)
    square = np.array([(0, 0), (1, 0), (1, 1), (0, 1)], float)
    a = np.stack([x, np.zeros(4 * n)], 1) + np.tile(square, (n, 1))
    b = np.stack([x, np.zeros(4 * n)], 1) + np.tile(np.roll(square, -1, 0), (n, 1))
    outer, hole = np.array([(-9, -9), (-3, -9), (-3, -3), (-9, -3)], float), np.array([(-7, -7), (-7, -5), (-5, -5), (-5, -7)], float)
    a, b = np.concatenate([a, outer, hole]), np.concatenate([b, np.roll(outer, -1, 0), np.roll(hole, -1, 0)])
    point = lambda p: pa.StructArray.from_arrays([pa.array(p[:, 0]), pa.array(p[:, 1])], names=["x", "y"])
    edges = pa.StructArray.from_arrays([point(a), point(b)], names=["a", "b"])
    tracemalloc.start()
    rings = topology._boundary(edges)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 600 * len(edges)
    assert len(rings[0]) == n + 2 and {len(r) for r in rings[0].as_py()} == {5}
    assert rings[0][1].as_py()[0] == {"x": -7.0, "y": -7.0}


def test_short_and_long_rings_are_simplified_alike(spark):
    rng = np.random.default_rng(3)
    rings = [[[{"x": float(x), "y": float(y)} for x, y in np.concatenate([p, p[:1]])]] for p in (rng.uniform(0, 9, (n, 2)) for n in (3, 7, 38, 39, 90))] + [None, [], [[], [{"x": 1.0, "y": 2.0}]]]

    def kept(ring, tolerance):
        keep, parts = {0, len(ring) - 1}, [(0, len(ring) - 1)]
        while parts:
            a, b = parts.pop()
            if b - a < 2:
                continue
            x, y = np.array([p["x"] for p in ring[a : b + 1]]), np.array([p["y"] for p in ring[a : b + 1]])
            length = np.hypot(x[-1] - x[0], y[-1] - y[0])
            away = np.abs((x[-1] - x[0]) * (y - y[0]) - (y[-1] - y[0]) * (x - x[0])) / length if length else np.hypot(x - x[0], y - y[0])
            far = int(away[1:-1].argmax()) + 1
            if away[far] > tolerance:
                keep.add(a + far)
                parts += [(a, a + far), (a + far, b)]
        return [ring[k] for k in sorted(keep)]

    df = spark.createDataFrame(list(enumerate(rings)), f"k int, rings {spatial.RINGS}").coalesce(1)
    found = {r["k"]: r["s"] for r in df.select("k", spatial.simplified(F.col("rings"), 1.0).alias("s")).collect()}
    for k, given in enumerate(rings):
        want = None if given is None else [kept(r, 1.0) if r else [] for r in given]
        assert (found[k] and [[p.asDict() for p in r] for r in found[k]]) == (want or found[k])
    assert spatial._kept_corners([0.0, 1.0, 2.0], [0.0, 0.5, 0.0], 0, 2, 0.6) == [0, 2]
