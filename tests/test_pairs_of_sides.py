"""Sides that meet, and arcs of rings: brute force; and the pairs' code is short enough to be compiled."""

import random
import re

from pyspark.sql import functions as F

from saltmarsh.operators import topology as t

SIDES = "a struct<x:double,y:double>, b struct<x:double,y:double>"


def random_sides(rnd, n, size):
    place = lambda: (float(rnd.randint(0, size)), float(rnd.randint(0, size)))
    return {tuple(sorted((a, b))) for a, b in ((place(), place()) for _ in range(n)) if a != b}


def turn(a, b, p):
    k = (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])
    return (k > 0) - (k < 0)


def test_each_side_is_compared_in_compiled_code(spark, capsys):
    """Java compiles no method of 8,000 bytes or more, and interprets it."""
    rows = [(k, 0, 0, *s) for k, s in enumerate(random_sides(random.Random(5), 40, 9))]
    sides = spark.createDataFrame(rows, f"_id int, ring int, side int, {SIDES}")
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        t.split_sides(sides, [], ["_id", "ring", "side"], 2.0).explain(mode="codegen")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    found = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert found and max(found) < 8000


def test_pairs_that_meet(spark):
    sides = sorted(random_sides(random.Random(3), 150, 12))
    asked = {s for k, s in enumerate(sides) if k % 3 == 0}
    on = lambda p, a, b: p not in (a, b) and turn(a, b, p) == 0 and a <= p <= b
    expected = {}
    for i, (a, b) in enumerate(sides):
        for c, d in sides[i + 1 :]:
            flags = on(c, a, b), on(d, a, b), on(a, c, d), on(b, c, d)
            crosses = turn(a, b, c) * turn(a, b, d) < 0 and turn(c, d, a) * turn(c, d, b) < 0
            if any(flags) or crosses:
                expected[a, b, c, d] = (*flags, crosses)
    df = spark.createDataFrame([(*s, s in asked) for s in sides], f"{SIDES}, new boolean")
    for only in (None, "new"):
        found = {}
        for r in t._meeting(df, 2.5, [], 0.0, "new", asked=only).collect():
            found[tuple((r[f"{p}x"], r[f"{p}y"]) for p in "abcd")] = (r["c_on"], r["d_on"], r["a_on"], r["b_on"], r["x"] is not None)
        assert found == {k: v for k, v in expected.items() if not only or k[:2] in asked or k[2:] in asked}
    ends = [((float(x), float(y)), (x + dx, y + dy)) for x in range(6) for y in range(6) for dx, dy in ((1.0, 0.0), (0.0, 1.0))]
    grid = spark.createDataFrame([(*s, True) for s in ends], f"{SIDES}, new boolean")
    assert t._meeting(grid, 2.0, [], 0.0).count() == 0  # sides that share an end only are no pairs


def test_arcs(spark):
    rnd = random.Random(7)
    rings = []
    for k in range(200):
        points = [(float(rnd.randint(0, 3)), float(rnd.randint(0, 3))) for _ in range(rnd.randint(1, 9))]
        if k % 5 == 0:
            points += points[-2::-1]  # there and back
        rings.append([(x, y, rnd.random() < (0.0, 0.2, 0.6)[k % 3]) for x, y in points])
    df = spark.createDataFrame(list(enumerate(rings)), "k int, r array<struct<x:double,y:double,junction:boolean>>")
    for row in df.select("k", t.arcs_of(F.col("r")).alias("arcs")).collect():
        points = [p[:2] for p in rings[row["k"]]]
        cuts = [k for k, p in enumerate(rings[row["k"]]) if p[2]] or [points.index(min(points))]
        arcs = [[points[k % len(points)] for k in range(a, b + 1)] for a, b in zip(cuts, [*cuts[1:], cuts[0] + len(points)])]
        assert [([tuple(p) for p in a["points"]], a["flipped"]) for a in row["arcs"]] == [(min(p, p[::-1]), p[::-1] < p) for p in arcs]
