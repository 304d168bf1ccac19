"""Regions that share borders: unions as closed rings, and borders simplified once for both neighbours.

Regions are rows with ``rings`` as in ``spatial``: array<array<struct<x, y>>>, closed, in any direction; inside is where a
line crosses them an odd number of times. Several polygons, and their holes, may stand one after another.

Sides are rows, so a group's inner sides never meet in one place: they are split, compared and dropped in equi-joins on
grid cells and in aggregations. Only the sides of a group's outer boundary, which are one value of the result, come together.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import new_folder
from .spatial import RINGS, _kept_corners, intersects, join_points

_POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])
_RINGS = pa.list_(pa.list_(_POINT))


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table on the shared folder, where several steps read it."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _point(x: Column, y: Column) -> Column:
    # -0.0 and 0.0 are one place
    return F.struct((x + 0.0).alias("x"), (y + 0.0).alias("y"))


def sides(regions: DataFrame, *keep: str) -> DataFrame:
    """(keep..., ring, side, a, b): a row for each side, from a to b, numbered from 0; sides without length are left out."""
    rings = regions.select(*keep, F.posexplode("rings").alias("ring", "_points")).where(F.size("_points") > 1)
    count = F.size("_points")
    steps = F.transform(F.sequence(F.lit(1), count - 1), lambda i: F.struct(F.get("_points", i - 1).alias("a"), F.get("_points", i).alias("b")))
    out = rings.select(*keep, "ring", F.posexplode(steps).alias("side", "_s"))
    point = lambda p: _point(F.col(f"_s.{p}.x"), F.col(f"_s.{p}.y")).alias(p)
    return out.select(*keep, "ring", "side", point("a"), point("b")).where("a <> b")


#: Maps often lie on a grid of their own; the cells' borders are moved off its lines, in parts of a cell.
SHIFT = 0.37


def _cells(df: DataFrame, cell: float, spare: float = 0.0) -> DataFrame:
    """A row for each grid cell (_cx, _cy) that a side passes, or comes near by ``spare``."""
    margin = cell * 0.01 + spare
    index = lambda c: F.floor(c / cell + SHIFT)
    low, high = F.least("a.x", "b.x"), F.greatest("a.x", "b.x")
    dx, dy = F.col("b.x") - F.col("a.x"), F.col("b.y") - F.col("a.y")
    out = df.withColumn("_cx", F.explode(F.sequence(index(low - margin), index(high + margin))))
    # the side's part between the column's borders, and a hundredth of a cell more against rounding
    at = lambda x: F.when(dx != 0, F.col("a.y") + dy * F.greatest(F.lit(0.0), F.least(F.lit(1.0), (x - F.col("a.x")) / F.nullif(dx, F.lit(0.0)))))
    y1, y2 = at((F.col("_cx") - SHIFT) * cell - margin), at((F.col("_cx") + (1 - SHIFT)) * cell + margin)
    lower, upper = F.coalesce(F.least(y1, y2), F.least("a.y", "b.y")) - margin, F.coalesce(F.greatest(y1, y2), F.greatest("a.y", "b.y")) + margin
    return out.withColumn("_cy", F.explode(F.sequence(index(lower), index(upper))))


def _cell_size(all_sides: DataFrame) -> float:
    """Twice the mean extent of a side, so that a side lies in a few cells and a cell has a few sides."""
    found = all_sides.agg(F.avg(F.greatest(F.abs(F.col("a.x") - F.col("b.x")), F.abs(F.col("a.y") - F.col("b.y"))))).first()[0]
    return 2 * found if found else 1.0


def _meeting(different: DataFrame, cell: float, on: list[str], tolerance: float, *keep: str, asked: str | None = None) -> DataFrame:
    """Pairs of different sides, each with a <= b, that meet elsewhere than in an end of both: the lesser one as a-b and the
    other as c-d, once for each grid cell that both are in. They have ``keep`` (that of c-d under names ending in 2) and

    c_on, d_on, a_on, b_on: whether that corner lies on the other side, and not in its ends; x, y: where they cross, else null.

    With ``asked``, a boolean column of ``keep``, pairs of which neither has it are left out.
    """
    # coordinates are known not to be null, which keeps the code that Spark makes short enough to be compiled
    flat = [F.coalesce(f"{p}.{c}", F.lit(0.0)).alias(f"{p}{c}") for p in "ab" for c in "xy"]
    spare = tolerance + cell * 1e-6
    listed = _cells(different.where(" AND ".join(f"{p}.{c} IS NOT NULL" for p in "ab" for c in "xy")), cell, tolerance)
    one = listed.select(*on, "_cx", "_cy", *keep, *flat)
    one = one.select("*", F.least("ay", "by").alias("low"), (F.greatest("ay", "by") + spare).alias("high"), (F.col("bx") + spare).alias("right"))
    names = {"ax": "cx", "ay": "cy", "bx": "dx", "by": "dy"} | {k: f"{k}2" for k in ("low", "high", "right", *keep)}
    both = one.join(one.withColumnsRenamed(names), [*on, "_cx", "_cy"])
    lesser = F.lit(False)
    for p, q in (("by", "dy"), ("bx", "dx"), ("ay", "cy"), ("ax", "cx")):
        lesser = (F.col(p) < F.col(q)) | ((F.col(p) == F.col(q)) & lesser)
    # boxes apart are told first: these are most pairs, and they never are rows
    both = both.where((F.col("cx") <= F.col("right")) & (F.col("low2") <= F.col("high")) & (F.col("low") <= F.col("high2")) & lesser)
    if asked:
        both = both.where(F.col(asked) | F.col(f"{asked}2"))
    minus = lambda name, p, q: [(F.col(f"{p}{c}") - F.col(f"{q}{c}")).alias(f"_{name}{c}") for c in "xy"]
    steps = [*minus("s", "b", "a"), *minus("t", "d", "c"), *minus("o", "c", "a"), *minus("e", "d", "a"), *minus("f", "b", "c")]
    columns = [*on, *keep, *(f"{k}2" for k in keep), *(p + c for p in "abcd" for c in "xy")]
    cross = lambda p, q: F.col(f"_{p}x") * F.col(f"_{q}y") - F.col(f"_{p}y") * F.col(f"_{q}x")
    along = lambda p, q: F.col(f"_{p}x") * F.col(f"_{q}x") + F.col(f"_{p}y") * F.col(f"_{q}y")
    told = {"c": cross("o", "s"), "d": cross("e", "s"), "a": cross("o", "t"), "b": cross("f", "t"), "turn": cross("s", "t")}
    told |= {"c_along": along("o", "s"), "d_along": along("e", "s"), "a_along": -along("o", "t"), "b_along": along("f", "t"), "ab": along("s", "s"), "cd": along("t", "t")}
    # as a generator's columns these are computed once a pair, and not again in each condition on them
    found = both.select(*columns, *steps).select(*columns, "_sx", "_sy", F.inline(F.array(F.struct(*(v.alias(f"_{k}") for k, v in told.items())))))
    sides_of = {"c": "ab", "d": "ab", "a": "cd", "b": "cd"}
    near = {p: (F.col(f"_{p}") * F.col(f"_{p}") <= F.lit(tolerance * tolerance) * F.col(f"_{q}")) & (F.col(f"_{p}_along") >= 0) & (F.col(f"_{p}_along") <= F.col(f"_{q}")) for p, q in sides_of.items()}
    found = found.select(*columns, "_sx", "_sy", "_turn", "_a", "_c", *(v.alias(f"{p}_at") for p, v in near.items()))
    inner = {p: F.col(f"{p}_at") & ~_same(p, q[0]) & ~_same(p, q[1]) for p, q in sides_of.items()}
    turn = F.nullif("_turn", F.lit(0.0))
    u, v = F.col("_a") / turn, F.col("_c") / turn
    # where a corner touches the other side, that is the place, and not what rounding makes of a crossing
    crosses = ~F.col("c_at") & ~F.col("d_at") & ~F.col("a_at") & ~F.col("b_at") & u.between(0, 1) & v.between(0, 1)
    found = found.where(reduce(or_, inner.values()) | crosses)
    place = [F.when(crosses, F.col(f"a{c}") + F.col(f"_s{c}") * u).alias(c) for c in "xy"]
    return found.select(*columns, *(v.alias(f"{p}_on") for p, v in inner.items()), *place)


def split_sides(all_sides: DataFrame, group: list[str], ids: list[str], cell: float, tolerance: float = 0.0) -> DataFrame:
    """Sides cut where others of their group touch or cross them: (group, ids, step, a, b) for each part, in the
    side's direction; step counts them from 0.

    A corner within ``tolerance`` of a side cuts it, and the part then runs through that corner.
    """
    least, greatest = F.least("a", "b"), F.greatest("a", "b")
    different = all_sides.select(*group, least.alias("a"), greatest.alias("b")).distinct()
    pairs = _meeting(different, cell, group, tolerance)
    at = lambda p: F.struct(F.col(f"{p}x").alias("x"), F.col(f"{p}y").alias("y"))
    place = F.struct("x", "y")
    # each side with the places where it is cut
    cut = lambda p, a, b, where: F.struct(at(a).alias("a"), at(b).alias("b"), p.alias("p"), where.alias("here"))
    crossed = F.col("x").isNotNull()
    all_cuts = [cut(at("c"), "a", "b", F.col("c_on")), cut(at("d"), "a", "b", F.col("d_on")), cut(at("a"), "c", "d", F.col("a_on")), cut(at("b"), "c", "d", F.col("b_on"))]
    all_cuts += [cut(place, "a", "b", crossed), cut(place, "c", "d", crossed)]
    cuts = pairs.select(*group, F.explode(F.filter(F.array(*all_cuts), lambda c: c["here"])).alias("c"))
    cuts = cuts.groupBy(*group, F.col("c.a").alias("_a"), F.col("c.b").alias("_b")).agg(F.collect_set("c.p").alias("_cuts"))
    whole = all_sides.select(*group, *ids, "a", "b", least.alias("_a"), greatest.alias("_b")).join(cuts, [*group, "_a", "_b"], "left")
    along = lambda p: (p["x"] - F.col("a.x")) * (F.col("b.x") - F.col("a.x")) + (p["y"] - F.col("a.y")) * (F.col("b.y") - F.col("a.y"))
    ordered = F.transform(F.sort_array(F.transform("_cuts", lambda p: F.struct(along(p).alias("t"), p.alias("p")))), lambda c: c["p"])
    none = F.expr("cast(array() as array<struct<x:double,y:double>>)")
    through = whole.select(*group, *ids, F.concat(F.array("a"), F.coalesce(ordered, none), F.array("b")).alias("_p"))
    steps = F.transform(F.sequence(F.lit(1), F.size("_p") - 1), lambda i: F.struct(F.get("_p", i - 1).alias("a"), F.get("_p", i).alias("b")))
    parts = through.select(*group, *ids, F.posexplode(steps).alias("step", "_s"))
    return parts.select(*group, *ids, "step", "_s.a", "_s.b").where("a <> b")


def _inside_beside(rings: Column, own: Column) -> Column:
    """struct(left, right): whether the places just left and right of the directed part a-b lie inside the rings.

    A ray leaves the part's middle, upwards or, if the part is steep, to the right, and counts the sides that it crosses. Sides
    in ``own``, array<struct<ring, side>>, are those that the part lies on; they lie beside one end of the ray only.
    """
    a, b = F.col("a"), F.col("b")
    steep = F.abs(b["y"] - a["y"]) > F.abs(b["x"] - a["x"])
    mx, my = (a["x"] + b["x"]) / 2, (a["y"] + b["y"]) / 2
    # along is the coordinate across the ray, up the one in its direction
    across, up = F.when(steep, my).otherwise(mx), F.when(steep, mx).otherwise(my)
    get = lambda p, flip: F.when(steep, p["x"] if flip else p["y"]).otherwise(p["y"] if flip else p["x"])

    def crossed(ring: Column, r: Column) -> Column:
        def one(i: Column) -> Column:
            p, q = F.get(ring, i), F.get(ring, i + 1)
            spans = (get(p, False) > across) != (get(q, False) > across)
            meets = get(p, True) + (get(q, True) - get(p, True)) * (across - get(p, False)) / F.nullif(get(q, False) - get(p, False), F.lit(0.0))
            excluded = F.array_contains(own, F.struct(r.alias("ring"), i.alias("side")))
            return F.when(spans & (meets > up) & ~excluded, 1).otherwise(0)

        at = F.when(F.size(ring) > 1, F.sequence(F.lit(0), F.size(ring) - 2)).otherwise(F.expr("cast(array() as array<int>)"))
        return F.aggregate(F.transform(at, one), F.lit(0), lambda acc, v: acc + v)

    total = F.aggregate(F.transform(rings, lambda ring, r: crossed(ring, r)), F.lit(0), lambda acc, v: acc + v)
    beyond = total % 2 == 1
    before = (total + F.size(own)) % 2 == 1
    # the ray goes left of a part that runs right, and right of one that runs up
    beyond_is_left = F.when(steep, b["y"] < a["y"]).otherwise(b["x"] > a["x"])
    return F.struct(F.when(beyond_is_left, beyond).otherwise(before).alias("left"), F.when(beyond_is_left, before).otherwise(beyond).alias("right"))


def _walked(start: list[int], end: list[int], corners: np.ndarray) -> list[list[int]]:
    """Closed rings of directed edges with the inside on their left: shells counter-clockwise, holes clockwise.

    Edges are pairs of numbers of ``corners`` in order. At a corner with several ways on, the walk takes the first one clockwise from
    where it came, so parts that meet in a corner only are rings of their own; a ring that comes back to a corner is cut there.
    """
    first = np.searchsorted(start, np.arange(len(corners) + 1)).tolist()
    used, at, rings = bytearray(len(start)), [-1] * len(corners), []
    for e, a in enumerate(start):
        if used[e]:
            continue
        used[e], at[a] = 1, 0
        path, before, here = [a], a, end[e]
        while True:
            k = at[here]
            if k >= 0:  # a loop is closed
                rings.append([*path[k:], here])
                for p in path[k + 1 :]:
                    at[p] = -1
                del path[k + 1 :]
                if k == 0:
                    break
            else:
                at[here] = len(path)
                path.append(here)
            ways = [w for w in range(first[here], first[here + 1]) if not used[w]]
            if not ways:
                raise ValueError(f"the boundary is open at {(corners[here].real, corners[here].imag)}")
            following = ways[0]
            if len(ways) > 1:
                c = complex(corners[here])
                angle = lambda p: math.atan2(corners[p].imag - c.imag, corners[p].real - c.real)
                back = angle(before)
                following = min(ways, key=lambda w: (back - angle(end[w])) % (2 * math.pi) or 2 * math.pi)
            used[following] = 1
            before, here = here, end[following]
        at[a] = -1
    return [r for r in rings if len(r) > 3]


def _holds(x: np.ndarray, y: np.ndarray, px: float, py: float) -> bool:
    ax, ay, bx, by = x[:-1], y[:-1], x[1:], y[1:]
    k = np.flatnonzero((ay > py) != (by > py))
    return bool(np.count_nonzero(px < (bx[k] - ax[k]) * (py - ay[k]) / (by[k] - ay[k]) + ax[k]) % 2)


def _arranged(rings: list[list[int]], corners: np.ndarray) -> list[list[int]]:
    """Each shell, by its least corner, with its holes behind it."""
    if not rings:
        return []
    at = np.cumsum([0, *map(len, rings)])
    p = corners[np.fromiter((c for r in rings for c in r), np.int64, at[-1])]
    x, y = p.real, p.imag
    dx, dy = x - np.repeat(x[at[:-1]], np.diff(at)), y - np.repeat(y[at[:-1]], np.diff(at))  # about a corner, for precision
    # from a ring's last corner to the next ring's first there is no side
    cross = np.append(dx[:-1] * dy[1:] - dx[1:] * dy[:-1], 0.0)
    cross[at[1:] - 1] = 0.0
    area = np.add.reduceat(cross, at[:-1]) / 2
    least = np.fromiter(map(min, rings), np.int64, len(rings))
    by_corner = np.argsort(least, kind="stable")
    shells = by_corner[area[by_corner] > 0]
    holes: dict[int, list] = {}
    inner = by_corner[area[by_corner] < 0]
    if len(inner) and len(shells):
        x0, x1, y0, y1 = (f.reduceat(v, at[:-1])[shells] for v in (x, y) for f in (np.minimum, np.maximum))
        # shells are listed in rows as high as they are on average
        height = (y1 - y0).mean()
        low = np.floor(y0 / height)
        count = (np.floor(y1 / height) - low).astype(np.int64) + 1
        shell = np.repeat(np.arange(len(shells)), count)
        row = np.arange(len(shell)) - np.repeat(np.cumsum(count) - count, count) + low[shell]
        order = np.argsort(row, kind="stable")
        shell, row = shell[order], row[order]
    for h in inner.tolist():
        a, b = complex(p[at[h]]), complex(p[at[h] + 1])
        length = abs(b - a)
        # a place just left of a side of the hole is inside its shell; a corner might be on one
        mx, my = ((a.real + b.real) / 2 - (b.imag - a.imag) * 1e-9, (a.imag + b.imag) / 2 + (b.real - a.real) * 1e-9) if length else (a.real, a.imag)
        around = -1
        if len(shells):
            here = np.floor(my / height)
            near = shell[np.searchsorted(row, here) : np.searchsorted(row, here, "right")]
            near = near[(x0[near] <= mx) & (mx <= x1[near]) & (y0[near] <= my) & (my <= y1[near]) & (area[shells[near]] > -area[h])]
            near = near[np.lexsort((near, area[shells[near]]))]
            around = next((int(k) for k in near if _holds(x[at[shells[k]] : at[shells[k] + 1]], y[at[shells[k]] : at[shells[k] + 1]], mx, my)), -1)
        holes.setdefault(around, []).append(rings[h])
    out = list(holes.get(-1, []))
    for k, r in enumerate(shells.tolist()):
        out += [rings[r], *holes.get(k, [])]
    return out


def _boundary(edges: pa.Array) -> pa.Array:
    """The rings of one boundary, as an array of one value."""
    ends = [pa.compute.struct_field(edges, [p, c]).to_numpy(zero_copy_only=False) for p in "ab" for c in "xy"]
    n = len(edges)
    both = np.empty(2 * n, np.complex128)
    both.real, both.imag = np.concatenate([ends[0], ends[2]]), np.concatenate([ends[1], ends[3]])
    # corners are numbered by x, then y
    corners, number = np.unique(both, return_inverse=True)
    start, end = number[:n], number[n:]
    order = np.lexsort((end, start))
    rings = _arranged(_walked(start[order].tolist(), end[order].tolist(), corners), corners)
    at = np.cumsum([0, *map(len, rings)])
    found = corners[np.fromiter((c for r in rings for c in r), np.int64, at[-1])]
    points = pa.StructArray.from_arrays([pa.array(found.real), pa.array(found.imag)], fields=list(_POINT))
    parts = pa.ListArray.from_arrays(pa.array(at, pa.int32()), points)
    return pa.ListArray.from_arrays(pa.array([0, len(parts)], pa.int32()), parts)


def rings_of(edges: Column) -> Column:
    """Rings of a boundary: array<struct<a, b>> of directed sides, the inside on their left. Shells run counter-clockwise,
    each followed by its holes, which run clockwise. An open boundary is an error. Arrow batches, a boundary at a time.
    """

    @F.arrow_udf(RINGS)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            none = pa.array([], column.type.value_type)
            yield pa.concat_arrays([_boundary(v.values if v.is_valid else none) for v in column])

    return run(edges)


def union(regions: DataFrame, by: list[str], cell: float | None = None, tolerance: float = 0.0) -> DataFrame:
    """(by, rings): the union of each group's regions as closed rings; nothing for a group without area.

    Regions may share whole sides or parts of them, overlap, lie inside one another or apart. 1. Sides are cut where
    another of the group touches or crosses them. 2. Equal parts become one. 3. Each part meets the regions whose box has
    it, by grid cells; it is on the boundary if just one of its two sides is inside some region. 4. What is left, the inside
    on its left, is walked into rings. ``cell``: the side of a grid cell, by default from the sides' mean; ``tolerance``: how
    near a corner must be to a side to cut it, for neighbours whose corners are not exactly on each other's sides.
    Regions without rings count for nothing; rows that are equal count once; null keys form a group.
    """
    keys = [f"_k{i}" for i in range(len(by))]
    given = regions.select(*(F.col(c).alias(k) for c, k in zip(by, keys)), "rings").where(F.size("rings") > 0)
    named = _kept(given.withColumn("_id", F.monotonically_increasing_id()), "regions")
    # nulls as values, so that they can be joined on
    whole = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}) if keys else F.lit("")
    named = named.withColumn("_g", whole)
    all_sides = _kept(sides(named, "_g", "_id"), "sides")
    cell = cell or _cell_size(all_sides)
    parts = split_sides(all_sides, ["_g"], ["_id", "ring", "side"], cell, tolerance)
    either = parts.select("_g", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.struct("_id", F.struct("ring", "side").alias("at")).alias("own"))
    once = either.groupBy("_g", "a", "b").agg(F.collect_set("own").alias("own"))
    corners = F.flatten("rings")
    xs, ys = F.transform(corners, lambda p: p["x"]), F.transform(corners, lambda p: p["y"])
    boxes = named.select("_g", "_id", "rings", F.array_min(xs).alias("_x0"), F.array_max(xs).alias("_x1"), F.array_min(ys).alias("_y0"), F.array_max(ys).alias("_y1"))
    wide = boxes.agg(F.avg(F.greatest(F.col("_x1") - F.col("_x0"), F.col("_y1") - F.col("_y0")))).first()[0] or cell
    index = lambda c: F.floor(c / wide)
    listed = boxes.withColumn("_cx", F.explode(F.sequence(index(F.col("_x0") - tolerance), index(F.col("_x1") + tolerance))))
    listed = listed.withColumn("_cy", F.explode(F.sequence(index(F.col("_y0") - tolerance), index(F.col("_y1") + tolerance))))
    mx, my = (F.col("a.x") + F.col("b.x")) / 2, (F.col("a.y") + F.col("b.y")) / 2
    placed = once.withColumns({"_cx": index(mx), "_cy": index(my)})
    met = placed.join(listed, ["_g", "_cx", "_cy"]).where(mx.between(F.col("_x0") - tolerance, F.col("_x1") + tolerance) & my.between(F.col("_y0") - tolerance, F.col("_y1") + tolerance))
    own = F.transform(F.filter("own", lambda o: o["_id"] == F.col("_id")), lambda o: o["at"])
    beside = met.select("_g", "a", "b", _inside_beside(F.col("rings"), own).alias("in"))
    judged = beside.groupBy("_g", "a", "b").agg(F.bool_or("in.left").alias("left"), F.bool_or("in.right").alias("right")).where("left <> right")
    directed = judged.select("_g", F.when(F.col("left"), F.struct("a", "b")).otherwise(F.struct(F.col("b").alias("a"), F.col("a").alias("b"))).alias("e"))
    rings = directed.groupBy("_g").agg(F.collect_list("e").alias("edges")).select("_g", rings_of(F.col("edges")).alias("rings"))
    back = named.select("_g", *keys).dropDuplicates(["_g"])
    return rings.join(back, "_g").select(*(F.col(k).alias(c) for k, c in zip(keys, by)), "rings")


def _arcs(rings: pa.Array) -> pa.Array:
    """Each ring's corners in order, with whether they are junctions, cut there: points of each arc, and whether it runs
    against the arc's own direction, which is the same wherever the arc occurs.
    """
    at = np.append(0, np.cumsum(pa.compute.list_value_length(rings).to_numpy(zero_copy_only=False)))
    corners = rings.flatten()
    x, y, junction = (pa.compute.struct_field(corners, c).to_numpy(zero_copy_only=False) for c in ("x", "y", "junction"))
    size = np.diff(at)
    ring = np.repeat(np.arange(len(size)), size)
    whole = np.flatnonzero(np.bincount(ring[junction], minlength=len(size)) == 0)
    # an island, or a hole that one region fills: from its least corner on
    least = [at[r] + np.lexsort((y[at[r] : at[r + 1]], x[at[r] : at[r + 1]]))[0] for r in whole]
    cuts = np.sort(np.append(np.flatnonzero(junction), np.array(least, np.int64)))
    count = np.bincount(ring[cuts], minlength=len(size))
    ends = np.append(0, np.cumsum(count))
    # each arc runs to the next cut of its ring, the last one to the ring's first
    steps = np.append(cuts[1:], 0) - cuts
    steps[ends[1:] - 1] = cuts[ends[:-1]] + size - cuts[ends[1:] - 1]
    arc = np.repeat(np.arange(len(cuts)), steps + 1)
    first = np.append(0, np.cumsum(steps + 1))
    place = np.arange(len(arc)) - first[arc]

    def corner(k: np.ndarray, arc: np.ndarray) -> np.ndarray:
        r = ring[cuts[arc]]
        return at[r] + (cuts[arc] - at[r] + k) % size[r]

    every = np.arange(len(cuts))
    a, b = corner(0 * steps, every), corner(steps, every)
    flipped = (x[b] < x[a]) | ((x[b] == x[a]) & (y[b] < y[a]))
    for k in np.flatnonzero((x[a] == x[b]) & (y[a] == y[b])).tolist():  # closed, so its second and last but one corner tell, or those behind them
        p = corner(np.arange(steps[k] + 1), np.full(steps[k] + 1, k))
        points = list(zip(x[p].tolist(), y[p].tolist()))
        flipped[k] = points[::-1] < points
    p = corner(np.where(flipped[arc], steps[arc] - place, place), arc)
    points = pa.StructArray.from_arrays([pa.array(x[p]), pa.array(y[p])], fields=list(_POINT))
    arcs = [pa.ListArray.from_arrays(pa.array(first, pa.int32()), points), pa.array(flipped, pa.bool_())]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(arcs, names=["points", "flipped"]))


def arcs_of(ring: Column) -> Column:
    """array<struct<points, flipped>> from array<struct<..., x, y, junction>>, which has corners. Arrow batches."""

    @F.arrow_udf("array<struct<points:array<struct<x:double,y:double>>,flipped:boolean>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield _arcs(column)

    return run(ring)


def _kept_places(x: list[float], y: list[float], first: int, n: int, tolerance: float) -> list[int]:
    """Places of an arc's n corners, from ``first`` on in x and y, that are kept; a closed arc keeps three different ones at least."""
    last = first + n - 1
    if tolerance <= 0 or n < 3:
        return list(range(n))
    if (x[first], y[first]) != (x[last], y[last]):
        return [k - first for k in _kept_corners(x, y, first, last, tolerance)]
    far = max(range(first, last + 1), key=lambda k: math.dist((x[first], y[first]), (x[k], y[k])))
    kept = sorted({*_kept_corners(x, y, first, far, tolerance), *_kept_corners(x, y, far, last, tolerance)})
    if len(kept) < 4:
        x0, y0, x1, y1 = x[first], y[first], x[far], y[far]
        third = max(range(first, last + 1), key=lambda k: abs((x1 - x0) * (y[k] - y0) - (y1 - y0) * (x[k] - x0)))
        kept = sorted({*kept, third})
    return [k - first for k in kept]


def _places(points: Column, tolerance: Column) -> Column:
    @F.arrow_udf("array<int>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for arcs, limits in batches:
            x, y = (c.to_numpy(zero_copy_only=False).tolist() for c in arcs.flatten().flatten())
            at, kept, ends = 0, [], [0]
            for n, t in zip(pa.compute.list_value_length(arcs).to_pylist(), limits.to_pylist()):
                kept += _kept_places(x, y, at, n, t)
                at += n
                ends.append(len(kept))
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(kept, pa.int32()))

    return run(points, tolerance)


#: An arc in conflict with another gets a quarter of its tolerance, so many times; then all its corners.
QUARTERS = 4


def simplified_together(regions: DataFrame, tolerance: float, cell: float | None = None) -> DataFrame:
    """``regions`` with fewer corners, all within ``tolerance`` of what is left, and borders that still fit.

    1. Sides are cut where a neighbour's corner touches them. 2. Corners in which other than two different sides meet are
    junctions. 3. Between junctions a border is an arc; it is the same arc in both neighbours, is simplified once, and takes
    its place in both, so neighbours neither gap nor overlap. 4. An arc whose new sides cross or touch others, or sweep over
    a corner that is left of others, gets less tolerance, and at last all its corners, until none does. So rings stay simple
    and islands stay on their side. Junctions never move.

    Other columns pass through; regions whose rings are null or empty are as they were. Rings have one direction each, as
    given, and may start at another corner.
    """
    columns = regions.columns
    named = _kept(regions.withColumn("_id", F.monotonically_increasing_id()), "regions")
    all_sides = _kept(sides(named, "_id"), "sides")
    cell = cell or _cell_size(all_sides)
    parts = _kept(split_sides(all_sides, [], ["_id", "ring", "side"], cell), "parts")
    different = parts.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    ends = different.select("a").unionByName(different.select(F.col("b").alias("a"))).groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    junctions = ends.where("n <> 2").select("a", F.lit(True).alias("_j"))
    corner = F.struct("side", "step", F.col("a.x").alias("x"), F.col("a.y").alias("y"), F.coalesce("_j", F.lit(False)).alias("junction"))
    rings = parts.join(junctions, "a", "left").groupBy("_id", "ring").agg(F.sort_array(F.collect_list(corner)).alias("corners"))
    # with a hash in front of them, points are seldom compared where arcs are sorted
    own = rings.select("_id", "ring", F.posexplode(arcs_of(F.col("corners"))).alias("seq", "arc")).select("_id", "ring", "seq", "arc.points", "arc.flipped")
    own = _kept(own.withColumn("hash", F.xxhash64("points")), "arcs")
    once = own.groupBy("hash", "points").agg(F.min(F.struct("_id", "ring", "seq")).alias("key"))
    arcs = _kept(once.select("key", "hash", "points", F.lit(0).alias("level")), "arcs")
    while True:
        limit = F.when(F.col("level") >= QUARTERS, 0.0).otherwise(tolerance / F.pow(F.lit(4.0), F.col("level")))
        kept = _kept(arcs.withColumn("places", _places(F.col("points"), limit)), "simplified")
        worse = _kept(_conflicts(kept, cell), "conflicts")
        if worse.isEmpty():
            break
        arcs = kept.drop("places").join(worse.withColumn("_worse", F.lit(1)), "key", "left").select("key", "hash", "points", (F.col("level") + F.coalesce("_worse", F.lit(0))).alias("level"))
    placed = own.join(kept.select("hash", "points", "places"), ["hash", "points"])
    points = F.transform("places", lambda k: F.get("points", k))
    turned = F.when(F.col("flipped"), F.reverse(points)).otherwise(points)
    # an arc's last corner is the first one of the next arc
    pieces = placed.select("_id", "ring", F.struct("seq", F.slice(turned, F.lit(1), F.size("places") - 1).alias("p")).alias("piece"))
    open_ = pieces.groupBy("_id", "ring").agg(F.flatten(F.transform(F.sort_array(F.collect_list("piece")), lambda x: x["p"])).alias("p"))
    closed = open_.select("_id", F.struct("ring", F.concat("p", F.slice("p", 1, 1)).alias("p")).alias("r"))
    whole = closed.groupBy("_id").agg(F.transform(F.sort_array(F.collect_list("r")), lambda r: r["p"]).alias("_new"))
    done = named.join(whole, "_id", "left").withColumn("rings", F.coalesce("_new", "rings"))
    return done.select(*columns)


def _same(p: str, q: str) -> Column:
    return (F.col(f"{p}x") == F.col(f"{q}x")) & (F.col(f"{p}y") == F.col(f"{q}y"))


def _conflicts(kept: DataFrame, cell: float) -> DataFrame:
    """(key): arcs that must keep more corners."""
    chains = F.transform(F.sequence(F.lit(1), F.size("places") - 1), lambda i: F.struct(F.get("places", i - 1).alias("s"), F.get("places", i).alias("e")))
    steps = kept.where(F.size("places") > 1).select("key", "points", F.posexplode(chains).alias("k", "c"))
    new = F.col("c.e") - F.col("c.s") > 1
    segments = _kept(steps.select("key", "k", new.alias("new"), F.get("points", F.col("c.s")).alias("a"), F.get("points", F.col("c.e")).alias("b"), F.when(new, F.slice("points", F.col("c.s") + 1, F.col("c.e") - F.col("c.s") + 1)).alias("chain")), "segments")
    least, greatest = F.least("a", "b"), F.greatest("a", "b")
    either = segments.select("key", "k", "new", least.alias("a"), greatest.alias("b"))
    # one row a place, so that segments that two arcs have in common are seen
    several = either.groupBy("a", "b").agg(F.collect_set(F.when(F.col("new"), F.col("key"))).alias("keys"), F.count(F.lit(1)).alias("n"))
    several = _kept(several, "several")
    twice = several.where("n > 1").select(F.explode("keys").alias("key"))
    # sides as given were cut where they meet, so one of a pair is new
    pairs = _meeting(several.select("keys", "a", "b", (F.size("keys") > 0).alias("new")), cell, [], 0.0, "keys", "new", asked="new")
    crossing = pairs.select(F.explode(F.concat("keys", "keys2")).alias("key")).unionByName(twice)
    corners = segments.select(F.explode(F.array("a", "b")).alias("p")).distinct().select("p", F.col("p.x").alias("_x"), F.col("p.y").alias("_y"))
    swept = segments.where("new").select("key", F.col("chain"), F.array(F.concat("chain", F.slice("chain", 1, 1))).alias("rings"))
    # whether it is a corner of the chain itself is asked first, since it costs less
    other = lambda rings, x, y: ~F.array_contains("chain", F.col("p")) & intersects(rings, x, y)
    over = join_points(corners, swept, "_x", "_y", cell, other).select("key")
    return crossing.unionByName(over).distinct()
