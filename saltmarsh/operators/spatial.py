"""Points in polygons by a grid of cells: an equi-join on cells, then an exact test on the candidates.

A region is a row with ``rings``: array<array<struct<x double, y double>>>, each ring closed (last point = first), outer
ring first, holes after it; inside is where a line crosses the rings an odd number of times.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RINGS = "array<array<struct<x:double,y:double>>>"


def _sides(ring: Column, test) -> Column:
    """``test(a, b)`` for each side of a ring."""
    at = F.sequence(F.lit(1), F.greatest(F.size(ring) - 1, F.lit(1)))
    sides = F.transform(at, lambda i: F.struct(F.try_element_at(ring, i.cast("int")).alias("a"), F.try_element_at(ring, (i + 1).cast("int")).alias("b")))
    return F.transform(F.filter(sides, lambda s: s["b"].isNotNull()), lambda s: test(s["a"], s["b"]))


def _crossings(rings: Column, x: Column, y: Column) -> Column:
    def crosses(a: Column, b: Column) -> Column:
        meets = (b["x"] - a["x"]) * (y - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"]
        return F.when(((a["y"] > y) != (b["y"] > y)) & (x < meets), 1).otherwise(0)

    each = F.transform(rings, lambda r: F.aggregate(_sides(r, crosses), F.lit(0), lambda acc, v: acc + v))
    return F.aggregate(each, F.lit(0), lambda acc, v: acc + v)


def on_edge(rings: Column, x: Column, y: Column) -> Column:
    """Whether the point lies on a side or a corner."""

    def touches(a: Column, b: Column) -> Column:
        straight = (b["x"] - a["x"]) * (y - a["y"]) == (b["y"] - a["y"]) * (x - a["x"])
        between = (x >= F.least(a["x"], b["x"])) & (x <= F.greatest(a["x"], b["x"])) & (y >= F.least(a["y"], b["y"])) & (y <= F.greatest(a["y"], b["y"]))
        return straight & between

    return F.exists(rings, lambda r: F.exists(_sides(r, touches), lambda t: t))


def contains(rings: Column, x: Column, y: Column) -> Column:
    """Inside, and not on the boundary."""
    return (_crossings(rings, x, y) % 2 == 1) & ~on_edge(rings, x, y)


def intersects(rings: Column, x: Column, y: Column) -> Column:
    """Inside or on the boundary."""
    return (_crossings(rings, x, y) % 2 == 1) | on_edge(rings, x, y)


#: Regions with more corners than ``WHOLE`` are cut into rows, each of a few times ``ROW_SIDES`` sides at most where sides lie evenly.
WHOLE, ROW_SIDES, HALVINGS = 64, 16, 6
_PIECES = f"array<struct<height:double,row:bigint,cy:bigint,right:double,rings:{RINGS}>>"
_POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])


def _listed(at: np.ndarray, inner: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), inner)


def _rows_of(shape: pa.Array, cell: float) -> pa.Array:
    """A region's sides by rows, each side as a ring of two corners: a fraction of ``cell`` that is a power of two is a row's
    height, so that no row lies in two cells.
    """
    rings = shape.filter(shape.is_valid())
    sizes = np.diff(rings.offsets.to_numpy())
    x, y = (c.to_numpy(zero_copy_only=False) for c in rings.flatten().flatten())
    first = np.ones(len(x), bool)
    first[np.cumsum(sizes)[:-1][np.cumsum(sizes)[:-1] < len(x)]] = False  # no side runs from one ring to the next
    at = np.flatnonzero(first[1:])
    ends = np.stack([np.stack([x[at], y[at]], 1), np.stack([x[at + 1], y[at + 1]], 1)], 1)
    ends = ends[np.isfinite(ends).all(axis=(1, 2))]
    low, high = ends[:, :, 1].min(1), ends[:, :, 1].max(1)
    span = np.floor(high / cell) - np.floor(low / cell) + 1
    rows = np.floor(high.max() / cell) - np.floor(low.min() / cell) + 1 if len(ends) else 1
    halvings = int(np.clip(np.ceil(np.log2(max(span.sum() / rows / ROW_SIDES, 1))), 0, HALVINGS))
    height = cell / 2**halvings
    start, count = np.floor(low / height).astype(np.int64), (np.floor(high / height) - np.floor(low / height)).astype(np.int64) + 1
    side = np.repeat(np.arange(len(ends)), count)
    row = np.arange(len(side)) - np.repeat(np.cumsum(count) - count, count) + start[side]
    order = np.argsort(row, kind="stable")
    side, row = side[order], row[order]
    at = np.flatnonzero(np.diff(row, prepend=row[:1] - 1))
    right = np.maximum.reduceat(ends[side, :, 0].max(1), at) if len(at) else np.empty(0)
    corners = ends[side].reshape(-1, 2)
    points = pa.StructArray.from_arrays([pa.array(corners[:, 0]), pa.array(corners[:, 1])], fields=list(_POINT))
    pieces = _listed(np.append(at, len(side)), _listed(np.arange(0, len(corners) + 1, 2), points))
    columns = [pa.array(np.full(len(at), height)), pa.array(row[at]), pa.array(row[at] >> halvings), pa.array(right), pieces]
    return pa.StructArray.from_arrays(columns, names=["height", "row", "cy", "right", "rings"])


def _rows(rings: Column, cell: float) -> Column:
    """``_rows_of`` for each region; null stays null."""

    @F.arrow_udf(_PIECES)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for shapes in batches:
            if shapes.null_count == len(shapes):
                yield pa.nulls(len(shapes), _listed(np.zeros(1), _rows_of(pa.array([], shapes.type.value_type), cell)).type)
                continue
            done = [_rows_of(s.values if s.is_valid else pa.array([], shapes.type.value_type), cell) for s in shapes]
            at = np.cumsum([0, *map(len, done)])
            yield pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.concat_arrays(done), mask=shapes.is_null())

    return run(rings)


def join_points(points: DataFrame, regions: DataFrame, x: str, y: str, cell: float, predicate=contains) -> DataFrame:
    """Each pair of a point and a region whose ``rings`` satisfy the predicate; points without coordinates match nothing.

    ``cell``: side of a grid cell; near the regions' usual width. A region is listed in each cell of its bounding box, a
    point in one, so the join is an equi-join on cells and a pair is found once. A region of many corners is listed by rows,
    so that a point meets only the sides at its height, which are all that the predicates look at.
    """
    corner = F.flatten("rings")
    xs, ys = F.transform(corner, lambda p: p["x"]), F.transform(corner, lambda p: p["y"])
    box = {"_x0": F.array_min(xs), "_x1": F.array_max(xs), "_y0": F.array_min(ys), "_y1": F.array_max(ys)}
    index = lambda c: F.floor(c / cell)
    boxed = regions.withColumns(box).withColumn("_cut", _rows(F.when(F.size(corner) > WHOLE, F.col("rings")), float(cell)))
    boxed = boxed.select("*", F.explode_outer("_cut").alias("_piece")).drop("_cut")
    cut = F.col("_piece").isNotNull()
    boxed = boxed.withColumns({"_x1": F.coalesce("_piece.right", "_x1"), "_part": F.coalesce("_piece.rings", "rings"), "_height": F.col("_piece.height"), "_row": F.col("_piece.row")})
    listed = boxed.withColumn("_cx", F.explode(F.sequence(index(F.col("_x0")), index(F.col("_x1")))))
    rows = F.when(cut, F.array("_piece.cy")).otherwise(F.sequence(index(F.col("_y0")), index(F.col("_y1"))))
    listed = listed.withColumn("_cy", F.explode(rows)).drop("_piece")
    placed = points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).withColumns({"_cx": index(F.col(x)), "_cy": index(F.col(y))})
    near = placed.join(listed, ["_cx", "_cy"]).where(F.col(x).between(F.col("_x0"), F.col("_x1")) & F.col(y).between(F.col("_y0"), F.col("_y1")))
    near = near.where(F.col("_height").isNull() | (F.floor(F.col(y) / F.col("_height")) == F.col("_row")))
    return near.where(predicate(F.col("_part"), F.col(x), F.col(y))).drop("_cx", "_cy", "_part", "_height", "_row", *box)


def centroid(rings: Column) -> Column:
    """struct(x, y): the area centroid of the outer ring; null for a ring without area."""
    zero = F.lit(0.0)
    point = F.lit(None).cast("struct<x:double,y:double>")
    start = F.struct(point.alias("last"), zero.alias("area"), zero.alias("cx"), zero.alias("cy"))

    def add(acc: Column, p: Column) -> Column:
        a = acc["last"]
        cross = a["x"] * p["y"] - p["x"] * a["y"]
        plus = lambda name, v: F.when(a.isNull(), zero).otherwise(acc[name] + v).alias(name)
        here = F.struct(p["x"].alias("x"), p["y"].alias("y")).alias("last")
        return F.struct(here, plus("area", cross), plus("cx", (a["x"] + p["x"]) * cross), plus("cy", (a["y"] + p["y"]) * cross))

    # one pass over the ring, with the sums as its result
    return F.aggregate(rings[0], start, add, lambda s: F.when(s["area"] != 0, F.struct((s["cx"] / (3 * s["area"])).alias("x"), (s["cy"] / (3 * s["area"])).alias("y"))))


def parse_wkt_point(text: Column) -> Column:
    """struct(x, y) of 'POINT (x y)'; null for anything else."""
    pattern = r"(?i)^\s*POINT\s*\(\s*(\S+)\s+(\S+)\s*\)\s*$"
    x, y = F.regexp_extract(text, pattern, 1).try_cast("double"), F.regexp_extract(text, pattern, 2).try_cast("double")
    return F.when(x.isNotNull() & y.isNotNull(), F.struct(x.alias("x"), y.alias("y")))


def _kept_corners(xs: list[float], ys: list[float], first: int, last: int, tolerance: float) -> list[int]:
    """Places of the corners from ``first`` to ``last`` that farthest-point splitting (Douglas and Peucker) keeps, both ends among them."""
    keep, parts = [first, last] if last > first else [first], [(first, last)]
    while parts:
        a, b = parts.pop()
        if b - a < 2:
            continue
        x0, y0 = xs[a], ys[a]
        dx, dy = xs[b] - x0, ys[b] - y0
        length = float(np.hypot(dx, dy))
        if length and b - a < 40:  # arrays cost more than they save
            away = [abs(dx * (ys[k] - y0) - dy * (xs[k] - x0)) / length for k in range(a + 1, b)]
            most = max(away)
            far = a + 1 + away.index(most)
        else:
            x, y = np.array(xs[a + 1 : b]) - x0, np.array(ys[a + 1 : b]) - y0
            away = np.abs(dx * y - dy * x) / length if length else np.hypot(x, y)
            far = a + 1 + int(away.argmax())
            most = away[far - a - 1]
        if most > tolerance:
            keep.append(far)
            parts += [(a, far), (far, b)]
    keep.sort()
    return keep


def simplified(rings: Column, tolerance: float) -> Column:
    """Rings without the corners that lie within ``tolerance`` of what is left; null stays null. Shapes in Arrow batches."""

    @F.arrow_udf(RINGS)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for shapes in batches:
            rows = shapes.flatten()
            points = rows.flatten()
            x, y = (c.to_numpy(zero_copy_only=False).tolist() for c in points.flatten())
            at, kept, sizes = 0, [], [0]
            for n in pa.compute.list_value_length(rows).to_pylist():  # a null ring has no corners
                if n:
                    kept += _kept_corners(x, y, at, at + n - 1, tolerance)
                    at += n
                sizes.append(len(kept))
            inner = _listed(np.array(sizes), points.take(pa.array(kept, pa.int64())))
            counts = pa.compute.fill_null(pa.compute.list_value_length(shapes), 0).to_numpy()
            yield pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), inner, mask=shapes.is_null()).cast(shapes.type)

    return run(rings)


def dissolved(regions: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, edges): the boundary of the union of each group's regions, as array<struct<a, b>> of its sides.

    For regions that share whole sides and do not overlap, as tracts of one map do: a side of two regions is inside the
    union. Sides are counted in an aggregation, so a group's inner sides never meet in one place.
    """
    point = lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))
    sides = lambda ring: _sides(ring, lambda a, b: F.struct(F.least(point(a), point(b)).alias("a"), F.greatest(point(a), point(b)).alias("b")))
    all_sides = regions.select(*keys, F.explode(F.flatten(F.transform("rings", sides))).alias("side"))
    outer = all_sides.groupBy(*keys, "side").agg(F.count(F.lit(1)).alias("n")).where("n % 2 = 1")
    return outer.groupBy(*keys).agg(F.sort_array(F.collect_list("side")).alias("edges"))
