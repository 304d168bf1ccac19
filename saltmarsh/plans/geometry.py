"""Queries: projections, unions of regions, borders simplified together, shapefiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import projections
from ..operators import spatial, topology
from ..operators.spatial import _sides
from ..session import new_folder
from ..sources import shapefile
from .catalogue import query

# The SQL side has its own way to the latitude: nine rounds of the fixed-point iteration.
_PLANE = """p AS (SELECT c_custkey, 6200000 + (c_custkey * 7919) % 900000 + 0.25 AS x, CASE WHEN c_custkey % 5 <> 0 THEN 1700000 + (c_custkey * 104729) % 800000 - 0.5 END AS y FROM customer),
k AS (SELECT sqrt(2 / 298.257222101 - 1 / 298.257222101 ** 2) AS e, radians(33 + 53 / 60::DOUBLE) AS p1, radians(32 + 47 / 60::DOUBLE) AS p2, radians(32 + 10 / 60::DOUBLE) AS p0),
m AS (SELECT *, cos(p1) / sqrt(1 - (e * sin(p1)) ** 2) AS m1, cos(p2) / sqrt(1 - (e * sin(p2)) ** 2) AS m2, tan(pi() / 4 - p1 / 2) / ((1 - e * sin(p1)) / (1 + e * sin(p1))) ** (e / 2) AS t1,
  tan(pi() / 4 - p2 / 2) / ((1 - e * sin(p2)) / (1 + e * sin(p2))) ** (e / 2) AS t2, tan(pi() / 4 - p0 / 2) / ((1 - e * sin(p0)) / (1 + e * sin(p0))) ** (e / 2) AS t0 FROM k),
n AS (SELECT *, (ln(m1) - ln(m2)) / (ln(t1) - ln(t2)) AS n FROM m), c AS (SELECT *, m1 / (n * t1 ** n) * 6378137 * 3937 / 1200 AS f FROM n)"""
_LATITUDE = "pi() / 2 - 2 * atan(t * ((1 - e * sin({0})) / (1 + e * sin({0}))) ** (e / 2))"
_ROUNDS = ",\n".join(f"r{i} AS (SELECT *, {_LATITUDE.format(f'f{i - 1}')} AS f{i} FROM r{i - 1})" for i in range(1, 10))


def _plane(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    x, y = 6200000 + (k * 7919) % 900000 + 0.25, F.when(k % 5 != 0, 1700000 + (k * 104729) % 800000 - 0.5)
    return customer.select("c_custkey", x.cast("double").alias("x"), y.cast("double").alias("y"))


@query(f"""WITH {_PLANE}, q AS (SELECT c_custkey, e, n, x - 6561666.667 AS dx, f * t0 ** n - (y - 1640416.667) AS dy, f FROM p, c WHERE y IS NOT NULL),
r0 AS (SELECT *, (sqrt(dx * dx + dy * dy) / f) ** (1 / n) AS t, pi() / 2 - 2 * atan((sqrt(dx * dx + dy * dy) / f) ** (1 / n)) AS f0 FROM q), {_ROUNDS}
SELECT c_custkey, round(degrees(atan(dx / dy) / n) - 116.25, 8) AS longitude, round(degrees(f9), 8) AS latitude FROM r9
UNION ALL SELECT c_custkey, NULL, NULL FROM p WHERE y IS NULL""")
def crs_to_degrees(customer: DataFrame) -> DataFrame:
    """Plane survey feet to degrees."""
    at = _plane(customer).select("c_custkey", projections.to_degrees(F.col("x"), F.col("y"), "EPSG:2230").alias("p"))
    return at.select("c_custkey", F.round("p.longitude", 8).alias("longitude"), F.round("p.latitude", 8).alias("latitude"))


@query(f"""WITH {_PLANE}, g AS (SELECT c_custkey, -117.5 + (c_custkey % 300) / 100.0::DOUBLE AS lon, 32.4 + (c_custkey % 170) / 100.0::DOUBLE AS lat FROM customer),
q AS (SELECT c_custkey, e, n, f, t0, radians(lat) AS phi, n * radians(lon + 116.25) AS theta FROM g, c), r AS (SELECT *, f * (tan(pi() / 4 - phi / 2) / ((1 - e * sin(phi)) / (1 + e * sin(phi))) ** (e / 2)) ** n AS r FROM q)
SELECT c_custkey, round(r * sin(theta) + 6561666.667, 4) AS x, round(f * t0 ** n - r * cos(theta) + 1640416.667, 4) AS y FROM r""")
def crs_from_degrees(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    at = projections.from_degrees(F.lit(-117.5) + (k % 300) / 100.0, F.lit(32.4) + (k % 170) / 100.0, "EPSG:2230")
    return customer.select("c_custkey", at.alias("p")).select("c_custkey", F.round("p.x", 4).alias("x"), F.round("p.y", 4).alias("y"))


def _tiles(customer: DataFrame, waves: bool = False) -> DataFrame:
    """Unit squares in rows of ten; every third one has its lower side in two parts. With ``waves``, each side has a corner
    in its middle that is moved across it, by less than 0.02 or by 0.08 and more, in both neighbours alike.
    """
    x, y = (F.col("c_custkey") % 10).cast("double"), F.floor(F.col("c_custkey") / 10).cast("double")
    at = lambda dx, dy: F.struct((x + dx).alias("x"), (y + dy).alias("y"))
    if not waves:
        ring = F.when(F.col("c_custkey") % 3 == 0, F.array(at(0, 0), at(0.5, 0), at(1, 0), at(1, 1), at(0, 1), at(0, 0))).otherwise(F.array(at(0, 0), at(0, 1), at(1, 1), at(1, 0), at(0, 0)))
    else:
        off = lambda px, py, k: (px * 7 + py * 5 + k) % 8 * 0.02 - 0.02 * ((px * 7 + py * 5 + k) % 8 % 7) * F.when((px * 7 + py * 5 + k) % 8 < 4, 1).otherwise(0)
        ring = F.array(at(0, 0), at(0.5, off(x, y, 0)), at(1, 0), at(1 + off(x + 1, y, 1), 0.5), at(1, 1), at(0.5, 1 + off(x, y + 1, 0)), at(0, 1), at(off(x, y, 1), 0.5), at(0, 0))
    return customer.select("c_custkey", "c_nationkey", F.array(ring).alias("rings"))


def _area(rings: Column) -> Column:
    """The sum of the rings' signed areas."""
    cross = lambda a, b: (a["x"] * b["y"] - b["x"] * a["y"]) / 2
    each = F.transform(rings, lambda r: F.aggregate(_sides(r, cross), F.lit(0.0), lambda acc, v: acc + v))
    return F.aggregate(each, F.lit(0.0), lambda acc, v: acc + v)


def _length(rings: Column) -> Column:
    side = lambda a, b: F.hypot(b["x"] - a["x"], b["y"] - a["y"])
    each = F.transform(rings, lambda r: F.aggregate(_sides(r, side), F.lit(0.0), lambda acc, v: acc + v))
    return F.aggregate(each, F.lit(0.0), lambda acc, v: acc + v)


_GRID = "t AS (SELECT c_custkey, c_nationkey, c_custkey % 10 AS x, floor(c_custkey / 10) AS y FROM customer)"


@query(f"""WITH {_GRID}, s AS (SELECT c_nationkey, x, y, 'h' AS k FROM t UNION ALL SELECT c_nationkey, x, y + 1, 'h' FROM t UNION ALL SELECT c_nationkey, x, y, 'v' FROM t UNION ALL SELECT c_nationkey, x + 1, y, 'v' FROM t),
o AS (SELECT c_nationkey, count(*) AS n FROM (SELECT c_nationkey FROM s GROUP BY c_nationkey, x, y, k HAVING count(*) = 1) GROUP BY 1)
SELECT c_nationkey, count(*)::DOUBLE AS area, any_value(n)::DOUBLE AS border FROM t JOIN o USING (c_nationkey) GROUP BY 1""")
def dissolve_rings(customer: DataFrame) -> DataFrame:
    """The union of each nation's tiles: its area and the length of its border, holes included."""
    found = topology.union(_tiles(customer), ["c_nationkey"])
    return found.select("c_nationkey", F.round(_area(F.col("rings")), 6).alias("area"), F.round(_length(F.col("rings")), 6).alias("border"))


@query("SELECT c_custkey, c_nationkey FROM customer")
def dissolve_contains(customer: DataFrame) -> DataFrame:
    """Which union has each tile's middle: that of its nation, and no other."""
    middle = customer.select("c_custkey", (F.col("c_custkey") % 10 + 0.5).alias("x"), (F.floor(F.col("c_custkey") / 10) + 0.5).alias("y"))
    return spatial.join_points(middle, topology.union(_tiles(customer), ["c_nationkey"]), "x", "y", 10.0).select("c_custkey", "c_nationkey")


@query(f"""WITH {_GRID}, c AS (SELECT DISTINCT c_nationkey, 2 * x + i AS x, 2 * y + j AS y FROM t, range(3) a(i), range(3) b(j)) SELECT c_nationkey, count(*) / 4 AS area FROM c GROUP BY 1""")
def dissolve_overlaps(customer: DataFrame) -> DataFrame:
    """Squares of one and a half, which overlap their neighbours."""
    x, y = (F.col("c_custkey") % 10).cast("double"), F.floor(F.col("c_custkey") / 10).cast("double")
    at = lambda dx, dy: F.struct((x + dx).alias("x"), (y + dy).alias("y"))
    wide = customer.select("c_nationkey", F.array(F.array(at(0, 0), at(1.5, 0), at(1.5, 1.5), at(0, 1.5), at(0, 0))).alias("rings"))
    return topology.union(wide, ["c_nationkey"]).select("c_nationkey", F.round(_area(F.col("rings")), 6).alias("area"))


_OFF = "((({0}) * 7 + ({1}) * 5 + {2}) % 8 * 0.02 - 0.02 * ((({0}) * 7 + ({1}) * 5 + {2}) % 8 % 7) * (CASE WHEN (({0}) * 7 + ({1}) * 5 + {2}) % 8 < 4 THEN 1 ELSE 0 END))"
_KEPT = [f"CASE WHEN abs({_OFF.format(*a)}) > 0.05 THEN {_OFF.format(*a)} ELSE 0 END" for a in (("x", "y", 0), ("x", "y + 1", 0), ("x", "y", 1), ("x + 1", "y", 1))]


@query(f"""WITH {_GRID}, d AS (SELECT c_custkey, {_KEPT[0]} AS lower, {_KEPT[1]} AS upper, {_KEPT[2]} AS lefter, {_KEPT[3]} AS righter FROM t)
SELECT c_custkey, round(1 + (upper - lower + righter - lefter) / 2, 6)::DOUBLE AS area FROM d""")
def simplify_shared(customer: DataFrame) -> DataFrame:
    """Small corners go from both neighbours' sides, and large ones stay in both."""
    found = topology.simplified_together(_tiles(customer, waves=True), 0.05)
    return found.select("c_custkey", F.round(_area(F.col("rings")), 6).alias("area"))


def _square(k: Column) -> Column:
    at = lambda dx, dy: F.struct((k + dx).cast("double").alias("x"), (k * 2 + dy).cast("double").alias("y"))
    return F.array(F.array(at(0, 0), at(0, 1), at(1, 1), at(1, 0), at(0, 0)))


@query("""SELECT c_custkey AS id, left(c_name, 40) AS name, CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS balance, c_nationkey > 12 AS high, CASE WHEN c_custkey % 5 <> 0 THEN DATE '2024-01-01' + (c_custkey % 366)::INT END AS day,
CASE c_custkey % 4 WHEN 0 THEN 'point' WHEN 3 THEN NULL ELSE 'polygon' END AS shape, CASE WHEN c_custkey % 4 = 0 THEN c_custkey / 8 - 117 END AS longitude, CASE WHEN c_custkey % 4 IN (1, 2) THEN 5 + 5 * (c_custkey % 4 - 1) ELSE 0 END::INT AS corners FROM customer""")
def shapefile_round_trip(spark, customer: DataFrame) -> DataFrame:
    """Points, polygons, polygons of two parts and empty records with all kinds of attributes, written by partitions and read by ranges."""
    k = F.col("c_custkey")
    shape = F.when(k % 4 == 0, "point").when(k % 4 != 3, "polygon")
    attributes = [k.cast("long").alias("id"), F.left("c_name", F.lit(40)).alias("name"), F.when(k % 7 != 0, F.col("c_acctbal").cast("double")).alias("balance"), (F.col("c_nationkey") > 12).alias("high")]
    day = F.when(k % 5 != 0, F.date_add(F.lit("2024-01-01").cast("date"), (k % 366).cast("int"))).alias("day")
    rings = F.when(k % 4 == 1, _square(k)).when(k % 4 == 2, F.concat(_square(k), _square(k + 1)))
    table = customer.select(*attributes, day, shape.alias("shape"), F.when(k % 4 == 0, k / 8 - 117).alias("longitude"), F.when(k % 4 == 0, k / 16 + 30).alias("latitude"), rings.alias("rings"))
    shapefile.register(spark)
    path = new_folder(spark, "shapes")
    table.write.format("shapefile").mode("append").save(path)
    read = spark.read.format("shapefile").option("rowsPerPartition", "500").load(path)
    corners = F.coalesce(F.size(F.flatten("rings")), F.lit(0))
    return read.select("id", "name", "balance", "high", "day", "shape", "longitude", corners.alias("corners"))
