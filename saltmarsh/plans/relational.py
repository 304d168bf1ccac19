"""Queries: projections, filters, joins, aggregates, ordering, deduplication, unions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import relational as op
from ..operators import spatial
from ..operators.asof import asof_nearest
from .catalogue import query


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def project_columns(supplier: DataFrame) -> DataFrame:
    return supplier.select("s_suppkey", "s_name", "s_acctbal")


@query("SELECT s_suppkey AS id, s_name AS name, 'station' AS icon, s_nationkey AS area, s_nationkey AS area_code FROM supplier")
def rename_add_drop(supplier: DataFrame) -> DataFrame:
    named = op.drop_columns(supplier, "s_acctbal").withColumnsRenamed({"s_suppkey": "id", "s_name": "name", "s_nationkey": "area"})
    return named.withColumns({"icon": F.lit("station"), "area_code": F.col("area")})


@query("""SELECT l_orderkey, l_linenumber, l_quantity + coalesce(nullif(l_discount, 0), 0) + coalesce(nullif(l_tax, 0), 0) AS total,
greatest(l_quantity, coalesce(nullif(l_discount, 0), 0), coalesce(nullif(l_tax, 0), 0)) AS largest FROM lineitem""")
def rowwise_sum_max(lineitem: DataFrame) -> DataFrame:
    parts = [F.col("l_quantity"), F.nullif("l_discount", F.lit(0.0)), F.nullif("l_tax", F.lit(0.0))]
    return lineitem.select("l_orderkey", "l_linenumber", op.row_sum(*parts).alias("total"), op.row_max(*parts).alias("largest"))


@query("SELECT p_partkey, p_name AS name, p_name AS name_copy FROM part")
def columns_by_pattern(part: DataFrame) -> DataFrame:
    found = op.columns_like(part, "_name")
    return part.select("p_partkey", *(F.col(c).alias(c.removeprefix("p_")) for c in found), *(F.col(c).alias(f"{c.removeprefix('p_')}_copy") for c in found))


@query("SELECT event_id, user_id, value FROM events WHERE event_type = 'error'")
def filter_eq(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == "error").select("event_id", "user_id", "value")


@query("SELECT event_id, value FROM events WHERE value >= 30")
def filter_range(events: DataFrame) -> DataFrame:
    return events.where(F.col("value") >= 30).select("event_id", "value")


@query("SELECT p_partkey, p_type FROM part WHERE p_type LIKE 'S%'")
def filter_prefix(part: DataFrame) -> DataFrame:
    return part.where(F.startswith("p_type", F.lit("S"))).select("p_partkey", "p_type")


@query("SELECT p_partkey, p_type FROM part WHERE p_type LIKE '%E%'")
def filter_contains(part: DataFrame) -> DataFrame:
    return part.where(F.contains("p_type", F.lit("E"))).select("p_partkey", "p_type")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_discount <> 0 OR l_tax <> 0")
def filter_or_nonzero(lineitem: DataFrame) -> DataFrame:
    return lineitem.where((F.col("l_discount") != 0) | (F.col("l_tax") != 0)).select("l_orderkey", "l_linenumber")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F' AND o_orderpriority <> '1-URGENT'")
def filter_and_not_equal(orders: DataFrame) -> DataFrame:
    return orders.where((F.col("o_orderstatus") != "F") & (F.col("o_orderpriority") != "1-URGENT")).select("o_orderkey", "o_orderstatus")


@query("""SELECT l_orderkey, l_linenumber, l_discount AS discount, l_tax AS tax FROM lineitem
WHERE nullif(l_discount, 0) IS NOT NULL AND nullif(l_tax, 0) IS NOT NULL""")
def dropna_subset(lineitem: DataFrame) -> DataFrame:
    nullable = lineitem.select("l_orderkey", "l_linenumber", F.nullif("l_discount", F.lit(0.0)).alias("discount"), F.nullif("l_tax", F.lit(0.0)).alias("tax"))
    return nullable.na.drop("any", subset=["discount", "tax"])


@query("SELECT event_id, ts FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 7 DAY")
def filter_last_n_days(events: DataFrame) -> DataFrame:
    return op.last_days(events.select("event_id", "ts"), "ts", 7, events.agg(F.max("ts")).scalar())


@query("""SELECT event_id, ts, value FROM events WHERE event_type = 'error' AND value >= 30
AND ts > (SELECT max(ts) FROM events WHERE event_type = 'error' AND value >= 30 AND ts < TIMESTAMP '2024-01-20')""")
def incremental_new_rows(events: DataFrame) -> DataFrame:
    alerts = events.where((F.col("event_type") == "error") & (F.col("value") >= 30)).select("event_id", "ts", "value")
    published = alerts.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")).agg(F.max("ts").alias("mark"))
    return op.newer_than(alerts, "ts", published)


@query("""SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey
AND o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-04-01')""")
def anti_unmatched(customer: DataFrame, orders: DataFrame) -> DataFrame:
    at = F.col("o_orderdate")
    month = orders.where((at >= F.lit("1997-03-01").cast("timestamp_ntz")) & (at < F.lit("1997-04-01").cast("timestamp_ntz")))
    return op.unmatched(customer.select("c_custkey", "c_name"), month.select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("SELECT s_suppkey, s_name, n_name, n_regionkey FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def join_inner(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    return op.equi_join(supplier, nation, [("s_nationkey", "n_nationkey")]).select("s_suppkey", "s_name", "n_name", "n_regionkey")


@query("""SELECT s_suppkey, s_nationkey, n_name FROM (SELECT * FROM nation WHERE n_regionkey = 1) RIGHT JOIN supplier ON s_nationkey = n_nationkey""")
def join_right(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    one = nation.where(F.col("n_regionkey") == 1)
    return op.equi_join(one, supplier, [("n_nationkey", "s_nationkey")], "right").select("s_suppkey", "s_nationkey", "n_name")


@query("SELECT c_nationkey AS nation, count(*) AS pairs FROM customer JOIN supplier ON c_nationkey = s_nationkey GROUP BY 1")
def join_many_to_many(customer: DataFrame, supplier: DataFrame) -> DataFrame:
    # counts on both sides before the join: the pairs are never formed
    ours = op.grouped(customer.withColumnRenamed("c_nationkey", "nation"), ["nation"], F.count(F.lit(1)).alias("a"))
    theirs = op.grouped(supplier.withColumnRenamed("s_nationkey", "nation"), ["nation"], F.count(F.lit(1)).alias("b"))
    return ours.join(theirs, "nation").select("nation", (F.col("a") * F.col("b")).alias("pairs"))


@query("""WITH e AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS errors FROM events WHERE event_type = 'error' GROUP BY 1),
p AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS purchases FROM events WHERE event_type = 'purchase' GROUP BY 1)
SELECT hour, errors, purchases FROM e JOIN p USING (hour)""")
def join_time_eq(events: DataFrame) -> DataFrame:
    hour = F.date_trunc("hour", "ts").alias("hour")
    errors = events.where("event_type = 'error'").groupBy(hour).agg(F.count(F.lit(1)).alias("errors"))
    purchases = events.where("event_type = 'purchase'").groupBy(hour).agg(F.count(F.lit(1)).alias("purchases"))
    return errors.join(purchases, "hour").withColumn("hour", F.col("hour").cast("timestamp_ntz"))


@query("SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey::VARCHAR = c_custkey::VARCHAR")
def join_cast_key(orders: DataFrame, customer: DataFrame) -> DataFrame:
    a = orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("k"))
    return a.join(customer.select("c_name", F.col("c_custkey").cast("string").alias("k")), "k").select("o_orderkey", "c_name")


@query("""WITH a AS (SELECT event_id, nullif(user_id % 5, 0) AS k FROM events WHERE event_type = 'signup'),
b AS (SELECT nullif(r_regionkey, 0) AS k, r_name FROM region)
SELECT event_id, a.k, r_name FROM a JOIN b ON a.k IS NOT DISTINCT FROM b.k""")
def join_null_safe(events: DataFrame, region: DataFrame) -> DataFrame:
    a = events.where("event_type = 'signup'").select("event_id", F.nullif(F.col("user_id") % 5, F.lit(0)).alias("k"))
    b = region.select(F.nullif(F.col("r_regionkey").cast("long"), F.lit(0)).alias("k"), "r_name")
    return op.equi_join(a, b, [("k", "k")], null_safe=True).select("event_id", "k", "r_name")


_ASOF = """WITH l AS (SELECT * FROM events WHERE event_type = 'error'), r AS (SELECT * FROM events WHERE event_type = 'purchase'),
b AS (SELECT l.event_id, l.ts, r.event_id AS bid, r.ts AS bts FROM l ASOF LEFT JOIN r ON l.ts >= r.ts),
f AS (SELECT l.event_id, r.event_id AS fid, r.ts AS fts FROM l ASOF LEFT JOIN r ON l.ts <= r.ts)
SELECT event_id, CASE WHEN fts IS NULL OR ts - bts <= fts - ts THEN bid ELSE fid END AS nearest_id FROM b JOIN f USING (event_id)"""


@query(_ASOF)
def asof_nearest_join(events: DataFrame) -> DataFrame:
    errors = events.where("event_type = 'error'").select("event_id", "ts")
    purchases = events.where("event_type = 'purchase'").select("event_id", "ts", "value")
    return asof_nearest(errors, purchases, "ts", "ts", "event_id").select("event_id", F.col("nearest.event_id").alias("nearest_id"))


@query("""WITH l AS (SELECT * FROM events WHERE event_type = 'error'), r AS (SELECT user_id, ts, max(event_id) AS hi, min(event_id) AS lo FROM events WHERE event_type = 'view' GROUP BY 1, 2),
b AS (SELECT l.event_id, l.user_id, l.ts, r.hi AS bid, r.ts AS bts FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts >= r.ts),
f AS (SELECT l.event_id, r.lo AS fid, r.ts AS fts FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts <= r.ts),
c AS (SELECT event_id, user_id, ts, CASE WHEN fts IS NULL OR ts - bts <= fts - ts THEN bid ELSE fid END AS nid, CASE WHEN fts IS NULL OR ts - bts <= fts - ts THEN bts ELSE fts END AS nts FROM b JOIN f USING (event_id))
SELECT event_id, user_id, CASE WHEN nts BETWEEN ts - INTERVAL 6 HOUR AND ts + INTERVAL 6 HOUR THEN nid END AS nearest_id FROM c""")
def asof_nearest_by_user(events: DataFrame) -> DataFrame:
    errors = events.where("event_type = 'error'").select("event_id", "user_id", "ts")
    views = events.where("event_type = 'view'").select("event_id", "user_id", "ts")
    near = asof_nearest(errors, views, "ts", "ts", "event_id", by=["user_id"], tolerance="6 hours")
    return near.select("event_id", "user_id", F.col("nearest.event_id").alias("nearest_id"))


_REGIONS = [("square", [[(0, 0), (40, 0), (40, 40), (0, 40), (0, 0)]]), ("triangle", [[(50, 10), (90, 10), (70, 60), (50, 10)]]), ("ring", [[(20, 60), (60, 60), (60, 95), (20, 95), (20, 60)], [(30, 70), (50, 70), (50, 85), (30, 85), (30, 70)]])]


def _regions(spark) -> DataFrame:
    rows = [(name, [[(float(x), float(y)) for x, y in ring] for ring in rings]) for name, rings in _REGIONS]
    return spark.createDataFrame(rows, f"region string, rings {spatial.RINGS}")


def _points(customer: DataFrame) -> DataFrame:
    return customer.select("c_custkey", ((F.col("c_custkey") * 37) % 101).cast("double").alias("x"), ((F.col("c_custkey") * 53) % 103).cast("double").alias("y"))


# The three shapes written out by hand, inside and with their boundaries.
_POINTS = "WITH p AS (SELECT c_custkey, ((c_custkey * 37) % 101)::DOUBLE AS x, ((c_custkey * 53) % 103)::DOUBLE AS y FROM customer)"
_INSIDE = """SELECT c_custkey, 'square' AS region FROM p WHERE x > 0 AND x < 40 AND y > 0 AND y < 40
UNION ALL SELECT c_custkey, 'triangle' FROM p WHERE y > 10 AND 5 * (x - 50) > 2 * (y - 10) AND 5 * (90 - x) > 2 * (y - 10)
UNION ALL SELECT c_custkey, 'ring' FROM p WHERE x > 20 AND x < 60 AND y > 60 AND y < 95 AND NOT (x >= 30 AND x <= 50 AND y >= 70 AND y <= 85)"""
_TOUCHING = """SELECT c_custkey, 'square' AS region FROM p WHERE x >= 0 AND x <= 40 AND y >= 0 AND y <= 40
UNION ALL SELECT c_custkey, 'triangle' FROM p WHERE y >= 10 AND 5 * (x - 50) >= 2 * (y - 10) AND 5 * (90 - x) >= 2 * (y - 10)
UNION ALL SELECT c_custkey, 'ring' FROM p WHERE x >= 20 AND x <= 60 AND y >= 60 AND y <= 95 AND NOT (x > 30 AND x < 50 AND y > 70 AND y < 85)"""


@query(f"{_POINTS} {_INSIDE}")
def spatial_contains(spark, customer: DataFrame) -> DataFrame:
    return spatial.join_points(_points(customer), _regions(spark), "x", "y", 25.0).select("c_custkey", "region")


@query(f"{_POINTS} {_TOUCHING}")
def spatial_intersects(spark, customer: DataFrame) -> DataFrame:
    return spatial.join_points(_points(customer), _regions(spark), "x", "y", 25.0, spatial.intersects).select("c_custkey", "region")


@query(f"{_POINTS} SELECT region, count(*) AS n FROM ({_INSIDE}) GROUP BY region")
def agg_count_by_region(spark, customer: DataFrame) -> DataFrame:
    return spatial.join_points(_points(customer), _regions(spark), "x", "y", 25.0).groupBy("region").agg(F.count("c_custkey").alias("n"))


def _tiles(customer: DataFrame) -> DataFrame:
    """Unit squares in rows of ten, with a corner more in the middle of each lower side."""
    x, y = (F.col("c_custkey") % 10).cast("double"), F.floor(F.col("c_custkey") / 10).cast("double")
    at = lambda dx, dy: F.struct((x + dx).alias("x"), (y + dy).alias("y"))
    ring = lambda *more: F.array(F.array(at(0, 0), *more, at(1, 0), at(1, 1), at(0, 1), at(0, 0)))
    return customer.select("c_custkey", "c_nationkey", ring().alias("rings"), ring(at(0.25, 0.001), at(0.5, 0)).alias("rough"))


@query("SELECT c_custkey, 5 AS corners, c_custkey % 10 + 0.5::DOUBLE AS x, floor(c_custkey / 10) + 0.5::DOUBLE AS y FROM customer")
def simplify_rings(customer: DataFrame) -> DataFrame:
    plain = _tiles(customer).select("c_custkey", spatial.simplified(F.col("rough"), 0.01).alias("rings"))
    c = spatial.centroid(F.col("rings"))
    return plain.select("c_custkey", F.size(F.col("rings")[0]).alias("corners"), F.round(c["x"], 6).alias("x"), F.round(c["y"], 6).alias("y"))


@query("""WITH t AS (SELECT c_nationkey, c_custkey % 10 AS x, floor(c_custkey / 10) AS y FROM customer),
s AS (SELECT c_nationkey, x, y, 'h' AS k FROM t UNION ALL SELECT c_nationkey, x, y + 1, 'h' FROM t UNION ALL SELECT c_nationkey, x, y, 'v' FROM t UNION ALL SELECT c_nationkey, x + 1, y, 'v' FROM t)
SELECT c_nationkey, count(*) AS sides FROM (SELECT c_nationkey FROM s GROUP BY c_nationkey, x, y, k HAVING count(*) = 1) GROUP BY 1""")
def dissolve_regions(customer: DataFrame) -> DataFrame:
    found = spatial.dissolved(_tiles(customer), ["c_nationkey"])
    return found.select("c_nationkey", F.size("edges").cast("long").alias("sides"))


@query("""SELECT c_custkey, round(k::DOUBLE, 6) AS x, round(k / 3.0 + 1, 6)::DOUBLE AS y FROM (SELECT c_custkey, (c_custkey % 9 + 1) AS k FROM customer)""")
def region_centroids(customer: DataFrame) -> DataFrame:
    """Right triangles of all sizes: the middle is a third of the way from the right angle along both legs."""
    k = (F.col("c_custkey") % 9 + 1).cast("double")
    at = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    one = F.lit(1.0)
    rings = F.array(F.array(at(k * 0, one), at(k * 3, one), at(k * 0, one + k), at(k * 0, one)))
    c = spatial.centroid(rings)
    return customer.select("c_custkey", F.round(c["x"], 6).alias("x"), F.round(c["y"], 6).alias("y"))


@query("SELECT c_custkey, (c_custkey % 7)::DOUBLE AS x, (c_custkey % 11)::DOUBLE AS y FROM customer WHERE c_custkey % 3 <> 0 UNION ALL SELECT c_custkey, NULL, NULL FROM customer WHERE c_custkey % 3 = 0")
def wkt_points(customer: DataFrame) -> DataFrame:
    text = F.when(F.col("c_custkey") % 3 != 0, F.format_string("POINT (%d.0 %d)", F.col("c_custkey") % 7, F.col("c_custkey") % 11)).otherwise("POLYGON EMPTY")
    return customer.select("c_custkey", spatial.parse_wkt_point(text).alias("p")).select("c_custkey", "p.x", "p.y")


@query("SELECT CAST(ts AS DATE) AS day, count(event_id) AS n FROM events WHERE event_type = 'error' GROUP BY 1")
def agg_count_by_date(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == "error").groupBy(F.to_date("ts").alias("day")).agg(F.count("event_id").alias("n"))


@query("SELECT event_type, sum(value::DECIMAL(18,2))::DOUBLE AS total FROM events GROUP BY 1")
def agg_sum(events: DataFrame) -> DataFrame:
    return op.grouped(events, ["event_type"], F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"))


@query("SELECT event_type, max(event_id) AS event_id, max(ts) AS ts, max(user_id) AS user_id, max(value) AS value, max(props) AS props FROM events GROUP BY 1")
def agg_max_all(events: DataFrame) -> DataFrame:
    return op.max_of_all(events, "event_type")


@query("SELECT o_orderpriority, count(o_orderkey) AS o_orderkey, count(nullif(o_orderstatus, 'F')) AS open_status FROM orders GROUP BY 1")
def agg_count_all(orders: DataFrame) -> DataFrame:
    return op.count_of_all(orders.select("o_orderpriority", "o_orderkey", F.nullif("o_orderstatus", F.lit("F")).alias("open_status")), "o_orderpriority")


@query("SELECT date_trunc('week', o_orderdate)::DATE AS week, count(*) AS n FROM orders GROUP BY 1")
def agg_size(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.date_trunc("week", "o_orderdate").cast("date").alias("week")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT min(value) AS low, max(value) AS high, min(ts) AS first, max(ts) AS last FROM events")
def agg_minmax(events: DataFrame) -> DataFrame:
    return events.agg(F.min("value").alias("low"), F.max("value").alias("high"), F.min("ts").alias("first"), F.max("ts").alias("last"))


@query("SELECT p_brand, count(*) AS n FROM part GROUP BY 1")
def value_counts(part: DataFrame) -> DataFrame:
    return op.value_counts(part, "p_brand")


@query("SELECT user_id, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, user_id LIMIT 20")
def topk_groups(events: DataFrame) -> DataFrame:
    return op.top_groups(events, "user_id", 20)


@query("SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS kinds FROM events GROUP BY 1")
def collect_distinct(events: DataFrame) -> DataFrame:
    return op.grouped(events, ["user_id"], F.array_join(F.sort_array(F.collect_set("event_type")), ",").alias("kinds"))


@query("SELECT DISTINCT c_mktsegment FROM customer")
def distinct_values(customer: DataFrame) -> DataFrame:
    return customer.select("c_mktsegment").distinct()


@query("""SELECT count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, min(value) AS min, round(quantile_cont(value, 0.25), 6) AS p25,
round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75, max(value) AS max FROM events""")
def describe_stats(events: DataFrame) -> DataFrame:
    found = op.describe(events, "value")
    return found.select("n", *(F.round(c, 6).alias(c) for c in ("mean", "std")), "min", *(F.round(c, 6).alias(c) for c in ("p25", "p50", "p75")), "max")


@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 25")
def sort_limit(customer: DataFrame) -> DataFrame:
    return customer.select("c_custkey", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey").limit(25)


@query("SELECT user_id, event_id, ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1")
def dedupe_first(events: DataFrame) -> DataFrame:
    return op.first_per_key(events.select("user_id", "event_id", "ts"), ["user_id"], [F.col("ts"), F.col("event_id")])


@query("SELECT user_id, event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def dedupe_last(events: DataFrame) -> DataFrame:
    newest = op.first_per_key(events.select("user_id", "event_type", "ts", "event_id"), ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")])
    return newest.drop("ts")


@query("""SELECT k, event_id FROM (SELECT nullif(user_id % 20, 0) AS k, event_id, ts FROM events) WHERE k IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY k ORDER BY ts DESC, event_id DESC) = 1""")
def last_per_group(events: DataFrame) -> DataFrame:
    rows = events.select(F.nullif(F.col("user_id") % 20, F.lit(0)).alias("k"), "event_id", "ts")
    return op.last_per_group(rows, ["k"], [F.desc("ts"), F.desc("event_id")]).drop("ts")


@query("SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 3")
def last_n_per_group(events: DataFrame) -> DataFrame:
    return op.last_per_group(events.select("user_id", "event_id", "ts"), ["user_id"], [F.desc("ts"), F.desc("event_id")], 3).drop("ts")


@query("SELECT event_id, ts FROM events WHERE event_id > (SELECT min(event_id) FROM events)")
def drop_first_row(events: DataFrame) -> DataFrame:
    return op.without_first(events.select("event_id", "ts"), "event_id")


@query("""SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance, NULL AS segment FROM supplier
UNION ALL SELECT c_custkey, c_name, NULL, c_mktsegment FROM customer""")
def union_by_name(supplier: DataFrame, customer: DataFrame) -> DataFrame:
    a = supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    b = customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return op.union_all(a, None, b)


@query("""SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 10 <> 3
UNION ALL SELECT o_orderkey, 'U', o_totalprice + 1 FROM orders WHERE o_orderkey % 10 = 3 UNION ALL SELECT -o_orderkey, 'N', o_totalprice FROM orders WHERE o_orderkey % 100 = 7""")
def upsert_merge(orders: DataFrame) -> DataFrame:
    base = orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    changed = base.where("o_orderkey % 10 = 3").select("o_orderkey", F.lit("U").alias("o_orderstatus"), (F.col("o_totalprice") + 1).alias("o_totalprice"))
    added = base.where("o_orderkey % 100 = 7").select((-F.col("o_orderkey")).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"), "o_totalprice")
    return op.upsert(base, changed.union(added), ["o_orderkey"])
