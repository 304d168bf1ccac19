"""Queries: readers and sinks. Tables are written in a feed's layout by Spark and read back through the reader."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import relational
from ..session import new_folder
from ..sources import html_tables, paged, readers, sinks
from .catalogue import query


def _texts(df: DataFrame, column: Column, name: str, one_file: bool = False) -> str:
    """A folder of text files with a column's values as lines."""
    path = new_folder(df.sparkSession, name)
    lines = df.select(column.alias("value"))
    (lines.coalesce(1) if one_file else lines).write.text(path)
    return path


#: Rows of one file of a feed, where its layout makes a file one row.
FILE_ROWS = 50


def _files(df: DataFrame, order: str, text, name: str) -> str:
    """Files of ``FILE_ROWS`` rows: ``text`` makes a file's text of its rows, an array of structs by ``order``."""
    path = new_folder(df.sparkSession, name)
    rows = F.sort_array(F.collect_list(F.struct(order, *(c for c in df.columns if c != order))))
    files = df.groupBy(F.floor(F.col(order) / FILE_ROWS).alias("file")).agg(rows.alias("rows"))
    files.select("file", text(F.col("rows")).alias("value")).write.partitionBy("file").text(path)
    return f"{path}/file=*"


def _joined(rows: Column, each, separator: str) -> Column:
    return F.array_join(F.transform(rows, each), separator)


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def read_csv(spark, customer: DataFrame) -> DataFrame:
    path = new_folder(spark, "csv")
    sinks.to_csv(customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal"), path)
    return readers.csv(spark, path, "c_custkey long, c_name string, c_nationkey int, c_acctbal double").drop(readers.CORRUPT)


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def read_tsv(spark, supplier: DataFrame) -> DataFrame:
    path = _texts(supplier, F.concat_ws("\t", "s_suppkey", "s_name", "s_acctbal"), "tsv")
    return readers.csv(spark, path, "s_suppkey long, s_name string, s_acctbal double", "\t", header=False).drop(readers.CORRUPT)


@query("SELECT s_suppkey, s_name, s_suppkey % 5 = 0 AS bad FROM supplier WHERE s_suppkey % 5 <> 0 UNION ALL SELECT NULL, s_name, true FROM supplier WHERE s_suppkey % 5 = 0")
def read_piped(spark, supplier: DataFrame) -> DataFrame:
    key = F.when(F.col("s_suppkey") % 5 == 0, "no number").otherwise(F.col("s_suppkey").cast("string"))
    path = _texts(supplier, F.concat_ws("|", key, "s_name"), "piped")
    read = readers.csv(spark, path, "s_suppkey long, s_name string", "|", header=False)
    return read.select("s_suppkey", "s_name", F.col(readers.CORRUPT).isNotNull().alias("bad"))


@query("SELECT s_suppkey::VARCHAR AS start, CASE WHEN s_suppkey % 3 <> 0 THEN s_acctbal END AS flow FROM supplier")
def read_preamble_csv(spark, supplier: DataFrame) -> DataFrame:
    line = lambda r: F.concat(r["s_suppkey"].cast("string"), F.lit(","), F.when(r["s_suppkey"] % 3 != 0, r["s_acctbal"].cast("string")).otherwise(""))
    whole = lambda rows: F.concat(F.lit("Station 11013300\nParameter: discharge\nUnits\n\nStart of Interval,Average\n"), _joined(rows, line, "\n"), F.lit("\nEnd of data\n"))
    path = _files(supplier.select("s_suppkey", "s_acctbal"), "s_suppkey", whole, "preamble")
    return readers.csv_with_preamble(spark, path, "start string, flow double", skip=4, footer=1)


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def read_json_rows(spark, nation: DataFrame) -> DataFrame:
    arrays = nation.groupBy("n_regionkey").agg(F.to_json(F.collect_list(F.struct(*nation.columns))).alias("value"))
    path = new_folder(spark, "json")
    arrays.write.partitionBy("n_regionkey").text(path)  # an array a file
    shape = "n_nationkey int, n_name string, n_regionkey int"
    return readers.json_rows(spark, f"{path}/n_regionkey=*", shape)


@query("SELECT event_id, (props->>'k')::BIGINT AS \"props.k\" FROM events")
def json_normalize(events: DataFrame) -> DataFrame:
    return readers.flattened(events.select("event_id", F.from_json("props", "k long").alias("props")))


@query("SELECT s_suppkey::INT AS sensor_index, s_name AS name, CASE WHEN s_suppkey % 4 <> 0 THEN s_acctbal END AS pm25 FROM supplier")
def read_fields_and_rows(spark, supplier: DataFrame) -> DataFrame:
    value = lambda r: F.when(r["s_suppkey"] % 4 != 0, r["s_acctbal"].cast("string")).otherwise("null")
    line = lambda r: F.concat(F.lit('["'), r["s_name"], F.lit('", '), r["s_suppkey"].cast("string"), F.lit(", "), value(r), F.lit(", 0]"))
    whole = lambda rows: F.concat(F.lit('{"fields": ["name", "sensor_index", "pm25", "extra"], "data": ['), _joined(rows, line, ", "), F.lit("]}"))
    path = _files(supplier.select("s_suppkey", "s_name", "s_acctbal"), "s_suppkey", whole, "fields")
    return readers.fields_and_rows(spark, path, "sensor_index int, name string, pm25 double")


@query("SELECT DATE '1970-01-01' + s_suppkey::INT AS week_start_date, CASE WHEN s_suppkey % 3 = 1 THEN s_nationkey::DOUBLE END AS cases FROM supplier WHERE s_suppkey % 3 <> 2")
def read_ragged_series(spark, supplier: DataFrame) -> DataFrame:
    ms = lambda r: (r["s_suppkey"] * 86_400_000).cast("string")
    values = lambda r: F.when(r["s_suppkey"] % 3 == 1, F.concat_ws(", ", ms(r), r["s_nationkey"].cast("string"), F.lit("1"))).when(r["s_suppkey"] % 3 == 0, ms(r)).otherwise('"preliminary"')
    line = lambda r: F.concat(F.lit('{"C": ['), values(r), F.lit("]}"))
    start, end = '{"results": [{"result": {"data": {"dsr": {"DS": [{"PH": [{"DM0": []}, {"DM1": [', "]}]}]}}}}]}"
    path = _files(supplier.select("s_suppkey", "s_nationkey"), "s_suppkey", lambda rows: F.concat(F.lit(start), _joined(rows, line, ", "), F.lit(end)), "ragged")
    return readers.ragged_series(spark, path)


@query("SELECT c_custkey, c_name, (c_custkey % 50)::DOUBLE AS longitude, (c_custkey % 30)::DOUBLE AS latitude FROM customer WHERE c_custkey % 4 <> 0 UNION ALL SELECT c_custkey, c_name, NULL, NULL FROM customer WHERE c_custkey % 4 = 0")
def read_geojson(spark, customer: DataFrame) -> DataFrame:
    """Collections as the sink writes their features, a file for each fifty."""
    place = lambda n: F.when(F.col("c_custkey") % 4 != 0, (F.col("c_custkey") % n).cast("double"))
    points = customer.select("c_custkey", "c_name", place(50).alias("longitude"), place(30).alias("latitude"))
    features = points.select("c_custkey", sinks.feature(points).alias("one"))
    whole = lambda rows: F.concat(F.lit('{"type": "FeatureCollection", "features": ['), _joined(rows, lambda r: r["one"], ","), F.lit("]}"))
    return readers.geojson(spark, _files(features, "c_custkey", whole, "geojson"), "c_custkey: long, c_name: string").drop("rings")


@query("""SELECT 's' || s_suppkey AS name, s_suppkey AS id, CASE WHEN s_suppkey % 4 = 0 THEN s_nationkey::DOUBLE END AS longitude, CASE WHEN s_suppkey % 4 = 0 THEN 32.5::DOUBLE END AS latitude,
CASE s_suppkey % 4 WHEN 1 THEN 5 WHEN 2 THEN 14 ELSE 0 END AS corners, CASE s_suppkey % 4 WHEN 1 THEN s_nationkey + 4.0 WHEN 2 THEN s_nationkey + 9.0 END::DOUBLE AS right_most FROM supplier""")
def read_geojson_shapes(spark, supplier: DataFrame) -> DataFrame:
    """Points, polygons, multipolygons with a hole, and features without a shape."""
    key, x = F.col("s_suppkey") % 4, F.col("s_nationkey")
    square = lambda by, side: F.format_string(f"[[%d, {by}], [%d, {by}], [%d, {by + side}], [%d, {by + side}], [%d, {by}]]", x + by, x + by + side, x + by + side, x + by, x + by)
    triangle = F.format_string("[[%d, 1], [%d, 1], [%d, 2], [%d, 1]]", x + 1, x + 2, x + 1, x + 1)
    shape = F.when(key == 0, F.format_string('{"type": "Point", "coordinates": [%d, 32.5]}', x))
    shape = shape.when(key == 1, F.concat(F.lit('{"type": "Polygon", "coordinates": ['), square(0, 4), F.lit("]}")))
    shape = shape.when(key == 2, F.concat(F.lit('{"type": "MultiPolygon", "coordinates": [['), square(0, 4), F.lit(", "), triangle, F.lit("], ["), square(5, 4), F.lit("]]}"))).otherwise("null")
    one = F.concat(F.format_string('{"type": "Feature", "properties": {"name": "s%d", "id": %d}, "geometry": ', "s_suppkey", "s_suppkey"), shape, F.lit("}"))
    whole = lambda rows: F.concat(F.lit('{"type": "FeatureCollection", "features": [\n'), _joined(rows, lambda r: r["one"], ",\n"), F.lit("]}"))
    path = _files(supplier.select("s_suppkey", one.alias("one")), "s_suppkey", whole, "shapes")
    read = readers.geojson(spark, path, "name: string, id: long")
    corners = F.flatten(F.coalesce("rings", F.expr("cast(array() as array<array<struct<x:double,y:double>>>)")))
    return read.select("name", "id", "longitude", "latitude", F.size(corners).alias("corners"), F.array_max(F.transform(corners, lambda p: p["x"])).alias("right_most"))


@query("""SELECT s_name AS name, CASE WHEN s_suppkey % 4 IN (1, 3) THEN s_nationkey + 0.25 END::DOUBLE AS longitude, CASE s_suppkey % 4 WHEN 0 THEN 9 WHEN 3 THEN 8 ELSE 0 END AS corners,
CASE WHEN s_suppkey % 4 IN (0, 3) THEN s_nationkey + 4.0 END::DOUBLE AS right_most FROM supplier WHERE s_suppkey % 4 <> 2""")
def read_kml(spark, supplier: DataFrame) -> DataFrame:
    """Polygons with a hole, points, both together in a MultiGeometry, and placemarks without a shape."""
    key, x = F.col("s_suppkey") % 4, F.col("s_nationkey")
    point = F.format_string("<Point><coordinates>%d.25,32.5,0</coordinates></Point>", x)
    ring = lambda tag, text, *at: F.concat(F.lit(f"<{tag}><LinearRing><coordinates>"), F.format_string(text, *at), F.lit(f"</coordinates></LinearRing></{tag}>"))
    outer, three = ring("outerBoundaryIs", "\n%d,0,0 %d,0,0\n%d,4,0 %d,4,0 %d,0,0 ", x, x + 4, x + 4, x, x), ring("outerBoundaryIs", "%d,0 %d,0 %d,4 %d,0", x, x + 4, x, x)
    hole = ring("innerBoundaryIs", "%d,1,0 %d,1,0 %d,2,0 %d,1,0", x + 1, x + 2, x + 1, x + 1)
    polygon = lambda *parts: F.concat(F.lit("<Polygon>"), *parts, F.lit("</Polygon>"))
    shape = F.when(key == 0, polygon(outer, hole)).when(key == 1, point).when(key == 3, F.concat(F.lit("<MultiGeometry>"), polygon(three), point, polygon(three), F.lit("</MultiGeometry>"))).otherwise("")
    one = F.concat(F.lit("<Placemark><name>"), "s_name", F.lit("</name>"), shape, F.lit("</Placemark>"))
    whole = lambda rows: F.concat(F.lit("<kml><Document><Folder>"), _joined(rows, lambda r: r["one"], "\n"), F.lit("</Folder></Document></kml>"))
    found = readers.kml_shapes(spark, _files(supplier.select("s_suppkey", one.alias("one")), "s_suppkey", whole, "kml"))
    corners = F.flatten(F.coalesce("rings", F.expr("cast(array() as array<array<struct<x:double,y:double>>>)")))
    return found.select("name", "longitude", F.size(corners).alias("corners"), F.array_max(F.transform(corners, lambda p: p["x"])).alias("right_most"))


@query("SELECT r_regionkey, r_name AS created FROM region")
def read_xml_value(region: DataFrame) -> DataFrame:
    text = F.concat(F.lit("<metadata><Esri><CreaDate>"), "r_name", F.lit("</CreaDate></Esri></metadata>"))
    return region.select("r_regionkey", readers.xml_value(text, "/metadata/Esri/CreaDate").alias("created"))


@query("""SELECT TIMESTAMP '2024-01-01 00:00:00' + to_hours(s_suppkey) AS date, CASE WHEN s_suppkey % 5 <> 0 THEN s_acctbal END AS temperature, s_nationkey::DOUBLE AS wind FROM supplier""")
def read_column_arrays(spark, supplier: DataFrame) -> DataFrame:
    """Files of parallel arrays, each from its own start on."""
    numbers = lambda rows, each: F.concat(F.lit("["), _joined(rows, each, ", "), F.lit("]"))
    temperature = lambda r: F.when(r["s_suppkey"] % 5 != 0, r["s_acctbal"].cast("string")).otherwise("null")
    start = lambda rows: (rows[0]["s_suppkey"] * 3600 + 1_704_067_200).cast("string")
    whole = lambda rows: F.concat(F.lit('{"time": '), start(rows), F.lit(', "interval": 3600, "temperature": '), numbers(rows, temperature), F.lit(', "wind": '), numbers(rows, lambda r: r["s_nationkey"].cast("string")), F.lit("}"))
    path = _files(supplier.select("s_suppkey", "s_acctbal", "s_nationkey"), "s_suppkey", whole, "columns")
    read = readers.column_arrays(spark, path, "time", "interval", ["temperature", "wind"])
    return read.withColumn("date", F.col("date").cast("timestamp_ntz"))


@query("""WITH r AS (SELECT *, s_suppkey - s_suppkey % 5 AS base FROM supplier)
SELECT CASE WHEN (base // 5) % 2 = 0 THEN 'H2S' ELSE 'CO' END AS parameter, s_name AS site, TIMESTAMP '2024-03-05 08:00:00' + to_days((s_suppkey // 50)::INT) + to_hours(s_suppkey % 24) AS measured,
CASE s_suppkey % 3 WHEN 0 THEN s_nationkey WHEN 1 THEN 5 END::DOUBLE AS value, CASE WHEN s_suppkey % 3 = 1 THEN '<' ELSE '' END AS qualifier, CASE s_suppkey % 3 WHEN 0 THEN s_nationkey::VARCHAR WHEN 1 THEN '<5' ELSE 'M' END AS original
FROM r WHERE base IN (SELECT s_suppkey FROM supplier)""")
def read_hourly_report(spark, supplier: DataFrame) -> DataFrame:
    """A file a day; every fifth row names a parameter, and rows before the first such row of a file go."""
    key = F.col("s_suppkey")
    named = F.when(key % 5 != 0, "").when(F.floor(key / 5) % 2 == 0, "H2S").otherwise("CO")
    reading = F.when(key % 3 == 0, F.col("s_nationkey").cast("string")).when(key % 3 == 1, "<5").otherwise("M")
    one = F.concat(named, F.lit(","), "s_name", F.lit(","), F.repeat(F.lit(","), (key % 24).cast("int")), reading, F.repeat(F.lit(","), (23 - key % 24).cast("int")))
    day = lambda rows: F.date_format(F.date_add(F.lit("2024-03-05").cast("date"), F.floor(rows[0]["s_suppkey"] / FILE_ROWS).cast("int")), "MM/dd/yyyy")
    hours = ",".join(str(h) for h in range(24))
    head = f"\n,,{hours}\nParameter,SiteName{',' * 24}\n"
    whole = lambda rows: F.concat(F.lit("Report\nHourly\nValues (PST),"), day(rows), F.lit(head), _joined(rows, lambda r: r["one"], "\n"), F.lit("\n"))
    return readers.hourly_report(spark, _files(supplier.select("s_suppkey", one.alias("one")), "s_suppkey", whole, "report")).withColumnRenamed("at", "measured")


@query("SELECT l_orderkey, strftime(l_shipdate, '%-m/%-d/%Y') AS start_date, CASE l_returnflag WHEN 'N' THEN 'Ongoing' ELSE l_returnflag END AS end_date, l_quantity::INT || ' million gallons' AS volume FROM lineitem")
def read_html_table(spark, lineitem: DataFrame) -> DataFrame:
    """A page for each order; its lines are in the second table, behind a header and a cumulative row."""
    row = F.concat(F.lit("<tr><td>"), F.date_format("l_shipdate", "M/d/yyyy"), F.lit("</td><td>"), F.when(F.col("l_returnflag") == "N", "Ongoing").otherwise(F.col("l_returnflag")), F.lit("</td><td><b>"), F.col("l_quantity").cast("int").cast("string"), F.lit("</b> million\n gallons</td></tr>"))
    body = F.array_join(F.sort_array(F.collect_list(row)), "")
    start = "<table><tr><td>x</td></tr></table><p>Spills</p><table><tr><th>Start Date</th><th>End Date</th><th>Volume</th></tr><tr><td>all</td><td></td><td>9</td></tr>"
    pages = lineitem.groupBy("l_orderkey").agg(F.concat(F.lit(start), body, F.lit("</table>")).alias("html"))
    rows = html_tables.table_rows(pages, "html", position=1)
    return html_tables.named(rows, ["start_date", "end_date", "volume"]).where("line > 1").drop("table", "line")


@query("SELECT l_orderkey AS page_id, count(*)::INT AS n, (2 * count(*))::INT AS n_rows FROM lineitem GROUP BY 1")
def html_tables_of_pages(lineitem: DataFrame) -> DataFrame:
    """Pages with a table of two rows for each line of an order."""
    one = F.concat(F.lit("<TABLE border=1><tr><th>line<th>part</tr>\n<tr><td>"), F.col("l_linenumber").cast("string"), F.lit("<td>"), F.col("l_partkey").cast("string"), F.lit("</tr></TABLE>"))
    pages = lineitem.groupBy(F.col("l_orderkey").alias("page_id")).agg(F.array_join(F.collect_list(one), "<p>and</p>").alias("html"))
    found = html_tables.table_rows(pages, "html")
    return found.groupBy("page_id").agg(F.count_distinct("table").cast("int").alias("n"), F.count(F.lit(1)).cast("int").alias("n_rows"))


@query("SELECT c_custkey, c_name, c_nationkey::VARCHAR AS week, c_acctbal AS cases FROM customer WHERE c_custkey % 11 <> 3")
def read_paged_feed(spark, customer: DataFrame) -> DataFrame:
    """Pages of 100 rows by rank, as keys have gaps, written by Spark to the shared folder and read from there."""
    given = F.to_json(F.struct("c_custkey", "c_name", F.col("c_nationkey").cast("string").alias("week"), F.col("c_acctbal").alias("cases")))
    numbered = relational.row_numbers(customer.where("c_custkey % 11 <> 3").select("c_custkey", given.alias("one")), ["c_custkey"], "n")
    page = F.floor((F.col("n") - 1) / 100) * 100
    path = new_folder(spark, "pages")
    numbered.groupBy(page.alias("k")).agg(F.concat(F.lit("["), F.array_join(F.collect_list("one"), ","), F.lit("]")).alias("value")).write.partitionBy("k").text(path)
    return readers.paged(spark, path, "c_custkey long, c_name string, week string, cases double", numbered.count(), page=None)


@query("SELECT n_regionkey, sum(strlen(n_name) + 1)::BIGINT AS length, md5(string_agg(n_name || chr(10), '' ORDER BY n_nationkey)) AS content FROM nation GROUP BY 1")
def land_raw_copy(spark, nation: DataFrame) -> DataFrame:
    """Files are copied as they are before they are parsed: the bytes of each copy."""
    path = new_folder(spark, "source")
    nation.select("n_regionkey", "n_nationkey", "n_name").repartition(1).sortWithinPartitions("n_regionkey", "n_nationkey").drop("n_nationkey").write.partitionBy("n_regionkey").text(path)
    raw = readers.landed(spark, path, new_folder(spark, "raw"))
    region = F.regexp_extract("path", "n_regionkey=([0-9]+)", 1).cast("int")
    return raw.select(region.alias("n_regionkey"), "length", F.md5("content").alias("content"))


@query("SELECT o_orderpriority AS priority, count(*) AS n FROM orders GROUP BY 1")
def parquet_partitions(spark, orders: DataFrame) -> DataFrame:
    path = new_folder(spark, "partitions")
    sinks.to_parquet(orders.select("o_orderkey", F.col("o_orderpriority").alias("priority")), path, ["priority"])
    urgent = orders.where("o_orderpriority LIKE '1%'").select("o_orderkey", F.col("o_orderpriority").alias("priority"))
    sinks.to_parquet(urgent, path, ["priority"])  # replaces that partition only
    return spark.read.parquet(path).groupBy("priority").agg(F.count("o_orderkey").alias("n"))


@query("SELECT r_regionkey, '{\"r_regionkey\":' || r_regionkey || CASE WHEN r_regionkey = 0 THEN ',\"name\":null}' ELSE ',\"name\":\"' || r_name || '\"}' END AS kept, '{\"r_regionkey\":' || r_regionkey || CASE WHEN r_regionkey = 0 THEN '}' ELSE ',\"name\":\"' || r_name || '\"}' END AS short FROM region")
def json_records(region: DataFrame) -> DataFrame:
    holes = region.select("r_regionkey", F.when(F.col("r_regionkey") != 0, F.col("r_name")).alias("name"))
    return holes.select("r_regionkey", sinks.records(holes).alias("kept"), sinks.records(holes, keep_nulls=False).alias("short"))


@query("SELECT r_regionkey, strlen(r_name) + 1 AS length FROM region")
def list_objects(spark, region: DataFrame) -> DataFrame:
    """An object for each region, listed with its size."""
    path = new_folder(spark, "objects")
    region.select("r_regionkey", "r_name").write.partitionBy("r_regionkey").text(path)
    return readers.whole_files(spark, path, "*.txt").select(F.regexp_extract("path", "r_regionkey=([0-9]+)", 1).cast("int").alias("r_regionkey"), "length")


@query("SELECT 'p' || page_id // 100 || '/' || page_id || '.html' AS name, strlen(html) AS length, sha256(html) AS sha256, strlen(html) AS read_length, md5(html) AS read_content FROM pages")
def store_objects(spark, pages: DataFrame) -> DataFrame:
    """An object for each page, as it was written and as it is read back."""
    folder = new_folder(spark, "objects")
    name = F.concat(F.lit("p"), F.floor(F.col("page_id") / 100).cast("string"), F.lit("/"), F.col("page_id").cast("string"), F.lit(".html"))
    put = sinks.put_objects(pages.select(name.alias("name"), "html"), folder, "name", "html")
    read = readers.whole_files(spark, folder, "*.html").select(F.regexp_extract("path", "(p[0-9]+/[0-9]+[.]html)$", 1).alias("name"), F.col("length").alias("read_length"), F.md5("content").alias("read_content"))
    return put.join(read, "name")


@query("SELECT l_orderkey, l_linenumber::INT AS l_linenumber, CASE WHEN l_quantity > 10 THEN l_quantity END AS quantity, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS line FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey, l_suppkey) = 1)")
def json_document(spark, lineitem: DataFrame) -> DataFrame:
    """All lines as the records of one document, in their order; read back line by line, with each record's place in the file."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    once = lineitem.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.max("l_quantity").alias("q")).where("n = 1").orderBy(*keys)
    rows = once.select("l_orderkey", F.col("l_linenumber").cast("int").alias("l_linenumber"), F.when(F.col("q") > 10, F.col("q")).alias("quantity"))
    path = new_folder(spark, "document")
    sinks.document(rows.select(sinks.records(rows).alias("one")), path, "data", "2024-01-01")
    # lines keep their order inside a file, and the one file is read by ranges of bytes in order
    numbered = new_folder(spark, "numbered")
    spark.read.text(path).withColumn("m", F.monotonically_increasing_id()).write.parquet(numbered)
    lines = relational.row_numbers(spark.read.parquet(numbered), ["m"], "n").where("n > 1 AND value <> ']}'")
    record = F.from_json(F.regexp_replace("value", "^,", ""), "l_orderkey long, l_linenumber int, quantity double")
    return lines.select(record.alias("r"), (F.col("n") - 1).alias("line")).select("r.*", "line")


@query("SELECT 'csv' AS format, CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END AS balance, count(*) AS n FROM customer GROUP BY 2 UNION ALL SELECT 'json', CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END, count(*) FROM customer GROUP BY 2")
def publish_series(spark, customer: DataFrame) -> DataFrame:
    """One column as CSV and as a JSON document, read back: how often each value occurs, nulls included."""
    column = customer.select(F.when(F.col("c_custkey") % 3 != 0, F.col("c_acctbal").cast("double")).alias("balance"))
    folders = sinks.to_series(column, "balance", new_folder(spark, "series"), "2024-01-01")
    from_csv = readers.csv(spark, folders["csv"], "balance string").select(F.lit("csv").alias("format"), F.col("balance").try_cast("double").alias("balance"))
    lines = spark.read.text(folders["json"]).where("NOT startswith(value, '{') AND value <> ']}'")
    from_json = lines.select(F.lit("json").alias("format"), F.regexp_replace("value", "^,", "").try_cast("double").alias("balance"))
    return from_csv.unionByName(from_json).groupBy("format", "balance").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT 'n' || n_nationkey AS label, n_regionkey::VARCHAR AS year, 'w' || n_nationkey % 3 AS week, n_nationkey / 2.0::DOUBLE AS cases FROM nation WHERE n_regionkey = 2 AND n_nationkey / 2.0 > 1")
def feed_pushdown(spark, nation: DataFrame) -> DataFrame:
    """A paged feed as a data source: the equality is tested by its readers, the comparison by Spark."""
    paged.register(spark)
    path, limit = new_folder(spark, "feed"), 7
    key = F.col("n_nationkey")
    one = F.to_json(F.struct(F.concat(F.lit("n"), key).alias("label"), F.col("n_regionkey").cast("string").alias("year"), F.concat(F.lit("w"), key % 3).alias("week"), (key / 2.0).cast("double").alias("cases")))
    numbered = relational.row_numbers(nation.select("n_nationkey", one.alias("one")), ["n_nationkey"], "n")
    offset = F.floor((F.col("n") - 1) / limit) * limit
    pages = numbered.groupBy(offset.alias("k")).agg(F.concat(F.lit("["), F.array_join(F.collect_list("one"), ","), F.lit("]")).alias("page"))
    sinks.put_objects(pages.select(F.concat(F.lit("page-"), F.col("k").cast("string"), F.lit(".json")).alias("name"), "page"), path, "name", "page")
    feed = spark.read.format("paged_feed").options(path=path, count=str(numbered.count()), limit=str(limit)).load()
    return feed.where("year = '2' AND cases > 1")
