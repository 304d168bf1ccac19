"""Readers of landing-zone files, each with a declared schema. Files are one row each only where their layout needs it."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import parse_qualifier
from ..functions.times import report_hour
from ..operators.relational import forward_fill

CORRUPT = "_corrupt"


def _with_corrupt(schema: str) -> str:
    return f"{schema}, {CORRUPT} string"


def csv(spark: SparkSession, path: str, schema: str, separator: str = ",", header: bool = True) -> DataFrame:
    """Delimited text; lines that don't fit the schema keep what fits and are whole in ``_corrupt``."""
    return spark.read.csv(path, schema=_with_corrupt(schema), sep=separator, header=header, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)


def csv_with_preamble(spark: SparkSession, path: str, schema: str, skip: int, footer: int) -> DataFrame:
    """CSV behind ``skip`` lines (the header is the last of them) and before ``footer`` lines; a file is one row at first."""
    lines = F.filter(F.split("value", r"\r?\n"), lambda x: F.trim(x) != "")
    body = F.slice(lines, F.lit(skip + 1), F.greatest(F.size(lines) - skip - footer, F.lit(0)))
    rows = spark.read.text(path, wholetext=True).select(F.explode(body).alias("line"))
    return rows.select(F.from_csv("line", schema).alias("r")).select("r.*")


def json_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON array of objects, or one object a file."""
    return spark.read.schema(schema).json(path, multiLine=True)


def flattened(df: DataFrame, separator: str = ".") -> DataFrame:
    """Nested structs as columns named by their path."""

    def walk(schema: StructType, path: list[str]) -> list[Column]:
        out = []
        for f in schema.fields:
            here = [*path, f.name]
            if isinstance(f.dataType, StructType):
                out += walk(f.dataType, here)
            else:
                out.append(F.col(".".join(f"`{p}`" for p in here)).alias(separator.join(here)))
        return out

    return df.select(*walk(df.schema, []))


def fields_and_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """{"fields": [names], "data": [[values]]}: columns are found by name, whatever their order; missing ones are null."""
    wanted = StructType.fromDDL(schema)
    raw = spark.read.schema("fields array<string>, data array<array<string>>").json(path, multiLine=True)
    rows = raw.select("fields", F.explode("data").alias("row"))
    at = lambda name: F.array_position("fields", F.lit(name)).cast("int")
    return rows.select(*(F.when(at(f.name) > 0, F.try_element_at("row", at(f.name))).try_cast(f.dataType).alias(f.name) for f in wanted.fields))


def ragged_series(spark: SparkSession, path: str) -> DataFrame:
    """(week_start_date, cases) from result rows C = [ms, count], [ms], or a note.

    Two values or more: date and count; one whole number: a date without a count; anything else is skipped.
    """
    shape = "results array<struct<result: struct<data: struct<dsr: struct<DS: array<struct<PH: array<struct<DM1: array<struct<C: array<string>>>>>>>>>>>>"
    raw = spark.read.schema(shape).json(path, multiLine=True)
    rows = raw.select(F.explode(F.col("results")[0]["result"]["data"]["dsr"]["DS"][0]["PH"][1]["DM1"]).alias("r")).select("r.C")
    ms, n = F.try_element_at("C", F.lit(1)).try_cast("long"), F.size("C")
    kept = rows.where((n >= 1) & ms.isNotNull())
    return kept.select(F.timestamp_millis(ms).cast("date").alias("week_start_date"), F.when(n >= 2, F.try_element_at("C", F.lit(2)).try_cast("double")).alias("cases"))


def geojson(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """Features of a collection: the properties' columns, and longitude and latitude for points or rings for polygons.

    A MultiPolygon's rings stand one after another, holes included, which the even-odd tests of ``spatial`` need only.
    """
    shape = f"features array<struct<properties: struct<{properties}>, geometry: struct<type: string, coordinates: string>>>"
    feature = spark.read.schema(shape).json(path, multiLine=True).select(F.explode("features").alias("f"))
    kind, given = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    point = F.when(kind == "Point", F.from_json(given, "array<double>"))
    polygon = F.when(kind == "Polygon", F.from_json(given, "array<array<array<double>>>"))
    polygon = polygon.when(kind == "MultiPolygon", F.flatten(F.from_json(given, "array<array<array<array<double>>>>")))
    rings = F.transform(polygon, lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    return feature.select("f.properties.*", point[0].alias("longitude"), point[1].alias("latitude"), rings.alias("rings"))


_KML_POINT = "struct<coordinates: string>"
_KML_RING = "struct<LinearRing: struct<coordinates: string>>"
_KML_POLYGON = f"struct<outerBoundaryIs: {_KML_RING}, innerBoundaryIs: array<{_KML_RING}>>"


def kml_shapes(spark: SparkSession, path: str) -> DataFrame:
    """(name, longitude, latitude, rings) of the placemarks with a shape.

    Points and polygons stand alone or in a MultiGeometry; the place is that of the first point; rings are those of all
    polygons, holes included, as in ``geojson``, and null where there is none.
    """
    shape = f"name string, Point {_KML_POINT}, Polygon {_KML_POLYGON}, MultiGeometry struct<Point: array<{_KML_POINT}>, Polygon: array<{_KML_POLYGON}>>"
    marks = spark.read.format("xml").option("rowTag", "Placemark").schema(shape).load(path)

    def all_of(tag: str) -> Column:
        return F.filter(F.concat(F.array(tag), F.coalesce(f"MultiGeometry.{tag}", F.array(F.lit(None).cast(marks.schema[tag].dataType)))), lambda x: x.isNotNull())

    def corner(c: Column) -> Column:
        parts = F.split(c, ",")
        return F.struct(parts[0].try_cast("double").alias("x"), parts[1].try_cast("double").alias("y"))

    def ring(r: Column) -> Column:
        return F.transform(F.split(F.trim(r["LinearRing"]["coordinates"]), r"\s+"), corner)

    none = F.array(F.lit(None).cast(_KML_RING))
    bounds = F.flatten(F.transform(all_of("Polygon"), lambda p: F.concat(F.array(p["outerBoundaryIs"]), F.coalesce(p["innerBoundaryIs"], none))))
    rings = F.transform(F.filter(bounds, lambda r: r.isNotNull()), ring)
    place = corner(F.trim(F.get(all_of("Point"), F.lit(0))["coordinates"]))
    shaped = marks.where(F.col("Point").isNotNull() | F.col("Polygon").isNotNull() | F.col("MultiGeometry").isNotNull())
    return shaped.select("name", place["x"].alias("longitude"), place["y"].alias("latitude"), F.when(F.size(rings) > 0, rings).alias("rings"))


def kml_polygons(spark: SparkSession, path: str) -> DataFrame:
    """(name, rings) of the placemarks with a polygon."""
    return kml_shapes(spark, path).where(F.col("rings").isNotNull()).select("name", "rings")


def xml_value(text: Column, path: str) -> Column:
    """The text of one XML element, such as a layer's creation date."""
    return F.xpath_string(text, F.lit(path))


def column_arrays(spark: SparkSession, path: str, start: str, interval: str, columns: list[str]) -> DataFrame:
    """One row for each element of parallel arrays; time = start + position * interval seconds (both epoch seconds)."""
    arrays = ", ".join(f"`{c}` array<double>" for c in columns)
    raw = spark.read.schema(f"`{start}` long, `{interval}` long, {arrays}").json(path, multiLine=True)
    rows = raw.select(start, interval, F.posexplode(F.arrays_zip(*columns)).alias("pos", "v"))
    return rows.select(F.timestamp_seconds(F.col(start) + F.col("pos") * F.col(interval)).alias("date"), *(F.col(f"v.{c}").alias(c) for c in columns))


def hourly_report(spark: SparkSession, path: str) -> DataFrame:
    """(parameter, site, at, value, qualifier, original) from wide hourly reports, one file a day.

    Line 3 has the date (the text after '),' if there is a comma), line 4 the hours 0 to 23 in columns; rows follow from
    line 6. A blank parameter is that of the row before it in the file; rows before the first one go. Hours count at a
    fixed offset of eight hours behind UTC. Blank readings go; censored ones keep their qualifier and their text.
    """
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.split("value", r"\r?\n").alias("lines"))
    date_line = F.col("lines")[2]
    date_text = F.when(F.contains(date_line, F.lit(",")), F.try_element_at(F.split(F.trim(date_line), r"\),"), F.lit(2))).otherwise(date_line)
    day = F.try_to_timestamp(F.trim(date_text), F.lit("M/d/yyyy")).cast("date")
    first_hour = F.array_position(F.transform(F.split(F.col("lines")[3], ","), lambda c: F.trim(c)), F.lit("0"))
    cells = files.select("file", day.alias("day"), first_hour.cast("int").alias("first"), F.posexplode(F.slice("lines", F.lit(6), F.size("lines"))).alias("line", "text"))
    rows = cells.select("file", "day", "first", "line", F.split(F.trim("text"), ",").alias("c"))
    rows = rows.where((F.size("c") > 1) & (F.col("c")[0] != "Parameter"))
    named = forward_fill(rows.withColumn("parameter", F.nullif(F.col("c")[0], F.lit(""))), "parameter", ["file"], ["line"]).where(F.col("parameter").isNotNull())
    hours = named.select("parameter", F.col("c")[1].alias("site"), "day", F.posexplode(F.slice("c", F.col("first"), F.lit(24))).alias("hour", "original"))
    given = hours.withColumn("original", F.trim("original")).where(F.col("original") != "")
    read = given.withColumn("r", parse_qualifier(F.col("original")))
    return read.select("parameter", "site", report_hour(F.col("day"), F.col("hour")).alias("at"), "r.value", "r.qualifier", "original")


def inline(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table written in code."""
    return spark.createDataFrame(rows, schema)


def whole_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, modificationTime, length, content): a listing of an object store's folder, and the objects themselves."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)


def paged(spark: SparkSession, path: str, schema: str, count: int, limit: int = 1000, page: str | None = "page-{}.json") -> DataFrame:
    """A feed's pages (arrays of objects) on any store that Spark reads, a task or more for each.

    ``count`` rows in all, as the feed says, and ``limit`` a page; pages are named by their offset, or, with ``page=None``, are
    all files of the folder, which Spark lists. A page that is missing or is no array of such objects fails the read, and so
    does another number of rows, so nothing is left out or counted twice unseen.
    """
    if not count:
        return spark.createDataFrame([], schema)
    paths = [f"{path}/{page.format(k)}" for k in range(0, count, limit)] if page else [path]
    rows = spark.read.schema(schema).option("mode", "FAILFAST").option("recursiveFileLookup", str(page is None).lower()).json(paths, multiLine=True)
    found = rows.count()
    if found != count:
        raise ValueError(f"the pages in {path} have {found} rows, and not {count}")
    return rows


def landed(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """A raw copy of the files at ``path``, made before anything parses them: (path, length, content, landed_at) is added
    to the table in ``folder``, and this call's rows are returned.
    """
    batch = uuid.uuid4().hex
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    files.select("path", "length", "content", F.current_timestamp().alias("landed_at"), F.lit(batch).alias("batch")).write.mode("append").partitionBy("batch").parquet(folder)
    return spark.read.parquet(folder).where(F.col("batch") == batch).drop("batch")
