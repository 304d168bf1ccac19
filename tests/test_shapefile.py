"""Shapefiles: round trips through partitions and ranges of records, and files laid out by hand."""

import datetime
import os
import struct

import pytest

from saltmarsh.operators.spatial import RINGS
from saltmarsh.sources import shapefile

SCHEMA = f"id long, name string, x double, ok boolean, day date, shape string, longitude double, latitude double, rings {RINGS}"


def part(*points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


SQUARE, HOLE = part((0, 0), (0, 4), (4, 4), (4, 0), (0, 0)), part((1, 1), (2, 1), (2, 2), (1, 2), (1, 1))
ROWS = [
    (1, "Ünï 你", -1.5, True, datetime.date(2024, 2, 29), "point", -117.25, 32.5, None),
    (2, None, None, None, None, "polygon", None, None, [SQUARE, HOLE]),
    (-3, " inner  space", 1e-300, False, datetime.date(1970, 1, 1), "line", None, None, [part((0, 0), (1, 1)), part((5, 5), (6, 7), (8, 9))]),
    (4, "x" * 200, 12345678.25, None, None, "multipoint", None, None, [part((1, 2), (3, 4))]),
    (5, "", 0.1, True, None, None, None, None, None),
]


@pytest.fixture(scope="module")
def registered(spark):
    shapefile.register(spark)
    return spark


def values(rows):
    plain = lambda rings: None if rings is None else [[(p["x"], p["y"]) for p in r] for r in rings]
    return sorted(((r[0], r[1] or None, *r[2:8], plain(r[8])) for r in rows), key=str)


@pytest.mark.parametrize("parts", [1, 3])
def test_round_trip(registered, tmp_path, parts):
    df = registered.createDataFrame(ROWS, SCHEMA).repartition(parts)
    df.write.format("shapefile").mode("append").save(str(tmp_path))
    read = registered.read.format("shapefile").load(str(tmp_path))
    assert [f.name for f in read.schema] == [f.name for f in df.schema] and values(read.collect()) == values(map(tuple, ROWS))
    assert not [n for n in os.listdir(tmp_path) if n.startswith("_")]
    df.limit(2).write.format("shapefile").mode("overwrite").save(str(tmp_path))
    assert registered.read.format("shapefile").load(str(tmp_path)).count() == 2
    df.limit(1).write.format("shapefile").mode("append").save(str(tmp_path))
    assert registered.read.format("shapefile").load(f"file://{tmp_path}").count() == 3


def test_many_records_in_several_tasks(registered, tmp_path):
    from pyspark.sql import functions as F

    table = registered.range(5000).select("id", (F.col("id") / 10).alias("longitude"), (F.col("id") / 100).alias("latitude"), F.lit("point").alias("shape"))
    table.coalesce(1).write.format("shapefile").mode("append").save(str(tmp_path))
    one = next(os.path.join(d, n) for d, _, names in os.walk(tmp_path) for n in names if n.endswith(".shp"))
    read = registered.read.format("shapefile").option("rowsPerPartition", "700").load(one)
    assert read.rdd.getNumPartitions() == 8
    wrong = read.where("longitude <> id / 10 OR latitude <> id / 100 OR shape <> 'point'")
    assert read.agg(F.count("id"), F.sum("id")).first() == (5000, 4999 * 2500) and wrong.count() == 0
    assert read.select("latitude").where("id = 4999").first()["latitude"] == 49.99


def by_hand(folder, contents, records, fields, size):
    """A shapefile of given record contents, and attribute records of bytes."""
    at, index, body = 100, b"", b""
    for n, c in enumerate(contents, 1):
        index += struct.pack(">ii", at // 2, len(c) // 2)
        body += struct.pack(">ii", n, len(c) // 2) + c
        at += 8 + len(c)
    for name, data in (("shp", body), ("shx", index)):
        head = struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + len(data)) // 2) + struct.pack("<2i8d", 1000, 15, *[0.0] * 8)
        (folder / f"own.{name}").write_bytes(head + data)
    table = struct.pack("<4BIHH20x", 3, 99, 1, 1, len(records), 32 * (len(fields) + 1) + 1, size)
    for name, kind, n, decimals in fields:
        table += struct.pack("<11sc4xBB14x", name, kind, n, decimals)
    (folder / "own.dbf").write_bytes(table + b"\r" + b"".join(records))
    return str(folder / "own.shp")


def test_layouts_by_hand(registered, tmp_path):
    """Shapes with Z, deleted records, numbers in odd forms, Latin text."""
    z_polygon = struct.pack("<i4d2i1i", 15, 0, 0, 1, 1, 1, 4, 0) + struct.pack("<8d", 0, 0, 0, 1, 1, 1, 0, 0) + struct.pack("<2d4d", 0, 9, 1, 2, 3, 1)
    z_point = struct.pack("<idddd", 11, 7.5, -8.5, 3.0, 0.0)
    m_line = struct.pack("<i4d2i1i", 23, 0, 0, 1, 1, 1, 2, 0) + struct.pack("<4d", 0, 0, 1, 2) + struct.pack("<2d2d", 0, 1, 0, 1)
    fields = [(b"CODE", b"N", 5, 0), (b"SHARE", b"N", 7, 2), (b"NAME", b"C", 6, 0), (b"FLAG", b"L", 1, 0), (b"DAY", b"D", 8, 0)]
    records = [b"    12   3.25caf\xe9  T20240305", b"*   13   1.00gone  F20240101", b"  ***********nix   ?00000000", b"    -7    -.5      n        "]
    path = by_hand(tmp_path, [z_polygon, z_point, m_line, z_point], records, fields, 28)
    rows = {r["CODE"]: r for r in registered.read.format("shapefile").option("encoding", "latin-1").load(path).collect()}
    assert set(rows) == {12, None, -7}
    assert (rows[12]["SHARE"], rows[12]["NAME"], rows[12]["FLAG"], rows[12]["DAY"], rows[12]["shape"]) == (3.25, "café", True, datetime.date(2024, 3, 5), "polygon")
    assert [(p["x"], p["y"]) for p in rows[12]["rings"][0]] == [(0, 0), (0, 1), (1, 1), (0, 0)]
    assert (rows[None]["SHARE"], rows[None]["FLAG"], rows[None]["DAY"], rows[None]["shape"], len(rows[None]["rings"])) == (None, None, None, "line", 1)
    assert (rows[-7]["SHARE"], rows[-7]["NAME"], rows[-7]["FLAG"], rows[-7]["longitude"], rows[-7]["latitude"]) == (-0.5, None, False, 7.5, -8.5)


def test_what_does_not_fit_is_an_error(registered, tmp_path):
    from pyspark.sql import functions as F

    point = registered.range(1).select(F.lit(1.0).alias("longitude"), F.lit(2.0).alias("latitude"))
    for bad in (point.withColumn("a_long_name_indeed", F.lit(1)), point.withColumn("t", F.current_timestamp()), point.withColumn("t", F.repeat(F.lit("x"), 300))):
        with pytest.raises(Exception, match="attribute"):
            bad.write.format("shapefile").mode("append").save(str(tmp_path / "bad"))
    assert not [n for _, _, names in os.walk(tmp_path) for n in names]
    with pytest.raises(Exception, match="no shapefile"):
        registered.read.format("shapefile").load(str(tmp_path)).count()


def test_a_writer_holds_no_more_than_a_file(spark, tmp_path, monkeypatch):
    import weakref

    from pyarrow import fs
    from pyspark.sql import types

    monkeypatch.setattr(shapefile, "FILE_ROWS", 100)
    alive, most = weakref.WeakSet(), [0]

    class Ring(list):
        pass

    def rows():
        for k in range(1050):
            ring = Ring([{"x": float(k), "y": 0.0}, {"x": k + 1.0, "y": 1.0}, {"x": float(k), "y": 1.0}, {"x": float(k), "y": 0.0}])
            ring.__class__.__hash__ = lambda self: id(self)
            alive.add(ring)
            most[0] = max(most[0], len(alive))
            yield (k, "polygon" if k % 3 else None, [ring] if k % 3 else None)
            del ring

    schema = types.StructType.fromDDL("id bigint, shape string, rings " + shapefile.RINGS)
    store = fs.LocalFileSystem()
    writer = shapefile._Writer(store, str(tmp_path), schema, False, {})
    writer.commit([writer.write(rows())])
    assert most[0] <= 3
    paths = sorted(str(p) for p in tmp_path.rglob("*.shp"))
    assert len(paths) == 11  # seven of polygons, four of empty records
    read = types.StructType.fromDDL("id bigint, shape string, longitude double, latitude double, rings " + shapefile.RINGS)
    reader = shapefile._Reader(store, paths, read, {})
    found = {r["id"]: r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()}
    assert sorted(found) == list(range(1050))
    assert all((r["shape"] == "polygon") == (k % 3 > 0) and (r["rings"] or [[{"x": k}]])[0][0]["x"] == k for k, r in found.items())
