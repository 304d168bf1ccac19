"""Shapefiles as a Spark data source: shapes from ``.shp``, their places in it from ``.shx``, attributes from ``.dbf``.

``spark.read.format("shapefile").load(path)`` reads one shapefile (a path that ends in .shp) or all of a folder. Both the
index and the attribute file have records of fixed size, so each file is cut into ranges of records: a task seeks to its
range in all three files, and a large file is read by many tasks. Files are opened through Arrow, so a path may be on any
store that Arrow reaches.

Columns: the attributes, then ``shape`` (point, line, polygon or multipoint; null for an empty record), ``longitude`` and
``latitude`` (points), and ``rings`` (parts of lines and polygons, points of a multipoint as one part). Z and M are left out.

``df.write.format("shapefile").mode("append" or "overwrite").save(folder)`` writes a shapefile for each partition, and more than one where it is
large. Files get their names only when the whole job has succeeded, so a lost task leaves nothing behind that a reader would see.
"""

from __future__ import annotations

import datetime
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession, types
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from ..operators.spatial import RINGS
from .stores import opened

# Fixed values of the public format: type codes (those above ten have Z or M), header sizes, and the mark of an empty date.
SHAPES = {0: None, 1: "point", 3: "line", 5: "polygon", 8: "multipoint", 11: "point", 13: "line", 15: "polygon", 18: "multipoint", 21: "point", 23: "line", 25: "polygon", 28: "multipoint"}
CODES = {"point": 1, "line": 3, "polygon": 5, "multipoint": 8}
HEADER, INDEX = 100, 8
#: Bytes of shapes, and records, that one task reads at most.
PART_BYTES, PART_ROWS = 32 << 20, 100_000
#: Bytes of shapes and attributes, and records, that a writer holds before it writes a file; records that a reader holds.
FILE_BYTES, FILE_ROWS, READ_ROWS = 16 << 20, 50_000, 5_000
PLACES = (("shape", "string"), ("longitude", "double"), ("latitude", "double"), ("rings", RINGS))

_POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])
_ARROW = {"string": pa.string(), "bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "date": pa.date32()}


@dataclass
class Field:
    name: str
    kind: str
    size: int
    decimals: int

    @property
    def spark(self) -> str:
        if self.kind in "NF":
            return "bigint" if self.decimals == 0 and self.kind == "N" and self.size <= 18 else "double"
        return {"L": "boolean", "D": "date"}.get(self.kind, "string")

    def value(self, raw: bytes, encoding: str):
        text = raw.decode(encoding, "replace").rstrip(" \0")
        if self.kind not in "NFLD":
            return text or None
        text = text.strip()
        if self.kind in "NF":
            if not text or set(text) <= set("*"):
                return None
            return int(text) if self.spark == "bigint" else float(text)
        if self.kind == "L":
            return {"t": True, "y": True, "f": False, "n": False}.get(text.lower())
        return datetime.date(int(text[:4]), int(text[4:6]), int(text[6:8])) if text.isdigit() and int(text) else None


def _fields(f) -> tuple[int, int, int, list[Field]]:
    """(records, header bytes, record bytes, fields) of an attribute file."""
    records, header, size = struct.unpack("<IHH", f.read(12)[4:])
    raw = f.read(header - 12)[20:]
    out = []
    for at in range(0, len(raw) - 31, 32):
        if raw[at] == 0x0D:
            break
        out.append(Field(raw[at : at + 11].split(b"\0")[0].decode("ascii", "replace"), chr(raw[at + 11]), raw[at + 16], raw[at + 17]))
    return records, header, size, out


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int


class Shapefile(DataSource):
    """Option ``encoding`` of the attributes' text, utf-8 unless given."""

    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def _paths(self) -> list[str]:
        store, path = opened(self.options["path"])
        if path.endswith(".shp"):
            return [path]
        found = store.get_file_info(fs.FileSelector(path, recursive=True))
        return sorted(x.path for x in found if x.path.endswith(".shp") and not x.base_name.startswith(("_", ".")))

    def schema(self) -> str:
        store, _ = opened(self.options["path"])
        paths = self._paths()
        if not paths:
            raise ValueError(f"no shapefile in {self.options['path']}")
        with store.open_input_file(paths[0][:-4] + ".dbf") as f:
            fields = _fields(f)[3]
        return ", ".join([*(f"`{x.name}` {x.spark}" for x in fields), *(f"{n} {k}" for n, k in PLACES)])

    def reader(self, schema: types.StructType) -> DataSourceReader:
        store, _ = opened(self.options["path"])
        return _Reader(store, self._paths(), schema, self.options)

    def writer(self, schema: types.StructType, overwrite: bool) -> DataSourceWriter:
        store, path = opened(self.options["path"])
        return _Writer(store, path, schema, overwrite, self.options)


class _Reader(DataSourceReader):
    def __init__(self, store: fs.FileSystem, paths: list[str], schema: types.StructType, options: dict) -> None:
        self.store, self.paths, self.schema = store, paths, schema
        self.encoding = options.get("encoding", "utf-8")
        self.rows = int(options.get("rowsPerPartition", PART_ROWS))

    def partitions(self) -> list[InputPartition]:
        """Ranges of records. The number of a file's records is known from its index's size, so nothing is read here."""
        out = []
        for info, shapes in zip(self.store.get_file_info([p[:-4] + ".shx" for p in self.paths]), self.store.get_file_info(self.paths)):
            records = (info.size - HEADER) // INDEX
            step = max(1, min(self.rows, records * PART_BYTES // max(shapes.size, 1)))
            out += [Range(shapes.path, a, min(a + step, records)) for a in range(0, records, step)]
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        for start in range(partition.start, partition.end, READ_ROWS):
            yield self._batch(partition.path[:-4], start, min(READ_ROWS, partition.end - start))

    def _batch(self, base: str, start: int, n: int) -> pa.RecordBatch:
        with self.store.open_input_file(f"{base}.shx") as f:
            index = np.frombuffer(f.read_at(n * INDEX, HEADER + start * INDEX), ">i4").reshape(-1, 2).astype(np.int64) * 2
        with self.store.open_input_file(f"{base}.dbf") as f:
            _, header, size, fields = _fields(f)
            records = f.read_at(n * size, header + start * size)
        with self.store.open_input_file(f"{base}.shp") as f:
            low, high = int(index[:, 0].min()), int((index[:, 0] + index[:, 1]).max()) + 8
            shapes = f.read_at(high - low, low)
        columns = {}
        at = 1  # behind the mark of deletion
        for x in fields:
            columns[x.name] = [x.value(records[k * size + at : k * size + at + x.size], self.encoding) for k in range(n)]
            at += x.size
        places = [_shape(shapes[a + 8 - low : a + 8 - low + length]) for a, length in index.tolist()]
        kept = [k for k in range(n) if records[k * size : k * size + 1] != b"*"]
        arrays = []
        for field in self.schema.fields:
            if field.name in columns:
                arrays.append(pa.array([columns[field.name][k] for k in kept], _ARROW[field.dataType.simpleString()]))
            else:
                i = [name for name, _ in PLACES].index(field.name)
                kind = pa.list_(pa.list_(_POINT)) if i == 3 else pa.float64() if i else pa.string()
                arrays.append(pa.array([places[k][i] for k in kept], kind))
        return pa.RecordBatch.from_arrays(arrays, names=self.schema.fieldNames())


def _shape(content: bytes) -> tuple:
    """(shape, longitude, latitude, rings) of a record."""
    kind = SHAPES.get(struct.unpack_from("<i", content)[0])
    if kind is None:
        return None, None, None, None
    if kind == "point":
        return kind, *struct.unpack_from("<dd", content, 4), None
    if kind == "multipoint":
        (points,) = struct.unpack_from("<i", content, 36)
        starts, at = [0], 40
    else:
        parts, points = struct.unpack_from("<ii", content, 36)
        starts, at = list(struct.unpack_from(f"<{parts}i", content, 44)), 44 + 4 * parts
    xy = np.frombuffer(content, "<f8", 2 * points, at).reshape(-1, 2).tolist()
    return kind, None, None, [[{"x": x, "y": y} for x, y in xy[a:b]] for a, b in zip(starts, [*starts[1:], points])]


class _Group:
    """Records of one type in the form in which they are written, and their box."""

    def __init__(self) -> None:
        self.contents: list[bytes] = []
        self.texts: list[list[bytes]] = []
        self.box: list[float] = []
        self.bytes = 0

    def add(self, content: bytes, corners: list, texts: list[bytes]) -> None:
        self.contents.append(content)
        self.texts.append(texts)
        self.bytes += len(content) + sum(map(len, texts))
        self._widen(corners)

    def _widen(self, corners: list) -> None:
        for x, y in corners:
            self.box = [min(self.box[0], x), min(self.box[1], y), max(self.box[2], x), max(self.box[3], y)] if self.box else [x, y, x, y]

    def take(self, other: _Group) -> None:
        self.contents += other.contents
        self.texts += other.texts
        self.bytes += other.bytes
        self._widen([other.box[:2], other.box[2:]] if other.box else [])


@dataclass
class _Written(WriterCommitMessage):
    path: str | None


class _Writer(DataSourceWriter):
    """A shapefile holds one type of shape, so a partition writes a file for each type that it has, and for each ``FILE_BYTES``
    or ``FILE_ROWS`` of it.
    """

    def __init__(self, store: fs.FileSystem, path: str, schema: types.StructType, overwrite: bool, options: dict) -> None:
        self.store, self.path, self.overwrite = store, path.rstrip("/"), overwrite
        self.encoding = options.get("encoding", "utf-8")
        self.names = schema.fieldNames()
        known = {n for n, _ in PLACES}
        self.kinds = {f.name: f.dataType.simpleString() for f in schema.fields if f.name not in known}
        wrong = [c for c, k in self.kinds.items() if k not in ("string", "bigint", "int", "double", "boolean", "date")]
        if wrong or any(len(c.encode()) > 10 for c in self.kinds):
            raise ValueError(f"attributes need names of ten bytes at most and plain types: {wrong or list(self.kinds)}")
        self.attempt = uuid.uuid4().hex[:8]

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        folder = f"{self.path}/_{self.attempt}/{uuid.uuid4().hex}"
        groups: dict[str, _Group] = {}
        files: dict[str, int] = {}

        def flush(kind: str) -> None:
            if not files:
                self.store.create_dir(folder, recursive=True)
            n = files[kind] = files.get(kind, -1) + 1
            self._file(f"{folder}/{kind}" + (f"-{n}" if n else ""), CODES[kind], groups.pop(kind))

        for row in iterator:
            values = dict(zip(self.names, row))
            kind = values.get("shape") or ("point" if values.get("longitude") is not None else "polygon" if values.get("rings") is not None else None)
            group = groups.setdefault(kind or "", _Group())
            group.add(*_content(CODES.get(kind, 0), values), [self._text(values[c], k) for c, k in self.kinds.items()])
            if len(group.contents) >= FILE_ROWS or group.bytes >= FILE_BYTES:
                if not kind:
                    groups.setdefault("point", _Group()).take(groups.pop(""))
                flush(kind or "point")
        if "" in groups:  # an empty record may stand in a file of any type
            empty = groups.pop("")
            groups.setdefault(next(iter(groups), "point"), _Group()).take(empty)
        for kind in list(groups):
            flush(kind)
        return _Written(folder if files else None)

    def _file(self, base: str, code: int, group: _Group) -> None:
        offset, index, box = HEADER, [], group.box
        with self.store.open_output_stream(f"{base}.body") as f:
            for number, content in enumerate(group.contents, 1):
                f.write(struct.pack(">ii", number, len(content) // 2) + content)
                index.append((offset // 2, len(content) // 2))
                offset += 8 + len(content)
        head = lambda size: struct.pack(">7i", 9994, 0, 0, 0, 0, 0, size // 2) + struct.pack("<2i8d", 1000, code, *(box or [0.0] * 4), 0, 0, 0, 0)
        with self.store.open_output_stream(f"{base}.shp") as f, self.store.open_input_stream(f"{base}.body") as body:
            f.write(head(offset))
            while chunk := body.read(1 << 20):
                f.write(chunk)
        self.store.delete_file(f"{base}.body")
        with self.store.open_output_stream(f"{base}.shx") as f:
            f.write(head(HEADER + INDEX * len(index)))
            f.write(np.array(index, ">i4").tobytes())
        self._attributes(f"{base}.dbf", group.texts)

    def _attributes(self, path: str, rows: list[list[bytes]]) -> None:
        texts = {c: [r[i] for r in rows] for i, c in enumerate(self.kinds)}
        fixed = {"bigint": ("N", 18), "int": ("N", 11), "double": ("F", 24), "boolean": ("L", 1), "date": ("D", 8)}
        shape = {c: fixed.get(k) or ("C", max([1, *map(len, texts[c])])) for c, k in self.kinds.items()}
        if any(size > 254 for _, size in shape.values()) or any(len(x) > shape[c][1] for c, t in texts.items() for x in t):
            raise ValueError("an attribute is longer than its field can hold")
        size = 1 + sum(n for _, n in shape.values())
        head = struct.pack("<4B IHH 20x", 3, 126, 1, 1, len(rows), 32 * (len(shape) + 1) + 1, size)
        for c, (kind, n) in shape.items():
            head += struct.pack("<11s c 4x BB 14x", c.encode(), kind.encode(), n, 0 if kind != "F" else 11)
        with self.store.open_output_stream(path) as f:
            f.write(head + b"\x0d")
            for k in range(len(rows)):
                f.write(b" " + b"".join(t[k].ljust(shape[c][1]) if shape[c][0] in "CLD" else t[k].rjust(shape[c][1]) for c, t in texts.items()))
            f.write(b"\x1a")

    def _text(self, value, kind: str) -> bytes:
        if value is None:
            return b""
        if kind == "boolean":
            return b"T" if value else b"F"
        if kind == "date":
            return value.strftime("%Y%m%d").encode()
        return (repr(value) if kind == "double" else str(value)).encode(self.encoding)

    def commit(self, messages: list) -> None:
        written = [m.path for m in messages if m is not None and m.path]
        if self.overwrite:
            for info in self.store.get_file_info(fs.FileSelector(self.path, allow_not_found=True)):
                if info.base_name != f"_{self.attempt}":
                    (self.store.delete_dir if info.type == fs.FileType.Directory else self.store.delete_file)(info.path)
        for n, folder in enumerate(written):
            self.store.move(folder, f"{self.path}/part-{n:05d}-{self.attempt}")
        self._clear()

    def abort(self, messages: list) -> None:
        self._clear()

    def _clear(self) -> None:
        if self.store.get_file_info(f"{self.path}/_{self.attempt}").type == fs.FileType.Directory:
            self.store.delete_dir(f"{self.path}/_{self.attempt}")


def _content(code: int, values: dict) -> tuple[bytes, list]:
    """A record's bytes, and its points for the file's box."""
    if code == 0:
        return struct.pack("<i", 0), []
    if code == 1:
        at = (values["longitude"], values["latitude"])
        return struct.pack("<idd", 1, *at), [at]
    parts = [[(p["x"], p["y"]) for p in ring] for ring in values["rings"]]
    points = [p for part in parts for p in part]
    xs, ys = [p[0] for p in points] or [0.0], [p[1] for p in points] or [0.0]
    head = struct.pack("<i4d", code, min(xs), min(ys), max(xs), max(ys))
    if code == 8:
        head += struct.pack("<i", len(points))
    else:
        starts = np.cumsum([0, *map(len, parts)])[:-1]
        head += struct.pack("<ii", len(parts), len(points)) + starts.astype("<i4").tobytes()
    return head + np.array(points, "<f8").tobytes(), [(min(xs), min(ys)), (max(xs), max(ys))]


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Shapefile)
