"""Published snapshots. Spark writes all rows in parallel; nothing is gathered on the driver.

A JSON or GeoJSON snapshot is a folder of part files with one record a line. ``document`` makes one file of them, where a
consumer needs that; ``put_objects`` writes an object for each row.
"""

from __future__ import annotations

import hashlib
import json
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import new_folder
from .stores import opened

TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def to_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("timestampNTZFormat", TIME_FORMAT).csv(path, header=True, timestampFormat=TIME_FORMAT)


def to_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrites only the partitions that ``df`` has, where the session's partitionOverwriteMode is dynamic."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*(partition_by or [])).parquet(path)


def records(df: DataFrame, keep_nulls: bool = True) -> Column:
    """A row as a JSON object; nulls are written, or their keys left out."""
    return F.to_json(F.struct(*df.columns), {"ignoreNullFields": str(not keep_nulls).lower()})


def feature(df: DataFrame, longitude: str = "longitude", latitude: str = "latitude") -> Column:
    """A row as a GeoJSON point feature; properties keep their nulls, and a row without a place has a null geometry."""
    properties = [c for c in df.columns if c not in (longitude, latitude)]
    point = F.when(F.col(longitude).isNotNull() & F.col(latitude).isNotNull(), F.struct(F.lit("Point").alias("type"), F.array(longitude, latitude).alias("coordinates")))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), point.alias("geometry")), {"ignoreNullFields": "false"})


def to_json_lines(df: DataFrame, path: str, keep_nulls: bool = True) -> None:
    df.select(records(df, keep_nulls)).write.mode("overwrite").text(path)


def to_geojson_lines(df: DataFrame, path: str, **place: str) -> None:
    df.select(feature(df, **place)).write.mode("overwrite").text(path)


def document(lines: DataFrame, path: str, member: str, last_updated: str, **head: str) -> None:
    """One JSON document {head..., lastUpdated, member: [records]} from a one-column table of JSON texts, in its order.

    All tasks write their records, one a line with a comma before it; the parts then become one file of the folder ``path``:
    they are copied one after another inside the store's client, a buffer at a time, and the first comma is left out.
    The file gets its name when it is whole. Null texts are left out.
    """
    (column,) = lines.columns
    spark = lines.sparkSession
    own = uuid.uuid4().hex
    parts = f"{path.rstrip('/')}/_parts-{own}"
    lines.where(F.col(column).isNotNull()).select(F.concat(F.lit(","), F.col(column))).write.text(parts)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = lambda *p: jvm.org.apache.hadoop.fs.Path(*p)
    store = at(path).getFileSystem(conf)
    files = sorted((f.getPath().toString() for f in store.listStatus(at(parts)) if f.isFile() and f.getPath().getName().startswith("part-") and f.getLen() > 0))
    whole = at(parts, "whole")
    out = store.create(whole, True)
    try:
        out.write(bytearray((json.dumps({**head, "lastUpdated": last_updated})[:-1] + f', "{member}": [\n').encode()))
        for n, file in enumerate(files):
            source = store.open(at(file))
            try:
                if n == 0:
                    source.seek(1)
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, conf, False)
            finally:
                source.close()
        out.write(bytearray(b"]}"))
    finally:
        out.close()
    for old in store.listStatus(at(path)):
        if old.getPath().getName().startswith("part-"):
            store.delete(old.getPath(), False)
    if not store.rename(whole, at(path, f"part-00000-{own}.json")):
        raise OSError(f"the document could not be put into {path}")
    store.delete(at(parts), True)


def series(df: DataFrame, column: str) -> DataFrame:
    """One column's values as JSON texts, nulls as ``null``, for a document of a series."""
    listed = F.to_json(F.array(column))
    return df.select(F.substring(listed, F.lit(2), F.length(listed) - 2).alias("value"))


def to_series(df: DataFrame, column: str, path: str, last_updated: str, formats: tuple[str, ...] = ("csv", "json")) -> dict[str, str]:
    """A column published as CSV with a header, and as {lastUpdated, data: [values]}; format -> folder."""
    written = {}
    for kind in formats:
        written[kind] = f"{path}.{kind}"
        if kind == "csv":
            # a blank line would be no row, so null is an empty text here
            to_csv(df.select(F.coalesce(F.col(column).cast("string"), F.lit("")).alias(column)), written[kind])
        elif kind == "json":
            document(series(df, column), written[kind], "data", last_updated)
        else:
            raise ValueError(f"a series is published as csv or json, not as {kind}")
    return written


def put_objects(df: DataFrame, folder: str, name: str, content: str) -> DataFrame:
    """Objects from rows, (name, length, sha256): each row's bytes become the object ``folder/name``, written by the tasks that
    have the rows.

    An object appears whole or not at all: it is written under another name first, and a task that runs again replaces it.
    Names may have folders in them, but may not leave ``folder``; a null content is an empty object. ``content`` may be text.
    Everything has been written when this returns.
    """
    kind = df.schema[content].dataType.typeName()
    if kind not in ("binary", "string"):
        raise ValueError("the content of an object is bytes or text")

    def run(batches):
        store, root = opened(folder)
        for batch in batches:
            names, found = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            data = [(x.encode() if isinstance(x, str) else x) or b"" for x in found]
            for own, x in zip(names, data):
                if own is None or own.startswith("/") or ".." in own.split("/"):
                    raise ValueError(f"no name for an object: {own}")
                at = f"{root}/{own}"
                temporary = f"{at}.{uuid.uuid4().hex}.tmp"
                store.create_dir(at.rpartition("/")[0], recursive=True)
                with store.open_output_stream(temporary) as f:
                    f.write(x)
                store.move(temporary, at)
            yield pa.RecordBatch.from_pydict({"name": names, "length": [len(x) for x in data], "sha256": [hashlib.sha256(x).hexdigest() for x in data]})

    path = new_folder(df.sparkSession, "objects")
    df.select(F.col(name).cast("string"), content).mapInArrow(run, "name string, length long, sha256 string").write.parquet(path)
    return df.sparkSession.read.parquet(path)


def metadata(name: str, description: str, source: str | None = None, columns: dict[str, str] | None = None, downloads: dict[str, str] | None = None) -> str:
    """A schema.org Dataset as JSON text: name, source, measured variables, and a download for each published format."""
    out: dict = {"@context": "https://schema.org/", "@type": "Dataset", "name": name, "description": description}
    if source:
        out["isBasedOn"] = source
    if columns:
        out["variableMeasured"] = [{"@type": "PropertyValue", "name": c, "description": d} for c, d in columns.items()]
    if downloads:
        out["distribution"] = [{"@type": "DataDownload", "encodingFormat": f, "contentUrl": u} for f, u in downloads.items()]
    return json.dumps(out)
