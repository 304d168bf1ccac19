"""Tables written once to the folder that the driver and all executors share.

An operator whose result is read by several later stages writes it here instead of recomputing it or holding it in
executor memory: the table survives the loss of any executor, and the plan behind it is cut.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Cells of a table that are gathered into one row at first.
CHUNK = 4096
_OWN: dict[str, str] = {}
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``. In local mode, a temporary one where the session names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="saltmarsh-")
    return _OWN[app]


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back; the table goes when the driver exits.

    Nothing reads the write's shuffles again, so they are removed as soon as it is done.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    atexit.register(_drop, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Delete tables made by ``written`` that no later stage reads."""
    for df in tables:
        for path in {f.rpartition("/")[0] for f in df.inputFiles()[:1]}:
            _drop(df.sparkSession, path)


def _drop(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    if sc._jsc is None or sc._jsc.sc().isStopped():
        return
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def dense_table(marks: DataFrame, size: int, name: str) -> DataFrame:
    """One row: an array of ``size`` values from rows (place, value); 0 elsewhere. Its size is bounded, so it may travel."""
    filled = marks.sparkSession.range(size).join(marks.withColumnRenamed("place", "id"), "id", "left")
    zero = F.lit(0).cast(marks.schema["value"].dataType)
    in_order = lambda cells: F.transform(F.sort_array(F.collect_list(cells)), lambda x: x["v"])
    rows = filled.groupBy(F.floor(F.col("id") / CHUNK).alias("id")).agg(in_order(F.struct("id", F.coalesce("value", zero).alias("v"))).alias("v"))
    return written(rows.agg(F.flatten(in_order(F.struct("id", "v"))).alias("cells")), name)


def flags_of(keys: DataFrame, wanted: int, most: int) -> tuple[DataFrame, Callable[[Column], Column]]:
    """A one-row table of ``wanted`` to twice as many flags, ``most`` at most, and a test of whether a 64-bit hash is among
    the one column of ``keys``. The test lets a few others through, the more the more keys there are to a flag.
    """
    size = 64
    while size < min(most, wanted):
        size *= 2
    bit = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), k.bitwiseAND(63).cast("int"))
    cell = lambda k: F.shiftrightunsigned(k, 6).bitwiseAND(size // 64 - 1).cast("int")
    k = F.col(keys.columns[0])
    flags = dense_table(keys.groupBy(cell(k).alias("place")).agg(F.bit_or(bit(k)).alias("value")), size // 64, "flags")
    return flags, lambda k: F.get(flags.scalar(), cell(k)).bitwiseAND(bit(k)) != 0
