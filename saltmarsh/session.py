"""The session's settings that the library's results depend on, and those that help on any cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Times are UTC instants and zones are arguments; AQE sizes partitions and splits skewed joins at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.python.filterPushdown.enabled": "true",
}


def session(master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName("saltmarsh")
    if master:
        builder = builder.master(master)
    return builder.config(map=SETTINGS | settings).getOrCreate()


_OWN: dict[str, str] = {}


def working_folder(spark: SparkSession) -> str:
    """A folder that driver and executors share: ``spark.checkpoint.dir``, or a temporary one where it is unset (local mode)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="saltmarsh-")
    return _OWN[app]


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{working_folder(spark)}/{name}-{uuid.uuid4().hex}"
