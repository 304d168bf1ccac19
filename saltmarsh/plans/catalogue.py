"""All queries of the library and their SQL. Each query applies an operator to whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
_PARTS = ("relational", "reshaping", "texts", "times", "indices", "landing", "stateful", "geometry", "pages")


def query(sql: str | None = None) -> Callable[[Callable], Callable]:
    """Registers a function of tables: its parameters name the tables it reads (``spark`` and ``sf_dir`` pass through)."""

    def add(f: Callable) -> Callable:
        names = f.__code__.co_varnames[: f.__code__.co_argcount]

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            given = {"spark": spark, "sf_dir": sf_dir}
            return f(*(given[n] if n in given else spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names))

        QUERIES[f.__name__] = run
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    for part in _PARTS:
        import_module(f"{__package__}.{part}")
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(SQL)
