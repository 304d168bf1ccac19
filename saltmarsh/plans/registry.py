"""Tables as a dependency graph: each is a function of its inputs, is written under a root, and may have checks.

``Registry.run`` builds the chosen tables in dependency order. A table's function gets the session and its inputs as
DataFrames, read back from what was written, so each table is planned on files with statistics and a run can resume. A
partitioned table gets its partition key and replaces that partition only. Expectations are checked by the job that writes
the table, and only other checks read it again. A table that fails stops those that depend on it. Every table has a
metadata file beside it. What a table needs from its surroundings (a folder, a threshold, a notifier) it names in
``requires``; a run gets the values of its environment and does not start if one is missing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import metadata
from .checks import Expectation, observed

Build = Callable[..., DataFrame]
Check = Callable[[DataFrame], DataFrame]


@dataclass
class Table:
    name: str
    build: Build
    deps: tuple[str, ...] = ()
    partition: str | None = None
    group: str = "default"
    description: str = ""
    source: str | None = None
    checks: dict[str, Check] = field(default_factory=dict)
    expectations: dict[str, Expectation] = field(default_factory=dict)
    requires: tuple[str, ...] = ()


class CheckFailed(RuntimeError):
    pass


def partition_key(scheduled: datetime, period: str = "day", week_start: int = 6) -> str:
    """The key of the partition that a run scheduled for this time builds: the first day of the day, week or month that it
    falls in, as text. ``week_start`` counts from Monday as 0; weeks start on Sunday unless told otherwise. The time is in
    the zone that the partitions are in.
    """
    day = scheduled.date()
    first = {"day": day, "week": day - timedelta(days=(day.weekday() - week_start) % 7), "month": day.replace(day=1)}
    return first[period].isoformat()


def environment(settings: dict[str, dict[str, object]], name: str) -> dict[str, object]:
    """The values of one environment, on top of those that all have (under ``default``)."""
    if name not in settings:
        raise ValueError(f"no environment {name}: there are {', '.join(sorted(settings))}")
    return settings.get("default", {}) | settings[name]


class Registry:
    def __init__(self) -> None:
        self.tables: dict[str, Table] = {}

    def table(self, name: str, deps: tuple[str, ...] = (), **about) -> Callable[[Build], Build]:
        def add(build: Build) -> Build:
            if name in self.tables:
                raise ValueError(f"two tables are named {name}")
            self.tables[name] = Table(name, build, tuple(deps), **about)
            return build

        return add

    def check(self, table: str, name: str) -> Callable[[Check], Check]:
        def add(check: Check) -> Check:
            self.tables[table].checks[name] = check
            return check

        return add

    def expect(self, table: str, **expectations: Expectation) -> None:
        """Checks, by name, of the rows as they are written."""
        self.tables[table].expectations.update(expectations)

    def order(self, select: list[str] | None = None, upstream: bool = True, group: str | None = None) -> list[Table]:
        """The chosen tables, inputs first; with ``upstream``, all that they depend on as well."""
        chosen = select or [t.name for t in self.tables.values() if group in (None, t.group)]
        out: dict[str, Table] = {}

        def visit(name: str, path: tuple[str, ...]) -> None:
            if name in path:
                raise ValueError(f"a cycle: {' -> '.join((*path, name))}")
            if name in out:
                return
            for dep in self.tables[name].deps:
                if upstream or dep in chosen:
                    visit(dep, (*path, name))
            out[name] = self.tables[name]

        for name in chosen:
            visit(name, ())
        return list(out.values())

    def run(self, spark: SparkSession, root: str, select: list[str] | None = None, upstream: bool = True, partition: str | None = None, on_failure: Callable[[str, Exception], None] | None = None, stop: bool = True, resources: dict[str, object] | None = None) -> DataFrame:
        """Writes the tables; returns (table, check, passed), one row for each check. A failure is reported, then raised; with
        ``stop=False``, checks that fail are rows of the result only.
        """
        results: list[tuple[str, str, bool]] = []
        chosen, given = self.order(select, upstream), resources or {}
        if missing := sorted({f"{r} (for {t.name})" for t in chosen for r in t.requires if r not in given}):
            raise ValueError(f"the environment lacks {', '.join(missing)}")
        for t in chosen:
            try:
                inputs = [self.read(spark, root, d) for d in t.deps]
                if t.partition and partition is None:
                    raise ValueError(f"{t.name} needs a partition key")
                df, outcome = observed(t.build(spark, *inputs, *([partition] if t.partition else []), **{r: given[r] for r in t.requires}), t.expectations)
                if t.partition:
                    df = df.withColumn(t.partition, F.lit(partition))
                    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(t.partition).parquet(self.path(root, t.name))
                else:
                    df.write.mode("overwrite").parquet(self.path(root, t.name))
                written = self.read(spark, root, t.name)
                about = metadata(t.name, t.description, t.source, {c: k for c, k in written.dtypes}, {"application/vnd.apache.parquet": self.path(root, t.name)})
                spark.createDataFrame([(about,)], "value string").coalesce(1).write.mode("overwrite").text(f"{root}/{t.name}.metadata")
                found = {name: ok for name, (ok, _) in outcome().items()} | {name: bool(check(written).first()["passed"]) for name, check in t.checks.items()}
                results += [(t.name, name, ok) for name, ok in found.items()]
                if stop and (failed := [name for name, ok in found.items() if not ok]):
                    raise CheckFailed(f"{t.name}: {', '.join(failed)}")
            except Exception as e:
                if on_failure:
                    on_failure(t.name, e)
                raise
        return spark.createDataFrame(results, "table string, check string, passed boolean")

    @staticmethod
    def path(root: str, name: str) -> str:
        return f"{root}/{name}"

    def read(self, spark: SparkSession, root: str, name: str) -> DataFrame:
        return spark.read.parquet(self.path(root, name))
