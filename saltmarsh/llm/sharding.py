"""Sharding by longest-processing-time-first scheduling.

Rows of one group (by default: equal texts) go to one shard. Groups, largest first, each go to the shard that is the
least loaded so far, found with a heap; that keeps the shards' bytes near equal.

The heap never sees all groups. A group of more than ``1 / units`` of all bytes is a unit by itself (there are fewer than
``units`` of those, by arithmetic); all smaller groups are hashed into ``units`` bundles, and a bundle is a unit as well.
So the driver schedules at most ``2 * units`` sizes at any input size, and a bundle's size, which bounds the imbalance,
is near ``1 / units`` of the whole.

A group that is larger than a shard's fair share stays whole (its rows must stay together): its shard then holds little
else, and that group's size is the best reachable maximum.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a shard that one task numbers at once, on average.
CELL_ROWS = 20_000


def lpt(sizes: list[tuple[int, object]], n_shards: int) -> dict[object, int]:
    """The shard of each unit. Sizes descending, ties by unit; the heap's ties go to the lowest shard."""
    heap = [(0, k) for k in range(n_shards)]
    out = {}
    for size, unit in sorted(sizes, key=lambda x: (-x[0], x[1])):
        load, k = heap[0]
        heapq.heapreplace(heap, (load + size, k))
        out[unit] = k
    return out


def shard(docs: DataFrame, group: Column, size: Column, n_shards: int, units: int = 12_000, order: str = "doc_id") -> DataFrame:
    """``docs`` with ``_shard`` (int) and ``_slot`` (long, 0, 1, 2 ... without gaps in each shard).

    ``group``: a 64-bit (or any hashable) key of rows that stay together; null is a group like any other.
    ``size``: a non-negative long. Rows with equal keys always share a shard, and shards depend only on the table's
    content. Slots are numbered along ``order`` inside hash cells of about 20,000 rows, so no task sorts a whole shard,
    even where one group holds a third of all rows; identical rows take neighbouring slots in any order. An empty table
    gives an empty result. Other columns pass through untouched; names starting with ``_`` are this function's own.
    """
    spark = docs.sparkSession
    keyed = docs.withColumns({"_group": F.xxhash64(group), "_size": size.cast("long")})
    groups = keyed.groupBy("_group").agg(F.sum("_size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    total, rows = keyed.agg(F.sum("_size"), F.count(F.lit(1))).first()
    total, rows = total or 0, rows or 0
    bundle = F.pmod("_group", F.lit(units))
    unit = F.when(F.col("_bytes") * units > total, F.col("_group")).otherwise(bundle)
    alone = F.col("_bytes") * units > total
    sizes = groups.groupBy(alone.alias("_alone"), unit.alias("_unit")).agg(F.sum("_bytes").alias("_bytes"))
    placed = lpt([(r["_bytes"], (r["_alone"], r["_unit"])) for r in sizes.collect()], n_shards)  # at most 2 * units
    large = [(u, k) for (single, u), k in placed.items() if single]
    small = [0] * units
    for (single, u), k in placed.items():
        if not single:
            small[u] = k
    of_bundle = F.element_at(F.split(F.lit(",".join(map(str, small))), ",").cast("array<int>"), (F.pmod("_group", F.lit(units)) + 1).cast("int"))
    if large:
        table = F.broadcast(spark.createDataFrame(large, "_group long, _large int"))  # fewer than `units` rows
        keyed = keyed.join(table, "_group", "left").withColumn("_shard", F.coalesce("_large", of_bundle)).drop("_large")
    else:
        keyed = keyed.withColumn("_shard", of_bundle)
    cells = max(1, min(1 << 20, rows // n_shards // CELL_ROWS * 2))
    keyed = keyed.withColumn("_cell", F.pmod(F.xxhash64(F.col(order), F.col("_size")), F.lit(cells)))
    counts = keyed.groupBy("_shard", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_shard", "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    rank = F.row_number().over(Window.partitionBy("_shard", "_cell").orderBy(order, "_group"))
    ranked = keyed.withColumn("_rank", rank)
    out = ranked.join(starts, ["_shard", "_cell"]) if cells > 1 else ranked.withColumn("_start", F.lit(0))
    return out.withColumn("_slot", F.col("_start") + F.col("_rank") - 1).drop("_group", "_size", "_cell", "_rank", "_start")


def op9_lpt_sharding(spark, sf_dir: str, n_shards: int = 24) -> DataFrame:
    """All documents in 24 shards of near-equal bytes; equal texts share a shard. A null text has no bytes, and CRC 0."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(F.lit(1), "text").alias("_text"),
    )
    placed = shard(docs, F.struct("_text", "text_crc32", "size"), F.col("size"), n_shards)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("_shard").alias("shard"), F.col("_slot").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
