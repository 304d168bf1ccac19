"""Exact deduplication by a content sort. DataFrame functions only.

1. Texts are normalised, and the rows and bytes of each 64-bit hash of a normalised text are counted, with map-side
   combining, into a table of three numbers for each hash. Groups that weigh more than a quarter of a mean partition are
   heavy. There are at most four for each partition whatever the input, so their table may be broadcast. A heavy group is
   cut into as many parts as it has quarter-partitions; others are one part.
2. Sampled splitters range-partition the rows by content: by the first bytes of the normalised text, then by the hash of
   all of it, then by part. A splitter is thus some 100 bytes however long the texts are, texts that begin alike are split
   all the same, and a heavy group spans as many partitions as it needs. It is the only shuffle that carries texts.
3. Each partition is sorted outside memory by that key, then by the whole normalised text, then by id, so equal texts of a
   part are adjacent. The window over it finds groups by comparing whole neighbouring texts; no hash decides
   equality. It needs no further shuffle, as the range partitioning keeps its groups together. The first row of a group
   has the smallest id.
4. What is known of each row, without its text, is written to the shared folder. The parts of heavy groups, a row for
   each with the text, are grouped by whole text; the totals, at most one row for each heavy text, come back to the rows
   by part and SHA-256 of the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import shuffle_partitions, written

#: Characters of a text by which splitters tell it from others, before its hash does.
HEAD = 16
#: What a row weighs besides its text, and the share of a mean partition beyond which a group is cut into parts.
ROW_BYTES, SHARE = 64, 0.25


def normalised(text: Column) -> Column:
    """The text with each run of ASCII white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for each row of ``docs``; other columns are left alone.

    Rows are equal if their normalised texts are. Of equal ones the row with the smallest id stays; rows without an id
    come after those with one, and of rows that share the smallest id exactly one is ``kept``. ``keep_id`` is null where
    no row of a group has an id. Empty, blank and null texts are texts like others (blank is one space). An empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("doc_id"), normalised(F.col(text)).alias("t"))
    rows = rows.select("doc_id", "t", F.xxhash64("t").alias("h"))
    weights = written(rows.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("t").cast("long") + ROW_BYTES).alias("w")), "weights")
    limit = weights.agg(F.sum("w") * SHARE / shuffle_partitions(spark)).scalar()
    # of n rows that weigh more than the limit together; at most 1 / SHARE for each partition
    heavy = weights.where((F.col("n") > 1) & (F.col("w") > limit)).select("h", F.least("n", F.ceil(F.col("w") / limit)).alias("parts"))
    dealt = rows.join(F.broadcast(heavy), "h", "left").withColumn("part", F.pmod(F.monotonically_increasing_id(), F.col("parts")))
    key = dealt.withColumn("head", F.substring("t", 1, HEAD)).repartitionByRange("head", "h", "part")
    same = Window.partitionBy("head", "h", "part", "t").orderBy(F.col("doc_id").asc_nulls_last())
    whole = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    judged = key.select(
        "doc_id",
        "t",
        "part",
        F.row_number().over(same).alias("place"),
        F.first("doc_id").over(whole).alias("least"),
        F.count(F.lit(1)).over(whole).alias("n"),
    )
    first = F.col("part").isNotNull() & (F.col("place") == 1)
    table = written(judged.select("doc_id", "part", "place", "least", "n", F.sha2(F.col("t").cast("binary"), 256).alias("text_sha256"), F.when(first, F.col("t")).alias("t")), "judged")
    # the smallest id of all parts, and the part that has it
    order = F.struct(F.col("least").isNull().alias("none"), "least", "part")
    totals = table.where(first).groupBy("t", "text_sha256").agg(F.min(order).alias("best"), F.sum("n").alias("all"))
    totals = totals.select("text_sha256", "best", "all")
    light = table.where("part IS NULL").select("doc_id", F.col("least").alias("keep_id"), F.col("n").alias("group_size"), (F.col("place") == 1).alias("kept"), "text_sha256")
    in_parts = table.where("part IS NOT NULL").join(F.broadcast(totals), "text_sha256")
    kept = (F.col("place") == 1) & (F.col("part") == F.col("best.part"))
    split = in_parts.select("doc_id", F.col("best.least").alias("keep_id"), F.col("all").alias("group_size"), kept.alias("kept"), "text_sha256")
    return light.unionByName(split)


def op13_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)"""
