"""The corpus pipeline: language ID, near-duplicate removal, decontamination, mixing, sharding.

``STAGES`` are (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saltmarsh.llm import decontam, langid, mixing, near_dedup, sharding
from saltmarsh.llm.shared import flags_of, written

N_SHARDS = 24
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _on_plain_names(stage):
    """The stage with a table's further columns under names that no operator uses, and back under their own."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        others = {c: f"extra{i}" for i, c in enumerate(docs.columns) if c not in COLUMNS}
        out = stage(spark, docs.withColumnsRenamed(others), sf_dir)
        return out.withColumnsRenamed({plain: own for own, plain in others.items()})

    return run


@_on_plain_names
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters, and all if no language could be learned. Texts of several languages stay."""
    model = langid.train(docs, F.lit(True))
    found = langid.identify(docs, model)
    return found.where(F.col("_lang") != langid.UNKNOWN).select(docs.columns)


@_on_plain_names
def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group, that with the smallest id: five-word shingles, similarity 0.8.

    A document is a whole row here: rows that share an id but not a text are documents of their own, as are those without
    an id, which stand behind the others; of rows that are equal in every column one stays.
    """
    keyed = docs.withColumn("_row", F.xxhash64(*docs.columns))
    found = near_dedup.near_duplicates(keyed.select(F.col("_row").alias("doc_id"), "text"), words=5, percent=80).select(F.col("doc_id").alias("_row"), "component_id")
    ids = keyed.select("_row", F.col("doc_id").isNull().alias("none"), "doc_id").distinct()
    least = found.distinct().join(ids, "_row").groupBy("component_id").agg(F.min(F.struct("none", "doc_id", "_row")).alias("least")).select("least._row")
    # all other rows stay as they are, without a shuffle: those that go, and those that may be equal, are told by flags first
    gone = written(found.select("_row").distinct().join(least, "_row", "left_anti"), "gone")
    again = written(found.groupBy("_row").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_row"), "again")
    flags, flagged = flags_of(gone.union(again), 16 * (gone.count() + again.count()), near_dedup.MOST_FLAGS)
    looked_at = keyed.where(flagged(F.col("_row"))).join(gone, "_row", "left_anti").dropDuplicates(["_row", *docs.columns])
    return keyed.where(~flagged(F.col("_row"))).unionByName(looked_at).select(docs.columns)


@_on_plain_names
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which benchmark windows cover a twentieth of the words or more."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.find_benchmark(docs, items).where(~decontam.contaminated()).select(docs.columns)


@_on_plain_names
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix draws it, shard by shard and shuffled inside each; the one document of a source
    that is drawn in part stands whole.
    """
    mixed = mixing.mix(docs, mixing.word_count())
    return mixing.laid_out(mixed).select(docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shards of near-equal bytes; equal texts share a shard."""
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select("doc_id", "source", (F.octet_length(text) + 8).cast("long").alias("size"), F.xxhash64(F.lit(1), "text").alias("_text"), F.crc32(text.cast("binary")).alias("_crc"))
    placed = sharding.shard(sized, F.struct("_text", "_crc", "size"), F.col("size"), N_SHARDS)
    return placed.select("doc_id", "source", "size", F.col("_shard").alias("shard"), F.col("_slot").alias("slot"))


STAGES = [
    ("language ID", language_id),
    ("MinHash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination),
    ("mixing sources", mix_sources),
    ("sharding", shard),
]

#: SQL can't express the language model, the mix's draws or the heap; tests/llm/test_stages.py holds the stages against
#: brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
