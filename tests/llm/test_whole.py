"""Whole jobs: what the operators must not leave out."""

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from saltmarsh.llm import langid, mixing

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_copies_do_not_empty_the_training_sample(spark, monkeypatch):
    """Languages of a few much copied texts, and one of many texts beside a much copied one."""
    few = [(i, f"text {i % 5} of a few", "en") for i in range(3000)] + [(i, f"phrase {i % 3} de trois", "fr") for i in range(3000)]
    many = [(i, f"ein anderer satz {i}" if i < 400 else "ein satz", "de") for i in range(5000)]
    seen = []
    monkeypatch.setattr(langid, "fit", lambda texts, labels: seen.extend(zip(labels, texts)))
    langid.train(spark.createDataFrame(few + many, "doc_id long, text string, lang string"), F.lit(True))
    assert len(set(seen)) == len(seen) and Counter(x for x, _ in seen) == {"en": 5, "fr": 3, "de": langid.SAMPLE_DOCS}


def test_pipeline_keeps_clean_documents_of_several_languages(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    words = {}
    for r in table.where("lang IS NOT NULL AND text IS NOT NULL").orderBy("doc_id").collect():
        words.setdefault(r["lang"], []).extend(r["text"].split()[:100])
    langs = sorted(words)
    planted = {-n: " ".join(" ".join(words[x][:60]) for x in langs[:n]) for n in range(2, len(langs) + 1)}
    more = spark.createDataFrame([(i, t) for i, t in planted.items()], "doc_id long, text string")
    more = more.select(*(F.col(c) if c in more.columns else F.lit(None).cast(table.schema[c].dataType).alias(c) for c in table.columns))
    assert len(langs) > 2
    kept = {r["doc_id"] for r in pipeline.language_id(spark, table.unionByName(more), SF).select("doc_id").collect()}
    assert set(planted) <= kept


def test_mixed_rows_lie_by_shard_and_shuffled(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    draws = {}
    for r in mixing.mix(docs, mixing.word_count()).select("doc_id", "_draws").collect():
        for d in r["_draws"]:
            draws.setdefault(d["shard"], []).append((d["order"], r["doc_id"]))
    order = {s: [i for _, i in sorted(x)] for s, x in draws.items()}
    parts = {}
    for r in pipeline.mix_sources(spark, docs, SF).select("doc_id", F.spark_partition_id().alias("p")).collect():
        parts.setdefault(r["p"], []).append(r["doc_id"])
    for ids in parts.values():  # each partition is whole shards, one after another
        for s in sorted(order):
            if ids[: len(order[s])] == order[s]:
                ids[: len(order.pop(s))] = []
        assert not ids
    assert len(draws) > 1 and not order
