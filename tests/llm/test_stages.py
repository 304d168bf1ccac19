"""The pipeline's stages, the mix and the sharding against brute-force versions on small tables, edge cases included."""

import heapq
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from saltmarsh.llm import langid, mixing, sharding

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
WORDS = "one two three four five six seven eight nine ten eleven twelve".split()
TEXT = " ".join(WORDS * 3)
ROWS = [
    (1, TEXT, "en", "a", 1), (1, TEXT, "en", "a", 1), (1, "quite another text with the same id as that one", "en", "b", 2), (2, TEXT + " more", "en", None, 3), (None, TEXT, "en", "a", 4),
    (None, "a text without an id that stands alone", "en", "a", 5), (3, None, None, None, None), (4, "", "en", "a", 0), (5, " \n\t", "en", "b", 3), (6, LONG, "en", "c", 9), (7, LONG + " tail", "en", "c", 9), (8, "é 你好 ß", "de", "d", 5), (9, "12 34", "de", "d", 5),
]


@pytest.fixture(scope="module")
def docs(spark):
    odd = {c: F.lit(9) for c in ("_size", "_row", "_hit", "_lang", "component_id", "kept", "least", "none", "_draws", "shard", "size")}
    return spark.createDataFrame(ROWS, SCHEMA).withColumns(odd)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def rows(df):
    return sorted((tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in df.collect()), key=str)


@pytest.mark.parametrize("name, stage", pipeline.STAGES[:-1])
def test_empty_tables_and_columns(spark, docs, empty, name, stage):
    assert stage(spark, empty, SF).count() == 0
    assert stage(spark, docs, SF).columns == docs.columns


def test_language_stage(spark, docs):
    kept = rows(pipeline.language_id(spark, docs, SF))
    assert kept == sorted((r for r in ROWS if re.search(r"[^\W\d_]", r[1] or "")), key=str)


def test_near_dedup_stage(spark, docs):
    def words(t):
        return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))

    def shingles(t):
        w = words(t)
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()

    def kept_of(table):
        table = sorted(set(table), key=lambda r: (r[0] is None, r[0] or 0))
        sets, parent = [shingles(r[1]) for r in table], list(range(len(table)))

        def root(i):
            return i if parent[i] == i else root(parent[i])

        for a in range(len(table)):
            for b in range(a):
                c = len(sets[a] & sets[b])
                if c and 100 * c >= 80 * (len(sets[a]) + len(sets[b]) - c):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
        return sorted((r for i, r in enumerate(table) if parent[i] == i), key=str)

    assert rows(pipeline.near_dedup_stage(spark, docs, SF)) == kept_of(ROWS)
    table = spark.read.parquet(f"{SF}/documents.parquet")
    assert rows(pipeline.near_dedup_stage(spark, table, SF)) == kept_of(map(tuple, table.collect()))


def test_decontamination_stage(spark, docs):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    windows = {tuple(w[k : k + 13]) for w in map(words, items) if w for k in range(max(1, len(w) - 12))}
    sizes = {len(x) for x in windows}

    def clean(text):
        w = words(text)
        hit = {k for m in sizes for i in range(len(w) - m + 1) if tuple(w[i : i + m]) in windows for k in range(i, i + m)}
        return not hit or 20 * len(hit) < len(w)

    more = [(100_001, items[0], "en", "x", 1), (100_002, items[0].upper() + " " + "word " * 2000, "en", "x", 1), (None, None, None, None, None), (100_003, "", "en", "x", 0)]
    both = table.unionByName(spark.createDataFrame(more, SCHEMA))
    assert rows(pipeline.decontamination(spark, both, SF)) == sorted((tuple(r) for r in both.collect() if clean(r["text"])), key=str)
    assert len(rows(pipeline.decontamination(spark, docs, SF))) == len(ROWS)


def test_mixing_stage(spark, docs):
    for table in (docs, spark.read.parquet(f"{SF}/documents.parquet").select(*SCHEMA.replace(" long", "").replace(" string", "").split(", "))):
        size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        given, out = Counter(rows(table)), Counter(rows(pipeline.mix_sources(spark, table, SF)))
        assert set(out) <= set(given) and all(n <= 3 * given[r] for r, n in out.items())
        names = sorted({r[3] for r in given}, key=lambda s: (s is None, (s or "").encode()))
        sizes = [sum(size(r[1]) * n for r, n in given.items() if r[3] == s) for s in names]
        goal = mixing.targets(sizes, [mixing.WEIGHTS[i % 3] for i in range(len(names))], sum(sizes), 3.0)
        for s, t in zip(names, goal):  # the last document of a source stands whole
            taken = [size(r[1]) for r, n in out.items() if r[3] == s for _ in range(n)]
            assert -1 <= sum(taken) - t <= max([0, *(size(r[1]) for r in given if r[3] == s)])
        assert out == Counter(rows(pipeline.mix_sources(spark, table, SF)))


def test_mix_comes_through_the_tree(spark):
    """Each draw lies on a shard, shards hold what the tree gave them, and taken words are those of the draws."""
    table = spark.read.parquet(f"{SF}/documents.parquet")
    found = mixing.mix(table, mixing.word_count(), n_shards=8).select("source", "_size", "_taken", "_draws").collect()
    assert all(r["_taken"] == sum(d["words"] for d in r["_draws"]) and all(0 <= d["shard"] < 8 for d in r["_draws"]) for r in found)
    blocks = Counter()
    for r in found:
        for s in {d["shard"] for d in r["_draws"]}:
            blocks[r["source"], s] += 1
    assert len({s for _, s in blocks}) > 1


def test_shares_of_a_shard_are_hypergeometric():
    """The tree's counts for one shard, over many seeds: mean and variance of a multivariate hypergeometric draw."""
    quotas, shards = [60, 30, 10], 5
    seen = np.array([mixing.splitting_tree(quotas, shards, seed)[2] for seed in range(3000)])
    share = np.array(quotas) / 100
    assert np.allclose(seen.mean(axis=0), 20 * share, atol=0.12)
    assert np.allclose(seen.var(axis=0), 20 * share * (1 - share) * (80 / 99), rtol=0.12)


def lpt(groups, n):
    load = [(0, k) for k in range(n)]
    for size in sorted(groups, reverse=True):
        x, k = heapq.heappop(load)
        heapq.heappush(load, (x + size, k))
    return sorted(x for x, _ in load)


def test_sharding_brute_force(spark):
    """With a bundle for each small group, loads are those of plain longest-first scheduling; slots and groups hold."""
    rng = np.random.default_rng(3)
    texts = ["x" * int(n) for n in rng.integers(0, 4000, 60)] * 2 + [f"hot {'y' * 3000}"] * 200 + [None, None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    size = F.octet_length(F.coalesce("text", F.lit(""))) + 8
    placed = sharding.shard(df, F.col("text"), size, 5, units=100_000).collect()
    load, slots, of_text, groups = Counter(), defaultdict(list), defaultdict(set), Counter()
    for r in placed:
        n = len(r["text"] or "") + 8
        load[r["_shard"]] += n
        groups[r["text"]] += n
        slots[r["_shard"]].append(r["_slot"])
        of_text[r["text"]].add(r["_shard"])
    assert all(len(x) == 1 for x in of_text.values()) and all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert sorted(load.values()) == lpt(groups.values(), 5)


def test_sharding_stage(spark, docs, empty):
    assert pipeline.shard(spark, empty, SF).count() == 0
    found = pipeline.shard(spark, docs, SF).collect()
    by = defaultdict(list)
    for r in found:
        by[r["shard"]].append(r["slot"])
    assert len(found) == len(ROWS) and all(sorted(x) == list(range(len(x))) for x in by.values())


def test_one_long_text_is_labelled_in_parts(spark):
    """A text of many slices gets the label and share of its words together."""
    table = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(table, F.lit(True))
    texts = {r["lang"]: r["text"] for r in table.where("lang IN ('en', 'fr') AND length(text) > 300").collect()}
    long = texts["en"] * (1_200_000 // len(texts["en"])) + " " + texts["fr"]
    (r,) = langid.identify(spark.createDataFrame([(1, long)], "doc_id long, text string"), model).collect()
    assert r["_lang"] == "en" and r["_score"] > 0.9
