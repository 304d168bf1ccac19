"""Phrases: count tries against brute force, cuts and languages, and odd input."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from saltmarsh.llm import collocations as c


def brute_counts(rows):
    out = Counter()
    for text, lang in rows:
        lower = "".join(x.lower() if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            for n in range(1, 5):
                out.update((lang or "und", " ".join(w[i : i + n])) for i in range(len(w) - n + 1))
    return out


def texts(seed, n, longest=60):
    rnd = random.Random(seed)
    words = ["a", "b", "of the", "É", "Zz", "ü", "x.", "y,", "long-word", "\t", "\n", "q!", "\x0b", "\xa0z"]
    return [(" ".join(rnd.choice(words) for _ in range(rnd.randrange(longest))), rnd.choice(["en", "fr", "", "zz"])) for _ in range(n)]


@pytest.mark.parametrize("seed", range(6))
def test_tries_merged_by_range(seed, monkeypatch):
    """Many shards and ranges, splitters that no shard has and equal ones included: the sums are those of brute force."""
    monkeypatch.setattr(c, "SHARD_BYTES", 200)
    rows = sorted(texts(seed, 80))
    rnd = random.Random(seed)
    parts = [tuple(x.encode() for x in rnd.choice([("a", "", "", ""), ("of", "the", "a", "zz"), ("b", "b", "nope", ""), ("zz", "zz", "zz", "zz"), ("m", "", "", "")])) for _ in range(9)]
    splitters = sorted((rnd.choice(["", "aa", "en", "fr"]), p) for p in parts)
    batches = [pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows[i : i + 7]]), pa.array([x for _, x in rows[i : i + 7]])], names=["text", "lang"]) for i in range(0, 80, 7)]
    runs = pa.Table.from_batches(c._counted(splitters)(iter(batches)))
    assert len(set(runs["range"].to_pylist())) > 3
    found = Counter()
    for batch in c._merged(1)(iter(runs.sort_by("range").to_batches(max_chunksize=5))):
        for lang, phrase, depth, f in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if depth:
                assert len(phrase.split(" ")) == depth
                found[lang, phrase] += f
    expected = Counter({k: v for k, v in brute_counts(rows).items()})
    assert found == Counter({("" if k[0] == "und" else k[0], k[1]): v for k, v in expected.items()})


def test_paths_round_trip():
    rnd = np.random.default_rng(3)
    ids, piece = rnd.integers(1, 6, 500), np.sort(rnd.integers(0, 60, 500))
    columns, counts = c._trie(ids, piece)
    words = [b"w%d" % i for i in range(6)]
    names, coded = c._coded(columns, counts, words)
    local = c._whole(names).split(b"\n")
    back, again = c._decoded(len(counts), len(local), coded)
    assert (again == counts).all() and counts.sum() == 500
    assert [[words[i - 1] if i else b"" for i in x] for x in columns] == [[local[i - 1] if i else b"" for i in x] for x in back]


def brute(rows, least, share=80):
    f = brute_counts(rows)
    n = Counter()
    for (lang, p), v in f.items():
        n[lang] += v if " " not in p else 0
    out = []
    frequent = {k: v for k, v in f.items() if v >= least and " " in k[1]}
    for (lang, p), a in frequent.items():
        w = p.split(" ")
        cut = min((2_000_000 * a // (f[lang, " ".join(w[:k])] + f[lang, " ".join(w[k:])]), k, f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])]) for k in range(1, len(w)))
        longer = [v for (x, q), v in frequent.items() if x == lang and q != p and f" {p} " in f" {q} "]
        if not any(100 * v >= share * a for v in longer):
            out.append((lang, p, a, cut[2], cut[3], n[lang], cut[0]))
    ranked = []
    for lang in {x[0] for x in out}:
        best = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        ranked += [(lang, i + 1, *x[1:]) for i, x in enumerate(best)]
    return sorted(ranked)


def test_collocations_brute_force(spark):
    rows = [(t, None if x == "" else x) for t, x in texts(11, 300)] + [("one two three. " * 40, "fr")] * 3 + [(None, "en"), ("", None), (" . ", "xx")]
    df = spark.createDataFrame(rows, "text string, lang string").withColumns({x: F.lit(9) for x in ("phrase", "f", "w", "a", "k", "n", "rank", "left", "depth", "range")}).repartition(5)
    for least in (5, 30):
        assert sorted(map(tuple, c.collocations(df, least).collect())) == brute(rows, least)
    best = c.collocations(df, 5, most=3)
    assert sorted(map(tuple, best.collect())) == [x for x in brute(rows, 5) if x[1] <= 3]


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert c.collocations(empty).count() == 0
    assert c.collocations(spark.createDataFrame([(None, None), ("", "en"), (" \t.", None)], "text string, lang string")).count() == 0
    long = spark.createDataFrame([("x y " * 200_000, None)], "text string, lang string")
    rows = {r["phrase"]: r for r in c.collocations(long).collect()}
    assert set(rows) == {"x y x y", "y x y x"} and rows["x y x y"]["a"] == 199_999 and rows["x y x y"]["n"] == 400_000


def test_products_beyond_64_bits(spark, monkeypatch):
    huge = 1 << 62
    table = [("en", "", 0, huge), ("en", "a", 1, huge), ("en", "b", 1, huge - 1), ("en", "a b", 2, huge - 3)]
    monkeypatch.setattr(c, "phrase_counts", lambda docs, least: spark.createDataFrame(table, "lang string, phrase string, depth int, f long"))
    (row,) = c.collocations(spark.createDataFrame([], "text string, lang string")).collect()
    assert row["score"] == 2_000_000 * (huge - 3) // (2 * huge - 1)
