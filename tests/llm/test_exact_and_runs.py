"""Exact deduplication and periodic runs: brute force, and nulls, empties, long texts, ties, repeats, clashing columns."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saltmarsh.llm import exact_dedup, runs

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))
ROWS = [(1, "a b"), (1, "a b"), (2, None), (3, ""), (4, " \t"), (5, "\n "), (6, "a\t b"), (None, "a b"), (None, "x"), (None, "x"), (7, LONG), (8, LONG + " "), (9, LONG), (10, "a b"), (11, " a b")]


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.fixture(scope="module")
def docs(spark):
    odd = {c: F.lit(9) for c in ("t", "h", "part", "head", "keep_id", "least", "n", "_from", "_period", "runs", "start", "period")}
    return spark.createDataFrame(ROWS, "doc_id long, text string").withColumns(odd)


def check_groups(rows, found):
    """One kept row in each group, with its smallest id."""
    groups = {}
    for i, t in rows:
        groups.setdefault(normal(t), []).append(i)
    import hashlib

    expected = sorted((str(i), str(min((x for x in ids if x is not None), default=None)), len(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for i in ids)
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in found) == expected
    kept = [r for r in found if r["kept"]]
    assert len(kept) == len(groups) == len({r["text_sha256"] for r in kept}) and all(r["doc_id"] == r["keep_id"] for r in kept)


def test_exact_edges(docs, spark):
    check_groups(ROWS, exact_dedup.exact_duplicates(docs).collect())
    assert exact_dedup.exact_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_exact_heavy_groups_are_split(spark, monkeypatch):
    """A third of all rows in one group: it lies in several parts, and the result is as if it lay in one."""
    rnd = random.Random(5)
    rows = [(rnd.randrange(10_000), "hot  text" if i % 3 == 0 else "\thot text" if i % 31 == 0 else f"t{rnd.randrange(500)}") for i in range(3000)]
    seen = {}
    before = exact_dedup.written

    def watched(df, name):
        seen[name] = before(df, name)
        return seen[name]

    monkeypatch.setattr(exact_dedup, "written", watched)
    found = exact_dedup.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check_groups(rows, found)
    parts = seen["judged"].where("part IS NOT NULL").groupBy("text_sha256").agg(F.countDistinct("part").alias("k"), F.count("*").alias("n")).orderBy(F.desc("n")).first()
    assert parts["n"] == 1000 and parts["k"] > 3


def test_equal_hashes_are_not_equal_texts(spark, monkeypatch):
    """All hashes forced to one value: only whole texts decide."""
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *_: F.lit(7).cast("long"))
    rows = [(i, f"text {i % 40} x") for i in range(400)]
    check_groups(rows, exact_dedup.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def brute(s):
    out = {}
    for q in range(1, len(s) // 4 + 1):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((a, b, q) for (a, b), q in out.items())


@settings(deadline=None, max_examples=300)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), max_size=40), st.integers(1, 9), st.integers(0, 30)), max_size=4))
def test_runs_brute_force(parts):
    texts = [a + (a[:q] * 9)[:n] for a, q, n in parts]
    first = np.cumsum([0] + [len(t) for t in texts])
    assert runs.runs_of(np.array(sum(texts, []), np.int32), first) == [brute(t) for t in texts]


@given(st.lists(st.integers(0, 2), max_size=30))
def test_z_function(s):
    assert runs.z_function(s) == [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]


def test_runs_of_texts(docs, spark):
    found = {(r["doc_id"], r["n_words"]): r for r in runs.periodic_runs(docs).collect()}
    assert len(found) == len({(i, len((t or "").split())) for i, t in ROWS})
    for r in found.values():
        assert (r["n_runs"] == 0) == (r["start"] is None)
    rows = [(1, "x " + "a b " * 5 + "a y z z z z z z"), (2, "a b a b a b a"), (3, "q q q q q"), (4, None), (5, " \n"), (6, "é 你 é 你 é 你 é 你"), (7, "one " * 5000)]
    got = {r["doc_id"]: r for r in runs.periodic_runs(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert got[1]["runs"] == "1,11,2\n13,6,1\n" and got[1]["collapsed_text"] == "x a b y z"
    assert (got[1]["start"], got[1]["length"], got[1]["period"], got[1]["exponent_milli"]) == (1, 11, 2, 5500)
    assert [got[i]["n_runs"] for i in range(2, 8)] == [0, 0, 0, 0, 1, 1] and got[6]["collapsed_text"] == "é 你" and got[7]["length"] == 5000
    assert runs.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_periodic_from(spark):
    df = spark.createDataFrame([(1, "a b c d e f g h i j k l m n", 2, 3), (2, "a b", 9, 1), (3, "a b c", None, 1)], "doc_id long, text string, f int, p int")
    got = {r["doc_id"]: r for r in runs.periodic_runs(df, F.col("f"), F.col("p")).collect()}
    assert got[1]["runs"] == "2,12,3\n" and got[1]["collapsed_text"] == "a b c d e" and got[2]["collapsed_text"] == "a b" and got[3]["n_runs"] == 0
