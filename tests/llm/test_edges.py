"""Nulls in any column, empty and very long texts, ties, repeated rows, empty tables, extra columns with clashing names."""

import math
import re
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saltmarsh.llm import decontam, html_extract, langid, line_dedup, mixing, near_dedup, pii, sharding, substring_dedup, tokens, topk
from saltmarsh.llm.components import components

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
ROWS = [
    (1, "a b c d e f g h", "en", "s1", 1),
    (1, "a b c d e f g h", "en", "s1", 1),
    (2, None, None, None, None),
    (None, "x y z x y z", "fr", "s2", 2),
    (3, "", "fr", "", 0),
    (4, " \t\n ", None, "s1", 3),
    (5, LONG, "en", "s3", 4),
    (6, LONG + " tail", "en", "s3", 5),
    (7, "a b c d e f g h", "de", None, 6),
    (8, "é 你好 ß 😀", "de", "s2", 7),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    # columns that are named like the operators' own
    odd = {c: F.lit(9) for c in ("_size", "_shard", "_hit", "_items", "_n_words", "_lang", "_score", "component_id", "kept", "n_shingles", "check", "removed", "node", "family", "_group")}
    return spark.createDataFrame(ROWS, SCHEMA).withColumns(odd)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, *names):
    return sorted(((r["doc_id"],) + tuple(r[n] for n in names) for r in df.collect()), key=str)


def test_mixing(docs, empty):
    rows = mixing.mix(docs, mixing.word_count()).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["_taken"] <= 3 * r["_size"] for r in rows)
    assert {r["_size"] for r in rows if r["doc_id"] in (2, 3, 4)} == {0}
    assert mixing.mix(empty, mixing.word_count()).count() == 0


def test_mixing_in_ranges_is_the_same(spark, monkeypatch):
    """Sums over ranges of hashes, against one walk; rows without an id are spread over blocks."""
    rows = [(None if i % 3 else i, " ".join(["w"] * (i % 7)), "hot" if i % 4 else f"s{i % 5}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 10)
    seen = lambda: sorted(map(str, mixing.mix(df, mixing.word_count()).select("doc_id", "text", "source", "_taken", "_draws", F.spark_partition_id() * 0).collect()))
    whole = seen()
    monkeypatch.setattr(mixing, "CELL_BLOCKS", 4)
    assert seen() == whole


def test_targets_are_capped():
    found = mixing.targets([10, 100, 1000], [5.0, 2.0, 1.0], 1110, 3.0)
    assert found[0] == 30 and found[1] == 300 and found[2] == pytest.approx(780)
    assert mixing.targets([0, 0], [1.0, 2.0], 0, 3.0) == [0.0, 0.0] and mixing.targets([], [], 0, 3.0) == []


@settings(deadline=None)
@given(st.lists(st.integers(0, 60), min_size=1, max_size=6), st.integers(1, 9), st.integers(0, 5))
def test_splitting_tree(quotas, shards, seed):
    tree = mixing.splitting_tree(quotas, shards, seed)
    assert [sum(s[i] for s in tree) for i in range(len(quotas))] == quotas
    sizes = [sum(s) for s in tree]
    assert max(sizes) - min(sizes) <= 1 and all(x >= 0 for s in tree for x in s)


def test_sharding(docs, empty, spark):
    for table in (docs, empty):
        placed = sharding.shard(table, F.col("text"), F.octet_length(F.coalesce("text", F.lit(""))) + 8, 3)
        rows = placed.collect()
        assert len(rows) == table.count()
        assert len({r["_shard"] for r in rows if r["text"] == ROWS[0][1]}) <= 1
        for k in range(3):
            slots = sorted(r["_slot"] for r in rows if r["_shard"] == k)
            assert slots == list(range(len(slots)))
    hot = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 1000, "same").otherwise(F.col("id").cast("string")).alias("text"))
    loads = [r["count"] for r in sharding.shard(hot, F.col("text"), F.lit(1), 6, units=200).groupBy("_shard").count().collect()]
    assert max(loads) == 1000 and min(loads) >= 395


def test_lpt():
    assert sharding.lpt([(7, "a"), (5, "b"), (4, "c"), (3, "d"), (3, "e")], 2) == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 1}
    assert sharding.lpt([], 2) == {}


def test_near_duplicates(docs, empty):
    found = near_dedup.near_duplicates(docs.select("doc_id", "text", "lang", "family" if "family" in docs.columns else "lang"), 3, 85)
    rows = by_id(found, "component_id", "kept")
    assert rows.count((1, 1, True)) == 2 and (7, 1, False) in rows and (6, 5, False) in rows and (5, 5, True) in rows
    assert (2, 2, True) in rows and (3, 3, True) in rows and (4, 4, True) in rows and (None, None, True) in rows
    assert near_dedup.near_duplicates(empty).count() == 0


def test_large_family_is_cut_into_blocks(spark, monkeypatch):
    words = [f"t{i}" for i in range(60)]
    texts = [(i, " ".join(words[:20] + [f"new{i}"] + words[20 + (i % 2) :])) for i in range(80)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    monkeypatch.setattr(near_dedup, "BLOCK_TEXTS", 15)
    want = by_id(near_dedup.near_duplicates(df, 3, 80), "component_id")
    sets = [near_dedup.shingle_sets(w, 3)[0] for _, t in texts for _, _, w in tokens.sliced(pa.array([t]), tokens.WHITESPACE)]
    parent = list(range(80))
    for a in range(80):
        for b in range(a):
            c = len(np.intersect1d(sets[a], sets[b]))
            if 100 * c >= 80 * (len(sets[a]) + len(sets[b]) - c):
                x, y = sorted((root(parent, a), root(parent, b)))
                parent[y] = x
    assert want == sorted(((i, root(parent, i)) for i in range(80)), key=str)


def test_family_that_falls_apart(spark, monkeypatch):
    """Chains and several groups in one family of many blocks: what the first block leaves open is found."""
    rng = np.random.default_rng(4)
    base = [f"b{i}" for i in range(40)]
    texts, now = [], list(base)
    for i in range(120):  # a chain that drifts away, and side groups
        for k in range(5 if i % 13 == 0 else 1):
            now[int(rng.integers(40))] = f"n{i}x{k}"
        texts.append(" ".join(now if i % 3 else base[:39] + [f"m{i}"]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [near_dedup.shingle_sets(w, 1)[0] for t in texts for _, _, w in tokens.sliced(pa.array([t]), tokens.WHITESPACE)]
    parent = list(range(120))
    for a in range(120):
        for b in range(a):
            c = len(np.intersect1d(sets[a], sets[b]))
            if 100 * c >= 90 * (len(sets[a]) + len(sets[b]) - c):
                x, y = sorted((root(parent, a), root(parent, b)))
                parent[y] = x
    want = sorted(((i, root(parent, i)) for i in range(120)), key=str)
    assert len({r for _, r in want}) > 2
    monkeypatch.setattr(near_dedup, "BLOCK_TEXTS", 9)
    assert by_id(near_dedup.near_duplicates(df, 1, 90), "component_id") == want
    monkeypatch.setattr(near_dedup, "MOST_BLOCKS", 1)  # by bands
    assert by_id(near_dedup.near_duplicates(df, 1, 90), "component_id") == want


def test_recall_of_pairs_at_the_threshold(spark):
    """Pairs whose similarity is 0.85 to 0.86: all are found."""
    rng = np.random.default_rng(6)
    rows = []
    for i in range(400):
        n = int(rng.integers(60, 600))
        w = [f"p{i}x{k}" for k in range(n)]
        swaps = int(n * (1 - 0.855) / (1 + 0.855))  # one-word shingles: n - s common of n + s
        other = w[:-swaps] + [f"q{i}x{k}" for k in range(swaps)] if swaps else w
        assert 100 * (n - swaps) >= 85 * (n + swaps)
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(other))]
    found = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 1, 85).collect()}
    assert sum(found[2 * i + 1] == 2 * i for i in range(400)) == 400


def root(parent, i):
    while parent[i] != i:
        i = parent[i]
    return i


def test_estimate_is_near_the_truth():
    rng = np.random.default_rng(0)
    both = rng.integers(0, 1 << 63, 6000, dtype=np.uint64)
    a, b = np.unique(both[:5000]), np.unique(both[1000:])
    sketch = near_dedup.sketches(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
    assert abs(near_dedup.estimated(sketch[0], sketch[1:], len(a), np.array([len(b)]))[0] - 2 / 3) < 0.15


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 3), (9, 8), (None, 4), (2, 1)] + [(i, i + 1) for i in range(20, 60)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {2: 1, 3: 1, 9: 8} | {i: 20 for i in range(21, 61)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_substrings(docs, empty):
    rows = by_id(substring_dedup.remove_repeated(docs, 4), "n_words", "n_removed", "kept_text")
    assert rows.count((1, 8, 8, "")) == 2 and (7, 8, 8, "") in rows
    assert (2, 0, 0, "") in rows and (3, 0, 0, "") in rows and (4, 0, 0, "") in rows and (None, 6, 0, "x y z x y z") in rows
    assert next(r for r in rows if r[0] == 6)[2:] == (60_000, "tail")
    assert substring_dedup.remove_repeated(empty).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3000), max_size=30))
def test_steps_round_trip(places):
    places = np.array(sorted(set(places)), np.int64)
    assert substring_dedup._places(substring_dedup._steps(places)).tolist() == places.tolist()


def test_windows_with_one_hash_are_told_apart_in_a_batch(monkeypatch):
    """All first hashes forced to be equal: windows repeat only where the others agree too."""
    real = substring_dedup.two_hashes
    monkeypatch.setattr(substring_dedup, "two_hashes", lambda words, n: (lambda p, v, w: (p, np.full(len(v), 7, np.uint64), w))(*real(words, n)))
    monkeypatch.setattr(substring_dedup, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda self: 0})())}))
    texts = ["a b c d e f g", "x b c d y", "q r s t u"]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([0, 0, 0]), pa.array(texts)], names=["doc_id", "check", "text"])
    rows = [r for b in substring_dedup._hashed(3, 4)(iter([batch])) for r in b.to_pylist()]
    (known,) = [np.frombuffer(r["steps"], np.int32).tolist() for r in rows if r["bucket"] < 0]
    assert known == [1, 2, 8, 9]  # b c d, at its two places
    assert sum(len(r["hashes"]) // 8 for r in rows if r["bucket"] >= 0) == 5 + 3 + 3 - 1


def test_substrings_brute_force(spark):
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(list("abc"), rng.integers(0, 30))) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    seen = {}
    for t in texts:
        w = t.split()
        for i in range(len(w) - 5):
            seen[tuple(w[i : i + 6])] = seen.get(tuple(w[i : i + 6]), 0) + 1
    for r in substring_dedup.remove_repeated(df, 6).collect():
        w = texts[r["doc_id"]].split()
        gone = {k for i in range(len(w) - 5) if seen[tuple(w[i : i + 6])] > 1 for k in range(i, i + 6)}
        assert r["kept_text"] == " ".join(x for k, x in enumerate(w) if k not in gone) and r["n_removed"] == len(gone)


def test_lines(docs, empty, spark):
    rows = by_id(line_dedup.similar_lines(docs), "n_lines", "removed")
    assert (1, 1, []) in rows and (7, 1, [0]) in rows and (6, 1, [0]) in rows and (2, 1, []) in rows and (3, 1, []) in rows and (4, 2, []) in rows
    assert line_dedup.similar_lines(empty).count() == 0
    lines = spark.createDataFrame([(1, "one two three\n\nfour"), (2, "x\nTHREE two one\nfour"), (3, None)], "doc_id long, text string")
    kept = line_dedup.without_lines(lines, line_dedup.similar_lines(lines))
    assert by_id(kept, "text") == [(1, "one two three\n\nfour"), (2, "x"), (3, None)]


def test_benchmark(docs, empty, spark):
    items = spark.createDataFrame([("b", "A b, C d"), ("a", "a B c d"), (None, "e f"), ("z", None), ("y", "..."), ("q", " ".join(f"w{i % 977}x{i % 31}" for i in range(500, 520)))], "item_id string, text string")
    found = decontam.find_benchmark(docs, items, window=4)
    rows = by_id(found, "_n_words", "_n_hit", "_items")
    assert rows.count((1, 8, 6, ["", "a", "b"])) == 2 and (2, 0, 0, []) in rows and (None, 6, 0, []) in rows
    assert next(r for r in rows if r[0] == 5)[3] == ["q"]
    assert set(docs.columns) - {"_hit"} == set(found.columns) - {"_n_hit"} and found.count() == len(ROWS)
    assert decontam.find_benchmark(empty, items).count() == 0
    assert all(r[2] == 0 for r in by_id(decontam.find_benchmark(docs, items.where("false")), "_n_words", "_n_hit"))


def test_large_benchmark_goes_in_blocks(docs, spark, monkeypatch):
    items = spark.createDataFrame([(str(i), f"w{i}x{i} w{i + 1}x{i + 1} w{i + 2}x{i + 2}") for i in range(25)], "item_id string, text string")
    whole = by_id(decontam.find_benchmark(docs, items, window=3), "_n_hit", "_items")
    monkeypatch.setattr(decontam, "PATTERN_BYTES", 150)
    assert by_id(decontam.find_benchmark(docs, items, window=3), "_n_hit", "_items") == whole
    assert max(len(r[2]) for r in whole) > 5
    found = decontam.find_benchmark(docs, items, window=3)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_windows_that_share_a_key_are_all_found(monkeypatch):
    """With all words' hashes equal, each window of a length has one key."""
    monkeypatch.setattr(tokens.Words, "hashes", lambda self: np.ones(len(self.start), np.uint64))
    items = ["a b c d", "b c d e", "a b c d", "x y", "y x", "z"]
    words = tokens.split(*tokens.buffers(pa.array(["q a b c d e x y x z"])), tokens.NOT_ALPHANUMERIC, lower=True)
    found = set()
    for p in decontam.patterns_of(items, 3):
        for s, f in zip(*p.search(words, words.hashes())):
            found |= {(int(s), p.m, int(i)) for i in p.items(f)}
    assert found == {(1, 3, 0), (2, 3, 0), (1, 3, 2), (2, 3, 2), (2, 3, 1), (3, 3, 1), (6, 2, 3), (7, 2, 4), (9, 1, 5)}


def test_wu_manber_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(30):
        items = [" ".join(rng.choice(list("ab"), rng.integers(1, 9))) for _ in range(4)]
        text = rng.choice(list("ab"), 40).tolist()
        words = tokens.split(*tokens.buffers(pa.array([" ".join(text)])), tokens.NOT_ALPHANUMERIC, lower=True)
        found = set()
        for p in decontam.patterns_of(items, 5):
            for s, f in zip(*p.search(words, words.hashes())):
                found |= {(int(s), p.m, int(i)) for i in p.items(f)}
        want = set()
        for i, t in enumerate(x.split() for x in items):
            m = min(5, len(t))
            pats = {tuple(t[k : k + m]) for k in range(len(t) - m + 1)}
            want |= {(s, m, i) for s in range(len(text) - m + 1) if tuple(text[s : s + m]) in pats}
        assert found == want


def test_equal_hashes_are_not_taken_for_equal_words():
    """With all words' hashes equal, only the words themselves tell occurrences."""
    items, text = ["a b c d e", "b c d e f"], "x a b c d e f y"
    words = tokens.split(*tokens.buffers(pa.array(items)), tokens.NOT_ALPHANUMERIC, lower=True)
    same = np.ones(len(words.start), np.uint64)
    p = decontam.Patterns(words, same, np.array([0]), np.array([0]), 5)
    found = tokens.split(*tokens.buffers(pa.array([text])), tokens.NOT_ALPHANUMERIC, lower=True)
    assert p.search(found, np.ones(len(found.start), np.uint64))[0].tolist() == [1]


CASES = ["", "a@b.c_d@e.f.@g.h a..b@c.d..", "x" * 100_000, "1" * 100_000, "1.2.3.4.5.6.7.8.9", "999.1.1.1 01.002.0003.4", "é😀 4111 1111 1111 1111 +1 (555) 123-4567-", "+1" + "-" * 5000]
CASES += ["a@b" + ".c" * 20_000, "1 2-3 " * 9, "++49 30 123456", "1-" * 30_000, "1.2.3." + "9" * 40, "@" * 1000, "a" * 50_000 + "@" + "b" * 50_000]
BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def confirmed(kind, m):
    digits = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.split(".")), "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]


def test_pii(docs, empty, spark):
    df = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string")
    for r in pii.find_pii(df).collect():
        for kind, pattern in BASE.items():
            if kind == "email" and r["doc_id"] == len(CASES) - 1:
                continue  # quadratic for this module's plain pattern
            want = [(m.start(), m.end()) for m in re.finditer(pattern, CASES[r["doc_id"]]) if confirmed(kind, m.group())]
            assert [(s["start"], s["end"]) for s in r[f"pii_{kind}"]] == want, (kind, r["doc_id"])
    assert pii.find_pii(docs).count() == len(ROWS) and pii.find_pii(empty).count() == 0


@pytest.mark.parametrize("n", [255, 256, 257, 700])
def test_many_matches_in_one_text(spark, n):
    text = " ".join(f"é{i % 7} 10.0.{i % 300}.1 a{i}@b.org" for i in range(n))
    r = pii.find_pii(spark.createDataFrame([(text,)], "text string")).first()
    for kind in ("ip", "email"):
        want = [(m.start(), m.end(), m.group()) for m in re.finditer(BASE[kind], text) if confirmed(kind, m.group())]
        assert [(s["start"], s["end"], s["match"]) for s in r[f"pii_{kind}"]] == want


def test_time_is_in_proportion_to_matches(spark):
    import time

    took = []
    for n in (200, 5_000, 50_000):
        df = spark.createDataFrame([(" ".join(f"10.0.{i % 256}.1" for i in range(n)),)], "text string")
        began = time.perf_counter()
        assert pii.find_pii(df).select(F.size("pii_ip")).first()[0] == n
        took.append(time.perf_counter() - began)
    assert took[2] < 20 * took[1] + 5


@pytest.mark.parametrize(
    "text, kind, score",
    [
        ("Mail: a@b.org", "email", 1.0), ("xmail a@b.org", "email", 0.9), ("host 10.0.0.1", "ip", 0.85), ("v 10.0.0.1", "ip", 0.6), ("my VISA 4111 1111 1111 1111", "card", 0.95),
        ("4111 1111 1111 1111", "card", 0.7), ("call +49 30 123456", "phone", 0.95), ("phone" + "." * 41 + "+49 30 123456", "phone", 0.7), ("Account DE89370400440532013000", "iban", 1.0), ("x DE89370400440532013000", "iban", 0.8), ("ssn 123-45-6789", "ssn", 0.65),
    ],
)
def test_words_nearby_raise_the_score(spark, text, kind, score):
    (found,) = pii.find_pii(spark.createDataFrame([(text,)], "text string")).first()[f"pii_{kind}"]
    assert found["score"] == pytest.approx(score)


@pytest.mark.parametrize(
    "text, iban, ssn",
    [("pay GB82 WEST 1234 5698 7654 32 now", 1, 0), ("GB83 WEST 1234 5698 7654 32", 0, 0), ("DE89370400440532013000", 1, 0), ("my SSN is 123-45-6789", 0, 1), ("part 123-45-6789", 0, 0), ("ssn 000-45-6789", 0, 0)],
)
def test_pii_checksums_and_context(spark, text, iban, ssn):
    r = pii.find_pii(spark.createDataFrame([(text,)], "text string")).first()
    assert (len(r["pii_iban"]), len(r["pii_ssn"])) == (iban, ssn)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_top_k(spark):
    v = [1.0, 0.5]
    rows = [(0, v, 1), (50, [0.0, 1.0], 1), (3, v, 1), (2, v, None), (4, None, 1), (5, [1.0, None], 1), (6, [float("nan"), 1.0], 1), (7, [float("inf"), 1.0], 1), (8, [], 1), (None, v, 1), (9, [1.0], 1), (10, [-3.0, -3.0], 1)]
    asks = F.coalesce(F.col("vec_id") % 50 == 0, F.lit(False))
    found = sorted(tuple(r) for r in topk.top_k(vectors(spark, rows), asks, 3).collect())
    one = 256 * 256 + 128 * 128
    assert found == [(0, 1, 2, one), (0, 2, 3, one), (0, 3, 50, 128 * 256), (50, 1, 0, 128 * 256), (50, 2, 2, 128 * 256), (50, 3, 3, 128 * 256)]
    large = [(0, [1.0, 1.0], 0), (1, [2.0, 2.0], 0), (2, [1e7, 1.0], 0), (3, [3e38, 3e38], 0), (4, [3e38, 2e38], 0), (5, [-3e38, 0.0], 0), (50, [-1e30, 0.0], 0), (100, [], 0), (101, [], 0)]
    found = sorted(tuple(r) for r in topk.top_k(vectors(spark, large), asks, 9).collect())
    top, low = 2**63 - 1, -(2**63)
    assert [r[2:] for r in found if r[0] == 0] == [(3, top), (4, top), (2, 65536 * 10_000_001), (1, 4 * 65536), (50, low), (5, low)]
    assert [r[2] for r in found if r[0] == 50] == [5, 0, 1, 2, 3, 4] and [r for r in found if r[0] == 100] == [(100, 1, 101, 0)]
    assert topk.top_k(vectors(spark, []), asks).count() == 0
    assert topk.top_k(vectors(spark, [(0, v, 1)]), asks).count() == 0


@pytest.mark.parametrize("size", [0, 1, 3])
def test_block_of_small_and_large_components_brute_force(size):
    rng = np.random.default_rng(size)
    for _ in range(30):
        n = int(rng.integers(1, 60))
        values = rng.normal(0, 1, (n, size)) * 10.0 ** rng.choice([0, 0, 0, 4, 12, 300], (n, 1))
        ids, query = rng.integers(0, 40, n), rng.normal(0, 1, size) * 10.0 ** rng.choice([0, 6, 200])
        whole = [[math.floor(Fraction(x) * 256) for x in v] for v in (*values.tolist(), query.tolist())]
        score = [(sum(a * b for a, b in zip(v, whole[-1])), int(i)) for v, i in zip(whole, ids) if i != 7]
        assert topk.Block(ids, values, 256).best(7, query, 5) == sorted(score, key=lambda x: (-x[0], x[1]))[:5]


def test_top_k_over_many_blocks(spark, monkeypatch):
    rng = np.random.default_rng(1)
    data = rng.normal(0, 0.3, (400, 8)).astype(np.float32)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 60)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 3)
    whole = np.floor(data.astype(np.float64) * 256).astype(np.int64)
    found = topk.top_k(vectors(spark, [(i, x.tolist(), 0) for i, x in enumerate(data)]), F.col("vec_id") % 50 == 0).collect()
    want = set()
    for q in range(0, 400, 50):
        score = whole @ whole[q]
        order = [i for i in np.lexsort((np.arange(400), -score)) if i != q][:5]
        want |= {(q, k + 1, int(i), int(score[i])) for k, i in enumerate(order)}
    assert {tuple(r) for r in found} == want


@pytest.mark.parametrize("hi", [1, 3, 40, 5000])
def test_sliced_block_brute_force(hi):
    rng = np.random.default_rng(hi)
    for _ in range(40):
        n, d, k = int(rng.integers(1, 200)), int(rng.integers(1, 9)), int(rng.integers(1, 8))
        rows, query, eligible = rng.integers(-hi, hi + 1, (n, d)).astype(np.int32), rng.integers(-hi, hi + 1, d).astype(np.int32), rng.random(n) < 0.8
        at, score = topk.SlicedBlock(rows).best(query, k, topk._packed(eligible))
        order = np.lexsort((at, -score))[:k]
        exact, inside = rows.astype(np.int64) @ query, np.flatnonzero(eligible)
        best = np.lexsort((inside, -exact[inside]))[:k]
        assert at[order].tolist() == inside[best].tolist() and score[order].tolist() == exact[inside[best]].tolist()


def test_language(docs, empty):
    model = langid.train(docs, F.lit(True))
    found = langid.identify(docs, model)
    rows = by_id(found, "_lang", "_score")
    assert {r for r in rows if r[0] in (2, 3, 4)} == {(i, "und", 0.0) for i in (2, 3, 4)} and found.count() == len(ROWS)
    assert langid.train(empty, F.lit(True)) is None
    assert {r["_lang"] for r in langid.identify(docs, None).collect()} == {"und"}


def test_forward_backward():
    rng = np.random.default_rng(0)
    lengths = [0, 1, 70, 33, 32, 5]
    first = np.concatenate([[0], np.cumsum(lengths)])
    emissions, change = rng.normal(0, 2, (first[-1], 3)), rng.normal(0, 1, (3, 3))
    want = []
    for a, b in zip(first[:-1], first[1:]):
        alpha, beta = np.zeros((b - a, 3)), np.ones((b - a, 3))
        for t in range(b - a):
            v = (alpha[t - 1] if t else np.ones(3)) @ np.exp(change) * np.exp(emissions[a + t])
            alpha[t] = v / v.sum()
        for t in range(b - a - 2, -1, -1):
            v = np.exp(change) @ (np.exp(emissions[a + t + 1]) * beta[t + 1])
            beta[t] = v / v.sum()
        want.append(alpha * beta / (alpha * beta).sum(axis=1, keepdims=True))
    assert np.allclose(langid.posteriors(emissions, change, first), np.concatenate(want))


def test_words_change_language_inside_a_text():
    en, fr = "the house and the garden with that thing of things " * 30, "la maison et le jardin avec cette chose des choses " * 30
    model = langid.fit([en, fr], ["en", "fr"])
    words = tokens.split(*tokens.buffers(pa.array([en[:200] + fr[:200]])), tokens.NOT_LETTER, lower=True)
    which = np.arange(len(words.start))
    p = langid.posteriors(model.emissions(langid.Grams.of(words, which), words.hashes()), model.transitions, words.first)
    half = en[:200].count(" ")
    assert (p[: half - 1].argmax(axis=1) == 0).all() and (p[half + 1 :].argmax(axis=1) == 1).all()


PAGE = """<html><head><title>T</title></head><body><header><a href=/>Home</a> Site name</header><div id="cookie-banner">We use cookies. <button>OK</button></div>
<div class="sidebar"><ul><li><a href=x>One</a></li></ul></div><article><h1>Head &eacute;</h1><p>First para is long enough to be content, with <a href=z>a link</a>.<p>Short.
<div class="ad">Buy now</div><ul><li>Item a<li>Item&nbsp;b</ul><script>var x="<p>no</p>";</script></article><section class="comments"><p>Great article, thank you very much for this!</p></section>
<form><p>Sign up for letters.</p></form><footer>c 2020</footer></body></html>"""


def test_page():
    assert html_extract.main_text(PAGE) == "Head é First para is long enough to be content, with a link. Short. Item a Item b"
    assert html_extract.main_text(None) == html_extract.main_text("") == ""
    for cut in range(0, len(PAGE), 7):
        html_extract.main_text(PAGE[:cut])
    html_extract.main_text("<div>" * 20_000 + "x")
    html_extract.main_text('<a href="' * 5000)


ARTICLE = "<body><article><h1>Head</h1><p>First paragraph that is long enough to count as one of an article.</p>%s</article><footer>c</footer></body>"
FIRST = "Head First paragraph that is long enough to count as one of an article."


@pytest.mark.parametrize(
    "inside, kept",
    [
        ('<p id="related-work">Related work was done before by many.</p>', "Related work was done before by many."),
        ('<div class="story-search-results">The search found many things.</div>', "The search found many things."),
        ("<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> hold.</p>", "Let x=2 hold."),
        ("<p>A <noscript>plain</noscript> <svg><text>drawn</text></svg> <audio>heard</audio> line.</p>", "A plain drawn heard line."),
        ('<header class="header"><h2>Part two</h2></header>', "Part two"),
        ('<p class="notice-of-death">He died in May.</p>', "He died in May."),
        ('<section class="post-comments"><p>Great article, thank you very much for this, I will come again!</p></section>', ""),
        ('<div class="related"><h3>Related</h3><ul><li><a href=x>One</a></li><li><a href=x>Two</a></li></ul></div>', ""),
        ('<div class="notice">We have changed our terms.</div><p>Last.</p>', "Last."),
        ('<div class="share-buttons"><button>Share</button></div>', ""),
        ("<aside>See also the other one.</aside><form><label>Name</label><input></form>", ""),
    ],
)
def test_parts_of_articles(inside, kept):
    assert html_extract.main_text(ARTICLE % inside) == " ".join(filter(None, (FIRST, kept)))


def test_the_cut_decides_where_the_classifier_is_unsure():
    page = """<body><nav><a href=x>Home</a> <a href=y>About</a></nav><h1>Title</h1><p>Some long text that stands here without any article around it, and goes on.</p><p>So.</p>
    <p><a href=z>Only a link</a></p><p>Another long paragraph that tells us more about the matter at hand, and ends.</p><div class=ad>Buy</div><footer>c 2020</footer>"""
    blocks = html_extract.blocks_of(page)
    alone = [html_extract.score(b) > 0 for b in blocks]
    cut = html_extract.minimum_cut([html_extract.score(b) for b in blocks], html_extract.edges(blocks))
    moved = [b.text for b, x, y in zip(blocks, alone, cut) if x != y]
    assert moved == ["Title", "So."] and "Only a link" not in html_extract.main_text(page) and html_extract.main_text(page).startswith("Title Some long") and html_extract.main_text(page).endswith("and ends.")


@pytest.mark.parametrize("part", ["<svg>x", "<template>x", "<select>x", "</p>x", "<li>x</li>", "</section>x", "<!-", "<a href='"])
def test_time_is_linear_in_broken_pages(part):
    import time

    took = []
    for n in (40_000, 160_000):
        page = "<li><ul>" + "<div>" * (n // 8) + part * (n // len(part))
        began = time.process_time()
        html_extract.main_text(page)
        took.append(time.process_time() - began)
    assert took[1] < 8 * took[0] + 0.5


def test_pages(spark):
    pages = spark.createDataFrame([(1, PAGE, "k"), (1, PAGE, "k"), (None, None, None)], "page_id long, html string, _text string")
    rows = html_extract.extract(pages).collect()
    assert len(rows) == 3 and rows[0] == rows[1] and rows[2]["_text"] == ""
    odd = pages.withColumns({c: F.lit(1) for c in ("text", "url", "score", "n_chars")})
    assert {tuple(r) for r in html_extract.extract(odd).select("page_id", "_text", "text").collect()} == {(r["page_id"], r["_text"], 1) for r in rows}
    assert html_extract.extract(pages.where("false")).count() == 0


@settings(deadline=None, max_examples=150)
@given(st.lists(st.sampled_from([-2, -1, -0.5, 0, 0.5, 1, 2]), min_size=1, max_size=8), st.data())
def test_minimum_cut_brute_force(capacity, data):
    n = len(capacity)
    pairs = [(i, j) for i in range(n) for j in range(i + 1, n)]
    edge = {p: data.draw(st.sampled_from([0.3, 0.7, 1.5])) for p in pairs if data.draw(st.booleans())}

    def cost(label):
        own = sum(-c if c < 0 and x else c if c > 0 and not x else 0 for c, x in zip(capacity, label))
        return own + sum(w for (a, b), w in edge.items() if label[a] != label[b])

    best = min(cost([k >> i & 1 == 1 for i in range(n)]) for k in range(1 << n))
    assert cost(html_extract.minimum_cut(capacity, edge)) == pytest.approx(best)


@settings(deadline=None, max_examples=150)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\t\nZ9.", max_size=40)), max_size=20), st.sampled_from([16, 1 << 20]))
def test_words(texts, most):
    for separator, pattern, lower in ((tokens.WHITESPACE, r"[^\x20\x09-\x0D]+", False), (tokens.NOT_ALPHANUMERIC, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", True)):
        got = []
        for i, j, w in tokens.sliced(pa.array(texts, pa.string()), separator, lower, most):
            hashes = w.hashes()
            for k in range(j - i):
                at = range(w.first[k], w.first[k + 1])
                got.append([(bytes(w.data[w.start[x] : w.end[x]]).decode(), int(hashes[x])) for x in at])
        shown = ["".join(c.lower() if lower and "A" <= c <= "Z" else c for c in t or "") for t in texts]
        assert [[x for x, _ in g] for g in got] == [re.findall(pattern, t) for t in shown]
        names = {h: x for g in got for x, h in g}
        assert all(names[h] == x for g in got for x, h in g)


LONG_PART = "<p>This is the first of several long sentences of the article, which go on for a while.</p><p>And this is the second one, as long as the first one and longer, it seems.</p>"


@pytest.mark.parametrize(
    "around",
    [
        '<div class="layout has-sidebar"><article>%s</article></div>', '<div id="page" class="no-sidebar"><main>%s</main></div>', '<div class="content with-sidebar">%s</div>', '<div class="nav-open"><article>%s</article></div>',
        '<article><div class="entry with-comments">%s</div></article>', '<article><div class="ad-free-story">%s</div></article>', '<article><div class="login-required-story">%s</div></article>',
        "<form><h1>T</h1><article>%s</article></form>", "<form action=x>%s</form>", '<article title="The hidden truth">%s</article>', '<div data-title="a hidden gem">%s</div>', '<div class="prose hidden md:block">%s</div>',
        '<div class="content-sidebar"><article>%s</article></div>', '<div class="sidebar"><main>%s</main></div>', "<section data-hidden=x>%s</section>",
    ],
)
def test_names_do_not_throw_articles_away(around):
    page = "<body><nav><a href=/>Home</a></nav>" + around % LONG_PART + '<div class="sidebar"><p>Our other pages are here for you.</p></div><footer>copyright 2020 by us</footer>'
    found = html_extract.main_text(page)
    assert found.removeprefix("T ").startswith("This is the first") and found.endswith("it seems.")


@pytest.mark.parametrize("around", ["<div hidden>%s</div>", '<div style="display: none">%s</div>', "<div hidden=''>%s</div>", '<section class="post-comments">%s</section>', '<div id="commentList">%s</div>', "<aside>%s</aside>", '<div class="ads left">%s</div>', '<div class="reader-comments"><article>%s</article></div>'])
def test_what_is_no_content_goes(around):
    page = "<body><article><h1>Head</h1><p>A short article, that is one line long, as some are.</p></article>" + around % "<p>Well said, and I have something to add to that, at some length.</p>"
    assert html_extract.main_text(page) == "Head A short article, that is one line long, as some are."


def test_links_in_lists_and_tables_of_articles_stay():
    inside = "<h2>Steps</h2><ul><li><a href=x>One</a></li><li><a href=y>Two</a></li></ul><table><tr><td><a href=z>Cell</a></td><td>3</td></tr></table>"
    assert html_extract.main_text("<article>" + LONG_PART + inside + "</article>").endswith("it seems. Steps One Two Cell 3")


def test_the_cut_helps_on_pages_without_an_article(spark):
    """Pages made of the given texts: lines as paragraphs, every fourth one under a short heading, links beside them."""
    moved = right_with = right_without = pages = 0
    for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect():
        lines = [" ".join(x.split()) for x in (row["text"] or "").replace("<", " ").replace("&", " ").split("\n") if x.strip()][:40]
        if len(lines) < 4 or sum(map(len, lines)) < 400:
            continue
        body, content = [], []
        for k, line in enumerate(lines):
            if k % 4 == 0:
                content.append(f"Part {k}")
                body.append(f"<h3>Part {k}</h3>")
            content.append(line)
            body.append(f"<p>{line}</p>")
        page = "<body><div class=top><a href=/>Home</a> <a href=/a>About us</a></div><div class=x>" + "".join(body) + "</div><div class=bottom><a href=/t>Terms</a> <a href=/p>Privacy</a></div></body>"
        blocks = html_extract.blocks_of(page)
        alone = [html_extract.score(b) for b in blocks]
        cut = html_extract.minimum_cut(alone, html_extract.edges(blocks))
        moved += sum((a > 0) != b for a, b in zip(alone, cut))
        pages += 1
        right_with += [b.text for b, k in zip(blocks, cut) if k] == content
        right_without += [b.text for b, k in zip(blocks, alone) if k > 0] == content
    assert pages > 100 and moved > 0 and right_with > right_without and right_with >= 0.9 * pages
