"""op6: maps hold a bounded number of words, and no pair of long lines is lost by them; every kind of white space parts words."""

import random

from saltmarsh.llm import line_dedup


def removed(spark, lines):
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    return {r["doc_id"] for r in line_dedup.similar_lines(docs).collect() if r["n_removed"]}


def test_a_map_has_the_words_of_smallest_hash(spark):
    lines = [" ".join(f"w{i}x{n}" for i in range(n)) for n in (9, 100, 128, 129, 400)]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    bits = {r["doc_id"]: r["bits"] for r in line_dedup._profiles(docs, "text", 90).collect()}
    for r in docs.select("doc_id", line_dedup._set(docs["text"]).alias("s")).collect():
        expected = 0
        for h in r["s"][:128]:
            expected ^= 1 << (h & 63)
        assert bits[r["doc_id"]] % 2**64 == expected


def test_long_lines_at_the_threshold(spark):
    rng = random.Random(5)
    lines = []
    for n in (20, 60, 120, 127, 128, 129, 135, 200, 330):
        words = [f"a{n}b{i}" for i in range(n)]
        lines.append(words)
        for less, more in ((n // 10, 0), (n // 10 + 1, 0), (0, n // 9), (0, n // 9 + 1), (n // 20, n // 20), (n // 20, n // 20 - 1), (n // 19, n // 19 + 1)):
            kept = rng.sample(words, n - less)
            lines.append(kept + [f"c{len(lines)}d{i}" for i in range(more)])
    rng.shuffle(lines)
    sets = [set(x) for x in lines]
    expected = {k for k, a in enumerate(sets) for b in sets[:k] if 100 * len(a & b) >= 90 * len(a | b)}
    assert 20 < len(expected) < len(lines)
    assert removed(spark, [" ".join(x) for x in lines]) == expected


def test_all_kinds_of_white_space(spark):
    assert removed(spark, ["Alpha beta", "beta\talpha", "gamma\x0bdelta", "delta  gamma", "x\x0cy", "y x", "p\rq", "p\t \x0b\x0c\rQ", "pq"]) == {1, 3, 5, 7}
