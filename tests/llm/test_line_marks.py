"""op6: two similar lines share a mark, whatever their sizes, and lines that differ meet by few of them, common words or not."""

import random

import pytest
from pyspark.sql import functions as F

from saltmarsh.llm import line_dedup


@pytest.mark.parametrize("percent", [60, 80, 90, 95])
def test_sizes_that_may_be_similar_have_a_number_of_parts_in_common(spark, percent):
    least = -(-percent // (100 - percent))
    n = spark.range(least, 3000).select(F.col("id").cast("int").alias("n"))
    own, above = line_dedup._parts(F.col("n"), percent)
    parts = {r["n"]: (r["own"], r["above"]) for r in n.select("n", own.alias("own"), above.alias("above")).collect()}
    for small, (own, above) in parts.items():
        for large in range(small, min(100 * small // percent, 2999) + 1):
            assert parts[large][0] in (own, above)
            assert parts[large][0] > (small + large) * (100 - percent) // (100 + percent)


def test_similar_lines_share_a_mark_and_others_few(spark):
    rng = random.Random(8)
    common = [f"common{i}" for i in range(30)]
    lines = []
    for n in (9, 10, 19, 40, 80, 150, 260, 700):
        for k in range(6):
            words = rng.sample(common, min(20, n // 2)) + [f"a{n}b{k}c{i}" for i in range(n - min(20, n // 2))]
            lines += [words, rng.sample(words, n - n // 10), [*words, *(f"d{n}e{k}f{i}" for i in range(n // 9))]]
    docs = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(lines)], "doc_id long, text string")
    marks = {r["doc_id"]: set(r["marks"] or ()) for r in line_dedup._profiles(docs, "text", 90).collect()}
    sets = [set(x) for x in lines]
    met = 0
    for a in range(len(sets)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                assert marks[a] & marks[b]
            elif a // 3 != b // 3:
                met += bool(marks[a] & marks[b])
    assert met < len(sets)
