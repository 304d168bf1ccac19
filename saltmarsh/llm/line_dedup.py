"""Line deduplication: an exact set-similarity join of all lines. DataFrame functions only.

1. One pass over the texts gives each line its class (128 bits of its word set), its number of words, a 64-bit map of
   its set, in which each of the ``MAPPED`` words of smallest hash flips one bit, and its marks. Lines of one class
   are one row from here on, so a line that stands in a third of all rows costs what any other does. Sets too small to have any partner but themselves go no further.
2. Marks: if two sets differ by k words at most and all hashes are parted into k + 1 ranges, the sets agree in one of them at
   least. So a set has a mark, a hash of its words there, for each range. How many ranges there are follows from the size
   of a pair's larger set, rounded up to the end of its group of sizes; a set has marks for its own group, and for the next where it may have partners there.
3. Classes that share a mark meet, a row of four numbers for each class and mark, under the length filter and the maps
   (more bits that differ than words may differ rule a pair out).
4. That an earlier line matches is all that need be known of a line. So each class first meets only the earliest class
   that has one of its marks, in one window over the marks. Near copies of one line are settled by that, and a join is left with
   the pairs whose later class is still open.
5. The lines of candidate pairs are read again, and their Jaccard similarity is verified on all their words. A bit map
   tells which documents and which of their lines are wanted, so that few others are cut into lines and shuffled. It has
   eight bits or more for each wanted line up to ``MOST_FLAGS`` in all; beyond that it lets more lines through to the
   join, which is exact.
6. A line goes if a line before it (by document id, then line number) has an equal or similar word set.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import dropped, flags_of, written

MOST_FLAGS = 1 << 26
RARE_SPACE = "\t\x0b\x0c\r"
#: Words of a set that are in its map, those of smallest hash.
MAPPED = 128
#: Parts of a set that are cut by compiled code.
FEW = 24
#: Groups of sizes are wider by this factor (a logarithm) than two similar sets may differ.
WIDER = 0.25


def _split(text: Column) -> Column:
    """The lower-cased words, parted by ASCII white space, and maybe empty strings. Plain replacing is faster than a pattern.

    Replacing takes longer than finding, so the rarer kinds of white space are replaced only where there is any.
    """
    spaced = lambda t, kinds: reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(" ")), kinds, t)
    some = reduce(Column.__or__, (F.contains(text, F.lit(c)) for c in RARE_SPACE))
    low = spaced(F.lower(text), "\n")
    return F.split(F.when(some, spaced(low, RARE_SPACE)).otherwise(low), " ")


def _set(line: Column) -> Column:
    """Hashes of the distinct words, ascending."""
    hashes = F.array_distinct(F.transform(_split(line), lambda w: F.xxhash64(w)))
    return F.sort_array(F.array_remove(hashes, F.xxhash64(F.lit(""))))


def _lines(docs: DataFrame, text: str) -> DataFrame:
    return docs.select("doc_id", F.posexplode(F.split(F.coalesce(text, F.lit("")), "\n")).alias("line_no", "line"))


def _ceil(a: Column, b: int) -> Column:
    return F.floor((a + (b - 1)) / b).cast("int")


def _cut(cells: Column, start: Column, end: Column, last: Column) -> Column:
    """The stretch of ``cells`` from the bound ``start`` up to the bound ``end``, or to the end of the array if it is the ``last``."""
    first = F.array_position(cells, start)
    behind = F.when(last, 0).otherwise(F.array_position(cells, end))
    return F.slice(cells, first.cast("int"), (F.when(behind > 0, behind).otherwise(F.size(cells) + 1) - first).cast("int"))


def _bound(i: Column, parts: Column) -> Column:
    """The smallest hash of part ``i`` of ``parts`` equal ranges of hashes."""
    return F.call_function("shiftleft", i * F.floor((1 << 32) / parts) - (1 << 31), F.lit(32))


def _cells(s: Column, parts: Column) -> Column:
    """The hashes of a set and the bounds of all parts, in order."""
    few = F.slice(F.array(*(_bound(F.lit(i), parts) for i in range(FEW))), F.lit(1), parts.cast("int"))
    many = F.transform(F.sequence(F.lit(0).cast("long"), parts - 1), lambda i: _bound(i, parts))
    return F.sort_array(F.concat(s, F.when(parts <= FEW, few).otherwise(many)))


def _marks(cells: Column, parts: Column) -> Column:
    """A hash of each part of a set, its number and their number.

    Few parts are cut by compiled code, more in two steps, into runs of parts and these into parts, so that a set of n
    words takes n**1.5 steps.
    """
    mark = lambda c, i: F.xxhash64(parts, i, _cut(c, _bound(i, parts), _bound(i + 1, parts), i + 1 >= parts))
    few = F.slice(F.array(*(F.when(F.lit(i) < parts, mark(cells, F.lit(i).cast("long"))) for i in range(FEW))), F.lit(1), parts.cast("int"))
    run = F.ceil(F.sqrt(parts))
    runs = F.transform(F.sequence(F.lit(0).cast("long"), F.ceil(parts / run) - 1), lambda r: _cut(cells, _bound(r * run, parts), _bound((r + 1) * run, parts), (r + 1) * run >= parts))
    many = F.flatten(F.transform(runs, lambda c, r: F.transform(F.sequence(r * run, F.least((r + 1) * run, parts) - 1), lambda i: mark(c, i))))
    return F.when(parts <= FEW, few).otherwise(many)


def _parts(n: Column, percent: int) -> tuple[Column, Column]:
    """Numbers of parts for a set of n words: as the larger of a pair, and as the smaller one, null if that is the same.

    Sizes are grouped by their logarithm, and a group's number is one more than the words by which two similar sets may
    differ whose larger one is in it. A group is wider than the ratio of similar sizes, so a set's larger partners are in its own or the next.
    """
    ratio = math.log(100 / percent) + 1e-6
    width = ratio + WIDER
    parts = lambda g: F.floor(2 * F.ceil(F.exp((g + 1) * width) + 1e-6) * (100 - percent) / (100 + percent)) + 1
    own, above = F.floor(F.log(n) / width), F.floor((F.log(n) + ratio) / width)
    return parts(own), F.when(parts(above) != parts(own), parts(above))


def _profiles(docs: DataFrame, text: str, percent: int) -> DataFrame:
    """A row for each line: doc_id, line_no, h (its text's hash), c1 and c2 (its class), n, bits, marks.

    ``marks`` and ``bits`` are null where the set is too small to be similar to another one. A line without words has n = 0.
    """
    sets = _lines(docs, text).select("doc_id", "line_no", F.xxhash64("line").alias("h"), _set(F.col("line")).alias("s"))
    n = F.size("s")
    large = n * (100 - percent) >= percent
    own, above = _parts(n, percent)
    sets = sets.select("doc_id", "line_no", "h", F.xxhash64("s").alias("c1"), F.xxhash64(F.lit(1), "s").alias("c2"), n.alias("n"), F.when(large, F.col("s")).alias("s"), F.when(large, own).alias("own"), F.when(large, above).alias("above"))
    cells = sets.select("*", _cells(F.col("s"), F.col("own")).alias("s0"), F.when(F.col("above").isNotNull(), _cells(F.col("s"), F.col("above"))).alias("s1"))
    # what is asked of each place of a set is compiled; a function of its words is not, and takes several times as long
    bit = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), F.get("s", F.lit(i)).bitwiseAND(63).cast("int"))
    bits = reduce(Column.bitwiseXOR, (F.coalesce(bit(i), F.lit(0).cast("long")) for i in range(MAPPED)))
    own, above = (_marks(F.col(s), F.col(p)) for s, p in (("s0", "own"), ("s1", "above")))
    marks = F.when(F.col("above").isNull(), own).otherwise(F.concat(own, above))
    return written(cells.select("doc_id", "line_no", "h", "c1", "c2", "n", F.when(F.col("s").isNotNull(), bits).alias("bits"), F.when(F.col("s").isNotNull(), marks).alias("marks")), "lines")


def _sided(df: DataFrame, side: str, *keep: str) -> DataFrame:
    return df.select(*keep, *(F.col(c).alias(f"{c}_{side}") for c in df.columns if c not in keep))


def _later(pairs: DataFrame, classes: DataFrame, docs: DataFrame, text: str, percent: int) -> DataFrame:
    """(id): of each pair (a, b) of classes whose whole sets match, the later class."""
    pairs = written(pairs.distinct(), "pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    wanted = written(classes.select("id", "h", F.xxhash64("doc_id").alias("d")).join(ends, "id"), "wanted")
    flags, flagged = flags_of(wanted.select(F.explode(F.array("h", "d")).alias("k")), 16 * wanted.count(), MOST_FLAGS)
    maybe = _lines(docs.where(flagged(F.xxhash64("doc_id"))), text).select(F.xxhash64("line").alias("h"), "line").where(flagged(F.col("h")))
    # copies of a line are one row before they meet the wanted ones; lines that share a hash are kept apart
    found = maybe.groupBy("h", "line").agg(F.count(F.lit(1)).alias("copies")).join(wanted, "h")
    sets = written(found.select("id", _set(F.col("line")).alias("s")), "sets")
    checked = pairs.join(_sided(sets, "a").withColumnRenamed("id_a", "a"), "a").join(_sided(sets, "b").withColumnRenamed("id_b", "b"), "b")
    common = F.size(F.array_intersect("s_a", "s_b"))
    matched = checked.where(100 * common >= percent * (F.size("s_a") + F.size("s_b") - common))
    later = written(matched.select(F.greatest("a", "b").alias("id")).distinct(), "later")
    dropped(pairs, wanted, flags, sets)
    return later


def similar_lines(docs: DataFrame, text: str = "text", percent: int = 90) -> DataFrame:
    """(doc_id, n_lines, n_removed, removed) for each document; removed: array of the numbers (from 0) of lines that go.

    Lines are parted by line feeds; a line's words are runs of no ASCII white space, lower-cased. A line without words
    is never removed. Two lines match if 100 * common words >= percent * words of either. A line goes if any earlier one
    matches it, removed itself or not. Null and empty texts are one empty line. A repeated row counts as one document,
    and so do all rows without an id, which come first. An empty table gives an empty result. Other columns are left alone.
    """
    docs = docs.select("doc_id", text)
    lines = _profiles(docs, text, percent)
    found = lines.where("n > 0").groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "line_no", "h", "n", "bits", "marks")).alias("f")).select("c1", "c2", "copies", "f.*")
    # ids ascend as the classes' first lines do
    classes = written(found.orderBy("doc_id", "line_no", "h").withColumn("id", F.monotonically_increasing_id()), "classes")
    marks = classes.where("marks IS NOT NULL").select("id", "n", "bits", F.explode("marks").alias("mark"))
    both, larger = F.col("n") + F.col("n_a"), F.greatest("n", "n_a")
    overlap = _ceil(percent * both, 100 + percent)
    # whole sets differ by the words of either that the other lacks; of the smallest words, each of these may push out one more
    apart = F.when(larger <= MAPPED, both - 2 * overlap).otherwise(2 * (larger - overlap))
    alike = (100 * F.least("n", "n_a") >= percent * larger) & (F.bit_count(F.col("bits").bitwiseXOR(F.col("bits_a"))) <= apart)
    # a mark's classes in order, in one shuffle: each meets the first of them; pairs of others are left where there are two or more
    order = Window.partitionBy("mark").orderBy("id")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    firsts = (F.first(c).over(so_far).alias(f"{c}_a") for c in ("id", "n", "bits"))
    queued = marks.select("*", *firsts, F.row_number().over(order).alias("place"), F.lead("id").over(order).alias("next")).where("place > 1")
    first = F.when((F.col("id") != F.col("id_a")) & alike, F.col("id_a"))
    met = queued.select("mark", "id", "n", "bits", first.alias("first"), ((F.col("place") > 2) | F.col("next").isNotNull()).alias("more"))
    met = written(met.where("first IS NOT NULL OR more"), "met")
    settled = _later(met.where("first IS NOT NULL").select(F.col("first").alias("a"), F.col("id").alias("b")), classes, docs, text, percent)
    others = met.where("more").select("mark", "id", "n", "bits")
    earlier = others.select("mark", *(F.col(c).alias(f"{c}_a") for c in ("id", "n", "bits")))
    rest = others.join(settled, "id", "left_anti").join(earlier, "mark").where((F.col("id_a") < F.col("id")) & alike)
    late = settled.union(_later(rest.select(F.col("id_a").alias("a"), F.col("id").alias("b")), classes, docs, text, percent)).distinct()
    named = classes.select("c1", "c2", "id", "copies", F.col("doc_id").alias("d"), F.col("line_no").alias("l")).join(late.withColumn("late", F.lit(True)), "id", "left")
    verdict = written(named.where("late OR copies > 1").select("c1", "c2", "d", "l", F.coalesce("late", F.lit(False)).alias("late")), "verdict")
    dropped(classes, settled, met)
    first = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("line_no") == F.col("l"))
    gone = lines.select("doc_id", "line_no", "c1", "c2").join(verdict, ["c1", "c2"]).where(F.col("late") | ~first)
    gone = gone.groupBy("doc_id").agg(F.sort_array(F.collect_set("line_no")).alias("removed")).withColumnRenamed("doc_id", "_d")
    counts = lines.groupBy("doc_id").agg((F.max("line_no") + 1).cast("long").alias("n_lines"))
    none = F.expr("cast(array() as array<int>)")
    out = counts.join(gone, F.col("doc_id").eqNullSafe(F.col("_d")), "left").withColumn("removed", F.coalesce("removed", none))
    return out.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed")


def without_lines(docs: DataFrame, removed: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` whose texts lack the lines named by ``similar_lines``."""
    found = removed.select(F.col("doc_id").alias("_d"), F.col("removed").alias("_gone"))
    joined = docs.join(found, docs["doc_id"].eqNullSafe(F.col("_d")), "left")
    kept = F.filter(F.split(text, "\n"), lambda line, i: ~F.array_contains("_gone", i))
    return joined.withColumn(text, F.array_join(kept, "\n")).drop("_d", "_gone")


def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    found = similar_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_lines", "n_removed", F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"))


ORACLE_SQL = r"""
WITH l AS (SELECT doc_id, unnest(range(0, len(x))) AS line_no, x FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)),
w AS (SELECT doc_id, line_no, list_sort(list_distinct(regexp_extract_all(lower(x[line_no + 1]), '[^\x20\x09-\x0D]+'))) AS s FROM l),
c AS (SELECT s, min((doc_id, line_no)) AS f, row_number() OVER () AS k, len(s) AS n FROM w WHERE len(s) > 0 GROUP BY s),
t AS (SELECT k, n, unnest(s) AS word FROM c),
df AS (SELECT word, count(*) AS df FROM t GROUP BY word),
p AS (SELECT k, word FROM (SELECT k, n, word, row_number() OVER (PARTITION BY k ORDER BY df, word) AS r FROM t JOIN df USING (word)) WHERE r <= n - ceil(n * 90 / 100.0) + 1),
q AS (SELECT DISTINCT a.k AS a, b.k AS b FROM p a JOIN p b ON a.word = b.word AND a.k < b.k),
m AS (SELECT a.f AS fa, b.f AS fb FROM q JOIN c a ON q.a = a.k JOIN c b ON q.b = b.k
  WHERE 190 * len(list_intersect(a.s, b.s)) >= 90 * (a.n + b.n)),
late AS (SELECT DISTINCT greatest(fa, fb) AS f FROM m),
j AS (SELECT w.doc_id, w.line_no, len(w.s) > 0 AND ((w.doc_id, w.line_no) <> c.f OR c.f IN (SELECT f FROM late)) AS goes FROM w LEFT JOIN c ON w.s = c.s)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE goes)::BIGINT AS n_removed,
  coalesce(string_agg(line_no::VARCHAR, ',' ORDER BY line_no) FILTER (WHERE goes), '') AS removed FROM j GROUP BY doc_id"""
