"""Benchmark decontamination: Wu-Manber search for many word sequences at once.

The patterns are the windows of 13 consecutive words of each benchmark item (a shorter item is one window). Over words
in place of characters, with blocks of two words: a shift table, indexed by a hash of the block that ends at the current
position, says how far the search may move on since no pattern can end before; blocks unknown to all patterns skip 12
words. Where the shift is zero, the hash of the last two words selects a bucket of test patterns, the window's hash
selects within the bucket, and a comparison of the words themselves, byte by byte, confirms. Many stretches of a batch are searched in step, so
each of these is a NumPy pass.

A benchmark is cut into blocks of about ``PATTERN_BYTES`` of text, and each block's tables are a broadcast, which an executor
keeps on its disk. The texts pass by once: a task holds some MB of them, and searches them for one block after another with
the tables of one in memory. So neither the driver nor a task holds more than one block's tables, whatever the benchmark's
size. Documents are never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, types
from pyspark.sql import functions as F

from . import tokens
from .shared import written

WINDOW = 13
#: Benchmark text, in bytes, of one block; its tables take some ten times that.
PATTERN_BYTES = 4 << 20
#: Text that a task holds while it goes through several blocks, in bytes.
HELD_BYTES = 16 << 20
#: Words of a stretch that one cursor walks.
STRETCH = 256
_Q = np.uint64(0xD6E8FEB86659FD93)


def _sequence_hash(words: np.ndarray, start: np.ndarray, m: int) -> np.ndarray:
    out = np.zeros(len(start), np.uint64)
    for j in range(m):
        out = out * _Q + words[start + j]
    return tokens.mixed(out)


class Patterns:
    """Wu-Manber tables for all patterns of one length m. Pattern p is words at[p] to at[p]+m and belongs to item[p].

    Patterns with one key are taken for equal where they are searched; ``patterns_of`` sees to it that they are.
    """

    def __init__(self, texts: tokens.Words, words: np.ndarray, at: np.ndarray, item: np.ndarray, m: int) -> None:
        self.m, self.block, self.texts = m, min(2, m), texts
        key = _sequence_hash(words, at, m)
        order = np.lexsort((item, key))
        self.at, self.item, self.key = at[order], item[order], key[order]
        offsets = range(m - self.block + 1)
        blocks = [self._block(words, at + j + self.block - 1) for j in offsets]
        self.mask = np.uint64((1 << max(8, (16 * len(at) * len(blocks)).bit_length())) - 1)
        self.shift = np.full(int(self.mask) + 1, m - self.block + 1, np.int64)
        for j, b in zip(offsets, blocks):
            np.minimum.at(self.shift, (b & self.mask).astype(np.int64), m - self.block - j)
        self.suffixes = np.unique(blocks[-1])

    def _block(self, words: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _sequence_hash(words, end - self.block + 1, self.block)

    def search(self, texts: tokens.Words, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start in words, first of the equal patterns) of each occurrence. ``words``: the hashes of those of ``texts``."""
        m = self.m
        ends = []
        at = np.arange(m - 1, len(words), STRETCH)
        stop = np.minimum(at + STRETCH, len(words))
        while len(at):
            block = self._block(words, at)
            move = self.shift[(block & self.mask).astype(np.int64)]
            zero = move == 0
            if zero.any():
                here = np.searchsorted(self.suffixes, block[zero])
                bucket = self.suffixes[np.minimum(here, len(self.suffixes) - 1)] == block[zero]
                ends.append(at[zero][bucket])
            at = at + np.maximum(move, 1)
            on = at < stop
            at, stop = at[on], stop[on]
        if not ends:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        start = np.sort(np.concatenate(ends)) - m + 1
        key = _sequence_hash(words, start, m)
        first = np.searchsorted(self.key, key)
        first[first == len(self.key)] = 0
        found = self.key[first] == key
        start, first = start[found], first[found]
        for j in range(m):
            same = tokens.same_words(texts, start + j, self.texts, self.at[first] + j)
            start, first = start[same], first[same]
        return start, first

    def items(self, first: int) -> np.ndarray:
        return np.unique(self.item[first : np.searchsorted(self.key, self.key[first], side="right")])


def patterns_of(texts: list[str | None], window: int) -> list[Patterns]:
    """Tables for each pattern length that occurs; item numbers are positions in ``texts``."""
    data, offsets = tokens.buffers(pa.array(texts, pa.string()))
    words = tokens.split(data, offsets, tokens.NOT_ALPHANUMERIC, lower=True)
    hashes, counts = words.hashes(), words.counts
    out = []
    for m in sorted({min(int(c), window) for c in counts if c}):
        at, item = [], []
        for i in np.flatnonzero(np.minimum(counts, window) == m):
            starts = np.arange(words.first[i], words.first[i + 1] - m + 1)
            at.append(starts)
            item.append(np.full(len(starts), i))
        at, item = np.concatenate(at), np.concatenate(item)
        while len(at):
            one = Patterns(words, hashes, at, item, m)
            lead = np.searchsorted(one.key, one.key)
            same = np.ones(len(one.key), bool)
            for j in range(m):
                same &= tokens.same_words(words, one.at + j, words, one.at[lead] + j)
            # different windows that share a key are searched for one after another
            at, item = one.at[~same], one.item[~same]
            out.append(one if same.all() else Patterns(words, hashes, one.at[same], one.item[same], m))
    return out


def _portions(batches: Iterator[pa.RecordBatch], text: str, most: int) -> Iterator[list[tuple[pa.RecordBatch, tokens.Words]]]:
    """Slices of batches with their words, ``most`` bytes of text or little more at a time."""
    held, size = [], 0
    for batch in batches:
        for i, j, words in tokens.sliced(tokens.column_of(batch, text), tokens.NOT_ALPHANUMERIC, lower=True):
            held.append((batch.slice(i, j - i), words))
            size += len(words.data)
            if size >= most:
                yield held
                held, size = [], 0
    if held:
        yield held


def _scan(tables: list, text: str):
    """Adds to each row: its words, the hit words' positions (as flags packed into bits), its items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _portions(batches, text, HELD_BYTES if len(tables) > 1 else 0):
            hits = [np.zeros(len(words.start), bool) for _, words in held]
            items: list[list[set[str]]] = [[set() for _ in range(part.num_rows)] for part, _ in held]
            for table in tables:
                # one block's tables at a time, unless there is but one
                patterns, ids = table.value if len(tables) == 1 else table.load_from_path(table._path)
                for (_, words), hit, found in zip(held, hits, items):
                    hashes, owner = words.hashes(), words.text_of()
                    cover = np.zeros(len(hashes) + 1, np.int32)
                    for p in patterns:
                        start, first = p.search(words, hashes)
                        inside = owner[start] == owner[start + p.m - 1]
                        start, first = start[inside], first[inside]
                        np.add.at(cover, start, 1)
                        np.add.at(cover, start + p.m, -1)
                        if len(start):
                            for doc, one in np.unique(np.stack([owner[start], first]), axis=1).T:
                                found[doc].update(ids[k] for k in p.items(one))
                    hit |= np.cumsum(cover[:-1]) > 0
                del patterns, ids
            for (part, words), hit, found in zip(held, hits, items):
                bits = [np.packbits(hit[a:b]).tobytes() if hit[a:b].any() else b"" for a, b in zip(words.first[:-1], words.first[1:])]
                columns = [*part.columns, pa.array(words.counts.astype(np.int64)), pa.array(bits, pa.binary()), pa.array([sorted(x) for x in found], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "_n_words", "_hit", "_items"])

    return run


def _hits(column: Column) -> Column:
    """The number of bits set: each hex digit's count, by removing digits of other counts."""
    digits = F.hex(column)
    size = lambda kept: F.length(F.regexp_replace(digits, f"[^{kept}]", ""))
    return (size("1248") + 2 * size("3569AC") + 3 * size("7BDE") + 4 * size("F")).cast("long")


def find_benchmark(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with _n_words (long), _n_hit (long: words inside an occurrence) and _items (sorted ids as strings).

    Words: runs of ASCII letters and digits (A-Z lower-cased) and of non-ASCII characters. Null and empty texts have no
    words; items without words have no windows; an item without an id counts under the empty id, and items that share
    an id count as one. Repeated rows are judged each by itself. An empty benchmark hits nothing. Columns of ``docs``
    pass through, but for ones named as the results are, which are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("_n_words", "_n_hit", "_hit", "_items")
    named = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"), F.col(item_text).alias("t"))
    total = named.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n_blocks = max(1, math.ceil(total / PATTERN_BYTES))
    extra = [types.StructField("_n_words", types.LongType()), types.StructField("_hit", types.BinaryType()), types.StructField("_items", types.ArrayType(types.StringType()))]
    schema = types.StructType([*docs.schema.fields, *extra])
    if n_blocks > 1:
        # the benchmark is read once, and each block's rows lie together
        named = written(named.withColumn("block", F.pmod(F.xxhash64("id", "t"), F.lit(n_blocks)).cast("int")).repartitionByRange("block").sortWithinPartitions("block"), "benchmark")
    tables = []
    for k in range(n_blocks):
        block = (named.where(F.col("block") == k) if n_blocks > 1 else named).collect()
        tables.append(spark.sparkContext.broadcast((patterns_of([r["t"] for r in block], window), [r["id"] for r in block])))
    docs = docs.mapInArrow(_scan(tables, text), schema)
    return docs.withColumn("_n_hit", _hits(F.col("_hit"))).drop("_hit")


def contaminated(part: int = 20) -> Column:
    """Whether at least one word in ``part`` lies inside an occurrence."""
    return (F.col("_n_hit") > 0) & (part * F.col("_n_hit") >= F.col("_n_words"))


def op7_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        F.col("_n_hit").alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_items", ",").cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item_id, least(len(w), 13) AS m, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i, w FROM b WHERE len(w) > 0),
p AS (SELECT DISTINCT item_id, m, list_slice(w, i, i + m - 1) AS x FROM bw),
ms AS (SELECT DISTINCT m FROM p),
dw AS (SELECT doc_id, m, w, unnest(range(1, len(w) - m + 2)) AS i FROM d, ms WHERE len(w) >= m),
o AS (SELECT dw.doc_id, dw.m, dw.i, p.item_id FROM dw JOIN p ON p.m = dw.m AND list_slice(dw.w, dw.i, dw.i + dw.m - 1) = p.x),
h AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS k FROM o) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS l FROM (SELECT DISTINCT doc_id, item_id FROM o) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(l, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)"""
