"""Exact top-k search by inner product with a bit-sliced index.

Rows are dealt into blocks; a block's slices are built once, in one task, and the queries come to it one after another
(a stated query set against all rows), so a task holds one block and one batch of queries. In a row block, slice (d, b)
is a bitmap over its rows: bit b of component d. For one query the scores of all rows are added up as bitmaps:

* With u = x - min >= 0 for a component x and v = u where the query's component is positive, v = all ones - u (the
  flipped slices) where it is negative, a score is the sum of ``|q| * v`` and a constant of the query.
* ``|q| * v`` is the sum of v's slices shifted by each bit set in |q|. Slices of one weight are added by carry-save
  adders (two bitwise sums and a majority for 64 rows at a time) until one slice for each weight is left.
* The top rows are selected from the most significant slice of the sum downward.

The attributes are quantised: only the ``SLICES`` highest bits of u are kept, so a sum is below the true score by at
most E = sum of |q| * (2**dropped - 1). With T the k-th largest sum, rows whose sum is below T - E can't be in the
result; the boundary rows left, ties included, are scored on the integer components. So results are exact. Vectors with
components so large that a score might leave 64 bits stand beside the index and are scored with unbounded integers.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .groups import gathered

#: Rows of a row block (on average), least queries of a part of the queries, and slices kept of a component.
BLOCK_ROWS, BLOCK_QUERIES, SLICES = 16_384, 512, 6
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def _packed(flags: np.ndarray) -> np.ndarray:
    """Bitmaps of 64-bit words from flags along the last axis."""
    bits = np.packbits(flags, axis=-1, bitorder="little")
    pad = -bits.shape[-1] % 8
    if pad:
        bits = np.concatenate([bits, np.zeros((*bits.shape[:-1], pad), np.uint8)], axis=-1)
    return np.ascontiguousarray(bits).view(np.uint64)


def _indices(bitmap: np.ndarray, n: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little")[:n])


class SlicedBlock:
    """The index of a block of rows (a two-dimensional array of integers)."""

    def __init__(self, rows: np.ndarray) -> None:
        self.rows = rows
        self.low = int(rows.min(initial=0))
        bits = max(1, (int(rows.max(initial=0)) - self.low).bit_length())
        self.dropped = max(0, bits - SLICES)
        top = ((rows - self.low) >> self.dropped).T
        kept = bits - self.dropped
        self.up = np.stack([_packed((top >> b) & 1 == 1) for b in range(kept)], axis=1)  # dimension, bit, word
        self.all = _packed(np.ones(len(rows), bool))
        self.down = ~self.up & self.all

    def sums(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices of all rows' quantised scores, least significant first."""
        columns: list[list[np.ndarray]] = []
        for d in np.flatnonzero(query):
            q = int(query[d])
            slices, q = (self.up[d], q) if q > 0 else (self.down[d], -q)
            for j in range(q.bit_length()):
                if q >> j & 1:
                    while len(columns) < j + len(slices):
                        columns.append([])
                    for b, s in enumerate(slices):
                        columns[j + b].append(s)
        out, w = [], 0
        while w < len(columns):
            column = columns[w]
            if len(column) > 1 and w + 1 == len(columns):
                columns.append([])
            while len(column) > 1:
                a, b = column.pop(), column.pop()
                part = a ^ b
                carry = a & b
                if column:
                    c = column.pop()
                    carry |= part & c
                    part ^= c
                    column.insert(0, part)
                else:
                    column.append(part)
                columns[w + 1].append(carry)
            out.append(column[0] if column else np.zeros_like(self.all))
            w += 1
        return out

    def best(self, query: np.ndarray, k: int, eligible: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row indices, scores) of all rows that may be among the k best eligible ones, ties included."""
        n = len(self.rows)
        count = lambda bitmap: int(np.bitwise_count(bitmap).sum())
        if count(eligible) > k:
            slices = self.sums(query)
            sure, open_rows, threshold = np.zeros_like(eligible), eligible, 0
            for w in range(len(slices) - 1, -1, -1):
                both = open_rows & slices[w]
                if count(sure | both) >= k:
                    open_rows = both
                    threshold |= 1 << w
                else:
                    sure |= both
                    open_rows = open_rows & ~slices[w]
            error = sum(abs(int(q)) for q in query) * ((1 << self.dropped) - 1)
            least = max(0, (threshold << self.dropped) - error)
            least = -(-least >> self.dropped)  # sums are whole multiples of 2**dropped
            above, equal = np.zeros_like(eligible), eligible
            for w in range(max(len(slices), least.bit_length()) - 1, -1, -1):
                s = slices[w] if w < len(slices) else np.zeros_like(eligible)
                if least >> w & 1:
                    equal = equal & s
                else:
                    above = above | (equal & s)
                    equal = equal & ~s
            eligible = above | equal
        at = _indices(eligible, n)
        return at, self.rows[at].astype(np.int64) @ query.astype(np.int64)


def _whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of doubles, as integers of any size."""
    return np.array([math.floor(Fraction(x) * scale) for x in values.ravel().tolist()], object).reshape(values.shape)


class Block:
    """Rows of one length: the sliced index of those whose scores fit 64 bits, and the few others as they are."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, scale: int) -> None:
        self.scale = scale
        self.most = float(math.isqrt((1 << 62) // max(1, values.shape[1])))  # two components below it, and all products of a score, fit
        narrow = self.narrow(values)
        self.ids, self.wide_ids, self.wide = ids[narrow], ids[~narrow], values[~narrow]
        self.index = SlicedBlock(np.floor(values[narrow] * scale).astype(np.int64))

    def narrow(self, values: np.ndarray) -> np.ndarray:
        return (np.abs(values) < self.most / self.scale).all(axis=1)

    def best(self, own: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(score, id) of the k best rows but those with the query's id; ties to the smaller id."""
        found: list[tuple[int, int]] = []
        exact = not self.narrow(query[None])[0]
        if not exact:
            asked = np.floor(query * self.scale).astype(np.int64)
            row, score = self.index.best(asked, k, _packed(self.ids != own))
            order = np.lexsort((self.ids[row], -score))[:k]
            found = list(zip(score[order].tolist(), self.ids[row[order]].tolist()))
        if exact or len(self.wide_ids):
            asked = _whole(query, self.scale)
            for ids, rows in ((self.wide_ids, _whole(self.wide, self.scale)), *([(self.ids, self.index.rows.astype(object))] if exact else [])):
                found += [(int(x), i) for x, i in zip(rows @ asked if rows.shape[1] else [0] * len(ids), ids.tolist()) if i != own]
            found = heapq.nsmallest(k, found, key=lambda x: (-x[0], x[1]))
        return found


def _shown(score: int) -> tuple[int, bytes | None]:
    """The nearest long; where that is one of its ends, also bytes that are in order as the true scores are."""
    if _LEAST < score < _MOST:
        return score, None
    return max(_LEAST, min(_MOST, score)), (score + (1 << 2399)).to_bytes(300, "big")


def _search(k: int, scale: int):
    schema = pa.schema([("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("beyond", pa.binary())])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
        """Runs of rows of one tile, length and kind."""
        for batch in batches:
            if batch.num_rows:
                keys = np.stack([tokens.column_of(batch, c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("rows", "queries", "size", "asks")], axis=1)
                cuts = (np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist()
                for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                    yield tuple(keys[a].tolist()), batch.slice(a, b - a)

    def vectors(part: pa.RecordBatch, size: int) -> np.ndarray:
        return tokens.column_of(part, "vector").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held, block = None, [], None
        for (*now, size, asks), part in parts(batches):
            if (*now, size) != tile:
                tile, held, block = (*now, size), [], None
            if not asks:  # a tile's rows come before its queries
                held.append(part)
                continue
            if block is None:
                if not held:
                    continue
                ids = np.concatenate([tokens.column_of(x, "vec_id").to_numpy() for x in held])
                block, held = Block(ids, np.concatenate([vectors(x, size) for x in held]), scale), []
            out: list[tuple] = []
            own, key = tokens.column_of(part, "vec_id").to_pylist(), tokens.column_of(part, "key").to_pylist()
            for i, vector in enumerate(vectors(part, size)):
                out += [(key[i], own[i], found, *_shown(score)) for score, found in block.best(own[i], vector, k)]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], f.type) for c, f in enumerate(schema)], schema=schema)

    return run


def top_k(vectors: DataFrame, is_query, k: int = 5, scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``vectors`` where ``is_query`` holds, its k best other rows.

    ``vectors`` has vec_id and embedding; other columns are left alone. A component x counts as floor(scale * x), x as
    double; a score is the inner product of these integers; ties go to the smaller vec_id. Rows with the query's vec_id
    are no candidates. Vectors that are null or hold a null or non-finite component, and rows without a vec_id, take no
    part. Vectors of different lengths are not compared; empty ones have score 0 with each other. A repeated query row
    is answered each time, a repeated candidate counts each time. Fewer than k candidates give fewer rows. A score beyond
    64 bits has its true rank and is shown as the nearest long.
    """
    usable = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.where(usable).select(F.col("vec_id").cast("long"), F.size("embedding").alias("size"), F.col("embedding").cast("array<double>").alias("vector"), is_query.alias("asks"))
    n_rows, n_queries = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    row_blocks = max(1, -(-n_rows // BLOCK_ROWS))
    # with fewer blocks than the cluster has cores for, a block is built for each part of the queries
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    query_parts = max(1, min(-(-n_queries // BLOCK_QUERIES), -(-2 * cores // row_blocks)))
    deal = F.xxhash64("vec_id", "vector")
    part = lambda n: F.pmod(deal, F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    candidates = rows.select("vec_id", "size", "vector", F.lit(False).alias("asks"), F.lit(0).cast("long").alias("key"), part(row_blocks).alias("rows"), every(query_parts).alias("queries"))
    keyed = rows.where("asks").withColumn("key", F.monotonically_increasing_id())
    queries = keyed.select("vec_id", "size", "vector", "asks", "key", every(row_blocks).alias("rows"), part(query_parts).alias("queries"))
    tiles = gathered(candidates.union(queries), "rows", "queries", then=("size", "asks"))
    near = tiles.mapInArrow(_search(k, scale), "query long, query_id long, vec_id long, score long, beyond binary")
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.desc("beyond"), "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_topk_search(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, F.coalesce(F.pmod(F.col("vec_id"), F.lit(50)) == 0, F.lit(False)))


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, coalesce(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])), 0)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, rank, vec_id, score
FROM (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s)
WHERE rank <= 5"""
