"""Periodic runs of words: Main-Lorentz divide and conquer on interned word ids.

The words of a batch of texts are interned: equal bytes have equal ids, by Arrow's dictionary and not by a hash. Each text
is halved again and again. A run of four periods or more that lies in a piece and crosses its middle has two periods or
more on one side of it, so it shows as a repetition that starts or ends at the middle: the Z-function of the right half
says how far the words from the middle agree with those one period later, that of the reversed left half, followed by
the other half, how far they agree backwards, and the two together extend the repetition both ways. What goes on outside
its piece belongs to a run that crosses a middle above, and is left to that one. Equal intervals are merged, and each keeps
its smallest period.

All pieces of one level are looked at together first, in NumPy passes over the whole batch: a period q can only be that of
a run through the middle m if nine words, evenly spread over the period beside m, agree with those one period on, and nine
words of the period before or after it do too. It's a necessary condition, so the Z-functions run only where some period
passes it and nothing is lost. Time is n log n for each text, whatever it holds, as a piece's Z-functions are linear.

Texts are independent, so the operator is one narrow pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tokens

#: A run has this many periods and words at least.
PERIODS, LEAST = 4, 6
_SCHEMA = "doc_id {}, n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs string, runs_sha256 string, collapsed_text string"


def packed(words: tokens.Words) -> pa.Array:
    """The words as an Arrow column."""
    size = words.end - words.start
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    at = np.arange(offsets[-1]) + np.repeat(words.start - offsets[:-1], size)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(words.data[at])])


def interned(words: tokens.Words) -> np.ndarray:
    """Ids of the words: equal exactly if their bytes are."""
    return packed(words).dictionary_encode().indices.to_numpy()


def z_function(s: list[int]) -> list[int]:
    """z[i]: how many ids from i on agree with those from 0 on; z[0] is the whole length."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def _crossing(s: list[int], lo: int, m: int, hi: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, period) of repetitions of four periods or more in [lo, hi) that have two or more on a side of m."""
    right, left = s[m:hi], s[lo:m][::-1]
    # agreement forwards from m, and backwards from m - 1; a separator that is no id keeps the halves apart
    ahead, behind = z_function(right), z_function(left)
    ahead_of_left = z_function(right + [-1] + s[lo:hi])  # from each place
    behind_right = z_function(left + [-1] + s[lo:hi][::-1])  # back from each place
    n_right, n_left = len(right), len(left)
    for q in range(1, n_right // 2 + 1):
        if ahead[q] >= q:
            back = behind_right[n_left + 1 + n_right - q] if n_left else 0
            start, end = m - back, m + q + ahead[q]
            if end - start >= PERIODS * q:
                yield start, end, q
    for q in range(1, n_left // 2 + 1):
        if behind[q] >= q:
            on = ahead_of_left[n_right + 1 + n_left - q] if n_right else 0
            start, end = m - q - behind[q], m + on
            if end - start >= PERIODS * q:
                yield start, end, q


def _pieces(ids: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(lo, m, hi) of all pieces of all texts whose middle may lie in a run."""
    lo, hi = first[:-1].astype(np.int64), first[1:].astype(np.int64)
    while True:
        long = hi - lo >= LEAST
        lo, hi = lo[long], hi[long]
        if not len(lo):
            return
        m = (lo + hi) // 2
        may = np.zeros(len(lo), bool)
        for side, room in ((1, hi - m), (-1, m - lo)):
            # periods 1 to room // 2 beside each middle, in portions of bounded size
            most = room // 2
            ends = np.cumsum(most)
            at = 0
            while at < len(most):
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (1 << 20), side="right")))
                piece = np.repeat(np.arange(at, to), most[at:to])
                q = np.arange(len(piece)) - np.repeat(np.cumsum(most[at:to]) - most[at:to], most[at:to]) + 1
                origin = m[piece] if side == 1 else m[piece] - 1
                for eighth in (0, 8, 4, 2, 6, 1, 3, 5, 7):
                    # two periods, or three words, beside the middle must agree: as many places as this less one period
                    n_equal = np.maximum(q, LEAST // 2 - q)
                    offset = (n_equal - 1) * eighth // 8
                    same = ids[np.clip(origin + side * offset, 0, len(ids) - 1)] == ids[np.clip(origin + side * (offset + q), 0, len(ids) - 1)]
                    piece, q, origin = piece[same], q[same], origin[same]
                # the other two periods lie so that one more period agrees, on this side or on the other one
                start = np.minimum(origin, origin + side * (2 * q - 1))
                may[piece[_agrees(ids, lo[piece], hi[piece], start - q, q) | _agrees(ids, lo[piece], hi[piece], start + q, q)]] = True
                at = to
        yield from zip(lo[may].tolist(), m[may].tolist(), hi[may].tolist())
        lo, hi = np.concatenate([lo, m]), np.concatenate([m, hi])


def _agrees(ids: np.ndarray, lo: np.ndarray, hi: np.ndarray, start: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whether [start, start + 2q) lies in [lo, hi) and nine words of its first half equal those one period on."""
    out = (start >= lo) & (start + 2 * q <= hi)
    for eighth in range(9):
        at = np.clip(start + (q - 1) * eighth // 8, 0, len(ids) - 1)
        out &= ids[at] == ids[np.clip(at + q, 0, len(ids) - 1)]
    return out


def runs_of(ids: np.ndarray, first: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """For each text, its runs as (start, length, period), in order."""
    found: list[dict[tuple[int, int], int]] = [{} for _ in range(len(first) - 1)]
    for lo, m, hi in _pieces(ids, first):
        text = int(np.searchsorted(first, lo, side="right")) - 1
        whole = found[text]
        own = ids[lo:hi].tolist()
        for start, end, q in _crossing(own, 0, m - lo, hi - lo):
            a, b = start + lo, end + lo
            # what goes on outside its piece crosses a middle above and was found there
            goes_on = start == 0 and a > first[text] and ids[a - 1] == ids[a - 1 + q] or end == hi - lo and b < first[text + 1] and ids[b] == ids[b - q]
            if b - a >= LEAST and not goes_on:
                whole[a, b] = min(q, whole.get((a, b), q))
    return [sorted((int(a - f), int(b - a), q) for (a, b), q in x.items()) for f, x in zip(first[:-1], found)]


def _periodic(docs_type: str, transform: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, repeat_from, repeat_period = (tokens.column_of(batch, c) for c in ("doc_id", "_from", "_period"))
            for i, j, words in tokens.sliced(tokens.column_of(batch, "text"), tokens.WHITESPACE):
                order = np.arange(len(words.start))
                if transform:
                    _repeat(order, words.first, repeat_from.slice(i, j - i).to_pylist(), repeat_period.slice(i, j - i).to_pylist())
                ids = interned(words)[order]
                rows = []
                for k, runs in enumerate(runs_of(ids, words.first)):
                    a, b = int(words.first[k]), int(words.first[k + 1])
                    keep = np.ones(b - a, bool)
                    for start, length, q in runs:
                        keep[start + q : start + length] = False
                    kept = order[a:b][keep]
                    data = words.data
                    text = b" ".join(data[s:e].tobytes() for s, e in zip(words.start[kept].tolist(), words.end[kept].tolist()))
                    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
                    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
                    milli = 1000 * best[1] // best[2] if runs else None
                    rows.append((b - a, len(runs), *best, milli, listed, hashlib.sha256(listed.encode()).hexdigest(), text.decode()))
                types = [pa.int64()] * 6 + [pa.string()] * 3
                yield pa.RecordBatch.from_arrays([doc_ids.slice(i, j - i), *(pa.array(c, t) for c, t in zip(zip(*rows), types))], names=["doc_id", "n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs", "runs_sha256", "collapsed_text"])

    return run


def _repeat(order: np.ndarray, first: np.ndarray, starts: list, periods: list) -> None:
    """Word a + k of a text becomes its word a + k mod p, where a and p are given."""
    for f, end, a, p in zip(first[:-1].tolist(), first[1:].tolist(), starts, periods):
        if a is not None and p is not None and 0 <= a < end - f:
            order[f + a : end] = f + a + np.arange(end - f - a) % p


def periodic_runs(docs: DataFrame, repeat_from: Column | None = None, repeat_period: Column | None = None) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text; other columns are left alone): n_words, n_runs, the longest run's
    start, length, period and exponent_milli (null without a run), ``runs`` (each run's ``start,length,period`` and a line
    feed, by start, then period), its SHA-256, and ``collapsed_text``: the words that no run holds after its first period.

    Words: runs of no ASCII white space, numbered from 0. A run has four periods and six words or more. Of runs of one
    length, the first counts as longest. ``repeat_from`` and ``repeat_period`` (both a column of numbers; null: no change)
    make a text periodic from one of its words on before it is searched. Null, empty and blank texts have no words and no
    run. Repeated rows get equal results; an empty table gives an empty result.
    """
    none = F.lit(None).cast("long")
    asked = repeat_from is not None
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", (repeat_from if asked else none).cast("long").alias("_from"), (repeat_period if asked else none).cast("long").alias("_period"))
    return rows.mapInArrow(_periodic(kind, asked), _SCHEMA.format(kind))


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    n = F.size(F.array_remove(F.split(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "), " "), "")).cast("long")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    one = docs.select("doc_id", "text", F.when((h % 10 == 0) & (n > 0), n).alias("n"), g.alias("g"))
    start = F.col("g") % F.col("n")
    period = 1 + F.floor((F.col("n") - start) / (3 + F.col("g") % 8))
    found = periodic_runs(one, start, period)
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", F.sha2(F.col("collapsed_text").cast("binary"), 256).alias("collapsed_sha256"))


ORACLE_SQL = r"""
WITH c AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, xor(4294967295, list_reduce([4294967295] || flatten([[ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] FOR x IN string_split(doc_id::VARCHAR, '')]),
  lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END)) AS h FROM documents),
d AS (SELECT doc_id, w, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a, 3 + (h // 10) % 8 AS z FROM c),
e AS (SELECT *, 1 + (n - a) // z AS p FROM d),
u AS (SELECT doc_id, n, i, CASE WHEN i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS x FROM (SELECT *, unnest(range(n)) AS i FROM e)),
m AS (SELECT s.doc_id, s.i, t.i - s.i AS q FROM u s JOIN u t ON s.doc_id = t.doc_id AND s.x = t.x AND t.i > s.i AND 4 * (t.i - s.i) <= s.n),
g AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM m),
f AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM g GROUP BY doc_id, q, k HAVING count(*) + q >= greatest(6, 4 * q)),
r AS (SELECT doc_id, start, length, min(q) AS period FROM f GROUP BY doc_id, start, length),
o AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
k AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t FROM u ANTI JOIN o USING (doc_id, i) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS t, arg_min({s: start, n: length, q: period}, (-length, start, period)) AS b FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, b.s AS start, b.n AS length, b.q AS period, 1000 * b.n // b.q AS exponent_milli, sha256(coalesce(l.t, '')) AS runs_sha256, sha256(coalesce(k.t, '')) AS collapsed_sha256
FROM d LEFT JOIN l USING (doc_id) LEFT JOIN k USING (doc_id)"""
