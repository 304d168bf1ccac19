"""Substring deduplication: Rabin-Karp hashes of every window of words, counted in Spark.

1. A batch of texts is hashed at once: each word, then each window of consecutive words by a rolling polynomial. Equal
   windows inside a batch are recognised there; each different window of the batch is sent on once, so a window that
   stands in a third of all rows costs a row for each batch and not for each text.
2. Hashes are dealt into buckets by their value. What is sent is a row for each batch and bucket with the hashes packed
   into one binary value and the windows' places in the batch, in order, as one-byte steps: about nine bytes a window.
   A row more for each batch has its texts' ids and sizes.
3. A bucket holds all occurrences of its hashes. It tells each batch which of its windows occur elsewhere.
4. Each batch's answers meet its ids: a text's repeated windows, merged into maximal intervals of words, are joined to
   the texts by id and text hash, and the words are removed.

A window has two independent hashes. The second one names its bucket and the first one, of 64 bits, is compared there, so two
windows are taken for equal if they agree in 64 bits and in the bucket: with N windows and B buckets, some N**2 / (B * 2**65)
pairs of different windows must be expected to, which is 7 at 100 TB and 2**20 buckets. Words are hashed with all their bytes.
Whether two windows are equal is judged on the input, so all copies of a passage go.

Only texts that lose words are shuffled for that; flags, of bounded size, tell the others, which are copied as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .groups import gathered, groups
from .shared import flags_of, shuffle_partitions, written

#: Text of one batch, in bytes; one longer text is a batch by itself.
BATCH_BYTES = 4 << 20
#: Flags for the texts that lose words, 16 for each up to so many.
MOST_FLAGS = 1 << 26
_PIECES = pa.schema([("bucket", pa.int32()), ("batch", pa.int64()), ("hashes", pa.binary()), ("steps", pa.binary()), ("repeated", pa.binary())])


def _steps(places: np.ndarray) -> bytes:
    """Ascending places as differences of one byte; 255 says that 254 more follow without a place."""
    gaps = np.diff(places, prepend=-1) - 1
    extra = gaps // 254 if len(gaps) else gaps
    out = np.full(int(len(gaps) + extra.sum()), 255, np.uint8)
    out[np.cumsum(extra + 1) - 1] = gaps % 254
    return out.tobytes()


def _places(steps: bytes) -> np.ndarray:
    raw = np.frombuffer(steps, np.uint8)
    moved = np.cumsum(np.where(raw == 255, 254, raw.astype(np.int64) + 1))
    return moved[raw != 255] - 1


def _ranges(flags: np.ndarray) -> np.ndarray:
    """start, end, start, end ... of the runs of set flags."""
    padded = np.concatenate([[False], flags, [False]])
    return np.flatnonzero(padded[1:] != padded[:-1]).astype(np.int32)


def two_hashes(words: tokens.Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start word, hash, another hash) of each window."""
    hashes = words.hashes()
    place, value = words.windows(hashes, window)
    _, second = words.windows(tokens.mixed(hashes ^ np.uint64(0xA0761D6478BD642F)), window)
    return place, value, second


def _packed(words: tokens.Words, window: int, buckets: int, serial: int) -> tuple[pa.RecordBatch, np.ndarray]:
    """A row for each bucket that a batch has windows in, and the ranges of windows that are repeated within the batch."""
    place, value, second = two_hashes(words, window)
    # every first occurrence in the batch is sent; windows repeated within the batch are known at once
    order = np.argsort(value, kind="stable")
    if ((value[order][1:] == value[order][:-1]) & (second[order][1:] != second[order][:-1])).any():
        order = np.lexsort((second, value))  # stable, too
    ordered, other = value[order], second[order]
    new = np.ones(len(ordered), bool)
    new[1:] = (ordered[1:] != ordered[:-1]) | (other[1:] != other[:-1])
    del ordered, other
    group = np.cumsum(new, dtype=np.int32) - 1
    twice = (np.bincount(group, minlength=1) > 1)[group] if len(group) else np.zeros(0, bool)
    known = np.zeros(len(words.start), bool)
    known[place[order[twice]]] = True
    first = order[new]
    del group, twice, order, new
    bucket = (second[first] >> np.uint64(33)).astype(np.int64) % buckets
    del second
    # by bucket, then by place
    by = np.lexsort((place[first], bucket))
    first, bucket = first[by], bucket[by]
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    full = np.flatnonzero(np.diff(cuts))
    parts = [first[cuts[b] : cuts[b + 1]] for b in full]
    rows = pa.RecordBatch.from_arrays(
        [
            pa.array(full.astype(np.int32)),
            pa.array(np.full(len(full), serial, np.int64)),
            pa.array([value[p].tobytes() for p in parts], pa.binary()),
            pa.array([_steps(place[p]) for p in parts], pa.binary()),
            pa.array([np.packbits(known[place[p]]).tobytes() for p in parts], pa.binary()),
        ],
        schema=_PIECES,
    )
    return rows, _ranges(known)


def _hashed(window: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, checks = tokens.column_of(batch, "doc_id"), tokens.column_of(batch, "check")
            for i, j, words in tokens.sliced(tokens.column_of(batch, "text"), tokens.WHITESPACE, most=BATCH_BYTES):
                counts = words.counts.astype(np.int64)
                rows, known = _packed(words, window, buckets, serial)
                del words  # the next ones are made before this name is theirs
                yield rows
                about = np.stack([ids[i:j].fill_null(0).to_numpy(), ids[i:j].is_null().to_numpy(zero_copy_only=False).astype(np.int64), checks[i:j].to_numpy(), counts])
                spread = pa.array([-1 - serial % buckets], pa.int32())  # any partition will do
                yield pa.RecordBatch.from_arrays([spread, pa.array([serial], pa.int64()), pa.array([about.tobytes()], pa.binary()), pa.array([known.tobytes()], pa.binary()), pa.array([None], pa.binary())], schema=_PIECES)
                serial += 1

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches' own rows as they are; for a bucket, a row for each batch with the places of its repeated windows."""
    schema = pa.schema([("batch", pa.int64()), ("about", pa.binary()), ("places", pa.binary())])
    for group in groups(batches, "bucket"):
        batch = group["batch"].to_numpy()
        if group["bucket"][0].as_py() < 0:
            yield pa.RecordBatch.from_arrays([pa.array(batch), group["hashes"].combine_chunks(), group["steps"].combine_chunks()], schema=schema)
            continue
        hashes = [np.frombuffer(x, np.uint64) for x in group["hashes"].to_pylist()]
        sizes = np.array([len(x) for x in hashes])
        value = np.concatenate(hashes)
        order = np.argsort(value, kind="stable")
        ordered = value[order]
        equal = ordered[1:] == ordered[:-1]
        twice = np.zeros(len(value), bool)
        twice[order[1:][equal]] = True
        twice[order[:-1][equal]] = True
        ends = np.cumsum(sizes)
        who, out = [], []
        for k, (a, b) in enumerate(zip(ends - sizes, ends)):
            found = twice[a:b]
            if found.any():
                new = found & ~np.unpackbits(np.frombuffer(group["repeated"][k].as_py(), np.uint8))[: b - a].astype(bool)
                if new.any():
                    who.append(batch[k])
                    out.append(_steps(_places(group["steps"][k].as_py())[new]))
        # a window that is repeated within its batch is known already; it was sent for the others
        yield pa.RecordBatch.from_arrays([pa.array(who, pa.int64()), pa.nulls(len(who), pa.binary()), pa.array(out, pa.binary())], schema=schema)


def _merged(window: int):
    schema = pa.schema([("doc_id", pa.int64()), ("check", pa.int64()), ("removed", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, "batch"):
            about = group["about"].to_pylist()
            own = next(k for k, x in enumerate(about) if x is not None)
            ids, absent, check, counts = np.frombuffer(about[own], np.int64).reshape(4, -1)
            total = int(counts.sum())
            cover = np.zeros(total + window + 1, np.int32)
            places = group["places"].to_pylist()
            known = np.frombuffer(places[own], np.int32).reshape(-1, 2)
            starts = [np.arange(a, b) for a, b in known]
            starts += [_places(x) for k, x in enumerate(places) if k != own]
            for s in starts:
                cover[s] += 1  # a batch has a place once in each of these
                cover[s + window] -= 1
            gone = np.cumsum(cover)[:total] > 0
            ends = np.cumsum(counts)
            some = [k for k, (a, b) in enumerate(zip(ends - counts, ends)) if gone[a:b].any()]
            lists = [_ranges(gone[ends[k] - counts[k] : ends[k]]).tobytes() for k in some]
            some = np.array(some, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids[some], mask=absent[some].astype(bool)), pa.array(check[some]), pa.array(lists, pa.binary())], schema=schema)

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        removed, text = tokens.column_of(batch, "removed"), tokens.column_of(batch, "text")
        for i, j, words in tokens.sliced(text, tokens.WHITESPACE):
            counts, n_removed, kept_text = words.counts, [], []
            for k, ranges in enumerate(removed.slice(i, j - i).to_pylist()):
                a, b = words.first[k], words.first[k + 1]
                keep = np.ones(b - a, bool)
                for x, y in np.frombuffer(ranges or b"", np.int32).reshape(-1, 2):
                    keep[x:y] = False
                n_removed.append(int(len(keep) - keep.sum()))
                data = words.data
                kept_text.append(b" ".join(data[s:e].tobytes() for s, e in zip(words.start[a:b][keep].tolist(), words.end[a:b][keep].tolist())).decode())
            yield pa.RecordBatch.from_arrays(
                [tokens.column_of(batch, "doc_id").slice(i, j - i), pa.array(counts.astype(np.int64)), pa.array(n_removed, pa.int64()), pa.array(kept_text, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_text"],
            )


def remove_repeated(docs: DataFrame, window: int = 35) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) for each row of ``docs`` (doc_id, text; other columns are left alone).

    Words: runs of no ASCII white space. A word goes if a window of ``window`` words that covers it has a word sequence
    that starts anywhere else too. The words kept are joined by one space. Null and empty texts, and texts shorter than
    a window, lose nothing; rows without a doc_id are judged like others; a repeated row loses all windows, in each copy.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    checked = rows.withColumn("check", F.xxhash64("text"))
    # buckets of about half a million windows, at six bytes to a word
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(4 * shuffle_partitions(docs.sparkSession), min(size // (3 << 20), 1 << 20))
    pieces = checked.mapInArrow(_hashed(window, buckets), "bucket int, batch long, hashes binary, steps binary, repeated binary")
    answers = gathered(pieces, "bucket").mapInArrow(_counted, "batch long, about binary, places binary")
    removed = gathered(answers, "batch").mapInArrow(_merged(window), "doc_id long, check long, removed binary").dropDuplicates(["doc_id", "check"])
    removed = written(removed.withColumnsRenamed({"doc_id": "d", "check": "c"}), "removed")
    _, flagged = flags_of(removed.select(F.xxhash64("d", "c").alias("k")), 16 * removed.count(), MOST_FLAGS)
    loses = flagged(F.xxhash64("doc_id", "check"))
    # one plan at all sizes: the intervals of a third of all texts are no table to broadcast
    changed = checked.where(loses).join(removed.hint("merge"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("check") == F.col("c")), "left").select("doc_id", "text", "removed")
    whole = checked.where(~loses).select("doc_id", "text", F.lit(None).cast("binary").alias("removed"))
    return whole.unionByName(changed).mapInArrow(_cut, "doc_id long, n_words long, n_removed long, kept_text string")


def op5_substring_dedup(spark, sf_dir: str) -> DataFrame:
    kept = remove_repeated(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
h AS (SELECT doc_id, i, md5_number(array_to_string(list_slice(w, i, i + 34), ' ')) AS k FROM p),
r AS (SELECT k FROM h GROUP BY k HAVING count(*) > 1),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM h SEMI JOIN r USING (k)),
u AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
s AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t, count(*) AS n FROM u ANTI JOIN g USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(s.n, 0))::BIGINT AS n_removed, sha256(coalesce(s.t, '')) AS kept_sha256 FROM d LEFT JOIN s USING (doc_id)"""
