"""Phrases mined from depth-limited count tries.

1. Each task cuts its texts into shards of bounded size and builds a count trie of each shard and language: every word
   starts a path of up to four words of its piece, and a node counts the paths through it, which is how often its phrase
   occurs in the shard. A trie is held as its paths in sorted order; a path is coded as how many words it shares with the
   one before it, the words that follow, and its count.
2. Sampled splitters cut the order of all paths into ranges, by whole paths, so that no word or phrase is too common for
   one range. A shard's sorted paths are cut at the splitters, and a row goes to each range with the words and paths
   that fall in it. A range's sorted runs are merged, equal paths add up, and the sums over equal beginnings are the
   counts of its phrases. Phrases below the least count go no further, but for those at the ends of a range, which a
   neighbouring range may count as well; the parts of those are added up.
3. What is left is the merged trie down to the least count, as a table of (language, phrase, count). A phrase that is
   frequent has only frequent parts, so nothing that is needed is missing. A phrase's left parts are the nodes above it;
   its right parts are reached by dropping first words, which are its suffix links: both are equi-joins with the table.

Counts are exact, as words are told apart by their bytes. What travels is some five bytes for each different path of a shard.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .groups import gathered, groups
from .runs import packed
from .shared import dropped, shuffle_partitions, written

#: Most words of a phrase, which is the depth of the tries.
DEPTH = 4
#: Text of a shard, and of a range, in bytes; the most ranges, whose splitters the driver holds; sampled paths a range.
SHARD_BYTES, RANGE_BYTES, MOST_RANGES, SAMPLES = 8 << 20, 5 << 20, 1 << 16, 16
#: Parts in which a language's phrases are ranked first.
PARTS = 16
UNKNOWN = "und"

_PIECE_ENDS = tokens.separators((0x0A, 0x0D), *((ord(c), ord(c)) for c in ".,;:!?"))
_SEPARATORS = _PIECE_ENDS | tokens.separators((0x20, 0x20), (0x09, 0x09))
_RUNS = pa.schema([("range", pa.int32()), ("lang", pa.string()), ("n", pa.int64()), ("words", pa.binary()), ("paths", pa.binary())])

Path = tuple[bytes, ...]


def _shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[list[str], tokens.Words]]:
    """(language of each text, words) of portions of the texts, by language."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        _, offsets = tokens.buffers(tokens.column_of(batch, "text"))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most - size, side="right")) - 1)
            held.append(batch.slice(at, to - at))
            size += int(offsets[min(to, batch.num_rows)] - offsets[at])
            at = to
            if size >= most:
                yield _shard(held)
                held, size = [], 0
    if held:
        yield _shard(held)


def _shard(held: list[pa.RecordBatch]) -> tuple[list[str], tokens.Words]:
    table = pa.Table.from_batches(held)
    table = table.take(pc.sort_indices(table["lang"]))
    data, offsets = tokens.buffers(table["text"].cast(pa.large_string()).combine_chunks())
    return table["lang"].to_pylist(), tokens.split(data, offsets, _SEPARATORS, lower=True)


def _by_language(langs: list[str], words: tokens.Words) -> Iterator[tuple[str, int, int]]:
    """(language, first word, end word); the texts are sorted by language."""
    at = 0
    while at < len(langs):
        to = at
        while to < len(langs) and langs[to] == langs[at]:
            to += 1
        if words.first[to] > words.first[at]:
            yield langs[at], int(words.first[at]), int(words.first[to])
        at = to


def _pieces(words: tokens.Words) -> np.ndarray:
    """A number for each word, equal for words of one piece."""
    ends = np.cumsum(_PIECE_ENDS[words.data], dtype=np.int64)
    return ends[words.start] + words.text_of() if len(words.start) else np.zeros(0, np.int64)


def _ordered(found: pa.Array) -> tuple[list[bytes], np.ndarray]:
    """The different words in byte order, and for each word its number in that order, from 1."""
    coded = found.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(1, len(order) + 1)
    return coded.dictionary.take(pa.array(order)).to_pylist(), rank[coded.indices.to_numpy()]


def _summed(columns: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Different paths (a column for each depth) in order, and the sums of their counts."""
    if not len(columns[0]):
        return columns, np.zeros(0, np.int64)
    pairs = []
    for a, b in (columns[:2], columns[2:]):
        base = int(b.max(initial=0)) + 1
        different, place = np.unique(a.astype(np.int64) * base + b, return_inverse=True)
        pairs.append((different // base, different % base, place))
    (a, b, left), (c, d, right) = pairs
    key = left * np.int64(len(c)) + right
    del left, right, pairs
    order = np.argsort(key, kind="stable")  # merges runs that are in order
    key = key[order]
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sums = np.diff(np.append(new, len(key))) if counts is None else np.add.reduceat(counts[order], new)
    key = key[new]
    left, right = key // len(c), key % len(c)
    return [a[left], b[left], c[right], d[right]], sums


def _trie(ids: np.ndarray, piece: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The paths that start at each word, and how often each occurs. 0 stands behind a piece's end."""
    columns = [ids]
    for k in range(1, DEPTH):
        same = np.zeros(len(ids), bool)
        same[:-k] = piece[k:] == piece[:-k]
        on = np.zeros(len(ids), np.int64)
        on[:-k] = ids[k:]
        columns.append(np.where(same, on, 0))
    return _summed(columns)


def _coded(columns: list[np.ndarray], counts: np.ndarray, words: list[bytes]) -> tuple[bytes, bytes]:
    """(words, paths) of sorted paths."""
    paths = np.stack(columns, axis=1)
    used, local = np.unique(paths, return_inverse=True)
    local = local.reshape(paths.shape)
    if used[0] != 0:  # 0 stays 0
        local = local + 1
    used = used[used > 0]
    new = np.ones(paths.shape, bool)
    new[1:] = np.logical_or.accumulate(paths[1:] != paths[:-1], axis=1)
    tails = local[new].astype(np.uint16 if len(used) < 1 << 16 else np.uint32)
    body = new.sum(axis=1).astype(np.uint8).tobytes() + counts.astype(np.int64).tobytes() + tails.tobytes()
    return _small(b"\n".join([words[i - 1] for i in used.tolist()])), _small(body)


def _small(x: bytes) -> bytes:
    return np.int64(len(x)).tobytes() + pa.compress(x, codec="zstd", asbytes=True)


def _whole(x: bytes) -> bytes:
    return pa.decompress(x[8:], int(np.frombuffer(x, np.int64, 1)[0]), codec="zstd", asbytes=True)


def _decoded(n: int, n_words: int, coded: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    body = _whole(coded)
    tail = np.frombuffer(body, np.uint8, n)
    counts = np.frombuffer(body, np.int64, n, offset=n)
    tails = np.frombuffer(body, np.uint16 if n_words < 1 << 16 else np.uint32, offset=9 * n)
    new = np.arange(DEPTH) >= (DEPTH - tail.astype(np.int64))[:, None]
    paths = np.zeros((n, DEPTH), np.int32)
    paths[new] = tails
    columns = []
    for k in range(DEPTH):
        last = np.maximum.accumulate(np.where(new[:, k], np.arange(n), 0))
        columns.append(paths[last, k])
    return columns, counts


def _cuts(columns: list[np.ndarray], words: list[bytes], splitters: list[Path]) -> np.ndarray:
    """For each splitter, the place of the first path that is not before it."""
    out = np.zeros(len(splitters), np.int64)
    for s, path in enumerate(splitters):
        lo, hi = 0, len(columns[0])
        for column, word in zip(columns, path):
            at = bisect_left(words, word) if word else -1
            inside = column[lo:hi]
            begin = lo + int(np.searchsorted(inside, at + 1, side="left"))
            if word and (at == len(words) or words[at] != word):
                lo = begin
                break
            lo, hi = begin, lo + int(np.searchsorted(inside, at + 1, side="right"))
        out[s] = lo
    return out


def _sampled(step: int):
    schema = pa.schema([("lang", pa.string()), ("path", pa.list_(pa.binary()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = int(np.random.default_rng(TaskContext.get().partitionId()).integers(step))
        for langs, words in _shards(batches, 1 << 20):
            piece, data = _pieces(words), words.data
            names, paths = [], []
            text_of = words.text_of()
            while at < len(words.start):
                ends = range(at, min(at + DEPTH, len(words.start)))
                path = [data[words.start[i] : words.end[i]].tobytes() if piece[i] == piece[at] else b"" for i in ends]
                names.append(langs[text_of[at]])
                paths.append(path + [b""] * (DEPTH - len(path)))
                at += step
            at -= len(words.start)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(paths, pa.list_(pa.binary()))], schema=schema)

    return run


def _counted(splitters: list[tuple[str, Path]]):
    langs_cut = [lang for lang, _ in splitters]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, words in _shards(batches, SHARD_BYTES):
            if not len(words.start):
                continue
            different, ids = _ordered(packed(words))
            piece = _pieces(words)
            for lang, a, b in _by_language(langs, words):
                columns, counts = _trie(ids[a:b], piece[a:b])
                own = bisect_left(langs_cut, lang)  # ranges before this language's first splitter
                mine = [path for name, path in splitters[own : own + langs_cut.count(lang)]]
                cuts = [0, *_cuts(columns, different, mine).tolist(), len(counts)]
                rows = []
                for k, (x, y) in enumerate(zip(cuts, cuts[1:])):
                    if y > x:
                        rows.append((own + k, lang, y - x, *_coded([c[x:y] for c in columns], counts[x:y], different)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _RUNS.types)], schema=_RUNS)

    return run


def _merged(least: int):
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("depth", pa.int32()), ("f", pa.int64())])

    def merge(lang: str, table: pa.Table) -> pa.RecordBatch:
        lists = [_whole(x).split(b"\n") for x in table["words"].to_pylist()]
        words, ids = _ordered(pa.array([w for x in lists for w in x], pa.large_binary()))
        at, parts = 0, []
        for x, n, coded in zip(lists, table["n"].to_pylist(), table["paths"].to_pylist()):
            columns, counts = _decoded(n, len(x), coded)
            number = np.concatenate([[0], ids[at : at + len(x)]]).astype(np.int32)
            parts.append(([number[c] for c in columns], counts))
            at += len(x)
        columns, counts = _summed([np.concatenate([p[0][k] for p in parts]) for k in range(DEPTH)], np.concatenate([p[1] for p in parts]))
        phrases, depths, sums = [""], [0], [int(counts.sum())]
        new = np.zeros(len(counts), bool)
        new[0] = True
        for d in range(DEPTH):
            new[1:] |= columns[d][1:] != columns[d][:-1]
            starts = np.flatnonzero(new)
            total = np.add.reduceat(counts, starts)
            keep = total >= least
            keep[[0, -1]] = True
            keep &= columns[d][starts] > 0
            chosen = starts[keep]
            phrases += [b" ".join(words[columns[e][s] - 1] for e in range(d + 1)).decode() for s in chosen.tolist()]
            depths += [d + 1] * len(chosen)
            sums += total[keep].tolist()
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(sums), pa.string()), pa.array(phrases, pa.string()), pa.array(depths, pa.int32()), pa.array(sums, pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, "range"):
            for lang in pc.unique(group["lang"]).to_pylist():
                yield merge(lang, group.filter(pc.equal(group["lang"], lang)))

    return run


def phrase_counts(docs: DataFrame, least: int = 30) -> DataFrame:
    """(lang, phrase, depth, f): how often each phrase of one to four words occurs, from ``least`` on; and for each language
    a row of depth 0 with the number of all its words.

    Texts are lower-cased (A-Z) and cut at ``.,;:!?``, line feeds and the like into pieces; words are runs of no space or
    tab, joined by one space in a phrase. Null and empty texts have no words; a null language is ``und``. Repeated rows
    count again. Other columns are left alone.
    """
    spark = docs.sparkSession
    rows = docs.select("text", F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang")).where("text != ''")
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    ranges = max(shuffle_partitions(spark), min(size // RANGE_BYTES, MOST_RANGES))
    step = max(1, size // 6 // (SAMPLES * ranges))
    sample = sorted({(r["lang"], tuple(map(bytes, r["path"]))) for r in rows.mapInArrow(_sampled(step), "lang string, path array<binary>").collect()})
    splitters = sample[SAMPLES // 2 :: SAMPLES]
    runs = rows.mapInArrow(_counted(splitters), "range int, lang string, n long, words binary, paths binary")
    found = gathered(runs, "range").mapInArrow(_merged(least), "lang string, phrase string, depth int, f long")
    return found.groupBy("lang", "phrase").agg(F.max("depth").alias("depth"), F.sum("f").alias("f")).where((F.col("f") >= least) | (F.col("depth") == 0))


def collocations(docs: DataFrame, least: int = 30, most: int = 2000, scale: int = 2_000_000, share: int = 80) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``most`` best phrases of two to four words.

    a: occurrences of the phrase; l and r: of its parts left and right of a cut; n: of all words of the language. score:
    floor(scale * a / (l + r)) at the cut where that is lowest, the first one of equal cuts. A phrase is left out if a
    longer one that holds it has ``share`` per cent of its occurrences or more. Ranks go by score, then a, both
    descending, then phrase by UTF-8 bytes. Products are decimals, so they may pass 64 bits. Texts and languages are
    treated as by ``phrase_counts``; an empty table gives an empty result.
    """
    counts = written(phrase_counts(docs, least), "phrases")
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    phrases = counts.where("depth > 1").select("lang", "phrase", "depth", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    join = lambda start, n: F.array_join(F.slice("w", start, n), " ")
    cuts = phrases.select("*", F.explode(F.sequence(F.lit(1), F.col("depth") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", join(F.lit(1), F.col("k")).alias("left"), join(F.col("k") + 1, F.col("depth") - F.col("k")).alias("right"))
    nodes = lambda part, name: counts.where("depth > 0").select("lang", F.col("phrase").alias(part), F.col("f").alias(name))
    cuts = cuts.join(nodes("left", "l"), ["lang", "left"]).join(nodes("right", "r"), ["lang", "right"])
    cuts = cuts.withColumns({"top": (wide("a") * F.lit(scale).cast("decimal(10,0)")).cast("decimal(32,0)"), "sum": (wide("l") + wide("r")).cast("decimal(21,0)")})
    scored = cuts.select("lang", "phrase", "a", F.struct(F.expr("top div sum").alias("score"), "k", "l", "r").alias("cut"))
    scored = scored.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min("cut").alias("cut"))
    # the phrases inside each longer one
    inner = phrases.where("depth > 2").select("lang", "a", "depth", "w", F.explode(F.sequence(F.lit(2), F.col("depth") - 1)).alias("size"))
    inner = inner.select("lang", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("depth") - F.col("size") + 1)).alias("at"))
    inner = inner.select("lang", join(F.col("at"), F.col("size")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    held = scored.join(inner, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * wide("longer") < share * wide("a")))
    # the best of each part first, so that the last step has PARTS * most rows of a language whatever the input
    best_first = [F.desc("cut.score"), F.desc("a"), F.col("phrase")]
    parts = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*best_first)
    few = held.withColumn("rank", F.row_number().over(parts)).where(F.col("rank") <= most)
    best = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best_first))).where(F.col("rank") <= most)
    all_words = counts.where("depth = 0").select("lang", F.col("f").alias("n"))
    return best.join(all_words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def op11_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS x FROM documents),
w AS (SELECT lang, regexp_extract_all(x, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, d, unnest(list_transform(range(1, len(w) - d + 2), lambda i: array_to_string(w[i:i + d - 1], ' '))) AS s FROM w, (SELECT unnest([1, 2, 3, 4]) AS d)),
f AS (SELECT lang, s, d, count(*) AS f FROM g GROUP BY lang, s, d),
t AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE d = 1 GROUP BY lang),
c AS (SELECT lang, s, d, f AS a, string_split(s, ' ') AS w FROM f WHERE d > 1 AND f >= 30),
k AS (SELECT *, unnest(range(1, d)) AS k FROM c),
m AS (SELECT k.lang, k.s, k.a, k.k, l.f AS l, r.f AS r, (2000000::HUGEINT * k.a) // (l.f + r.f) AS score FROM k
  JOIN f l ON l.lang = k.lang AND l.s = array_to_string(k.w[1:k.k], ' ') JOIN f r ON r.lang = k.lang AND r.s = array_to_string(k.w[k.k + 1:], ' ')),
b AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY lang, s ORDER BY score, k) = 1),
i AS (SELECT lang, a, w, d, unnest(range(2, d)) AS z FROM c), j AS (SELECT lang, a, w, z, unnest(range(1, d - z + 2)) AS o FROM i),
q AS (SELECT lang, array_to_string(w[o:o + z - 1], ' ') AS s, max(a) AS longer FROM j GROUP BY ALL),
o AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.s) AS rank FROM b LEFT JOIN q ON q.lang = b.lang AND q.s = b.s WHERE longer IS NULL OR 100 * longer::HUGEINT < 80 * a::HUGEINT)
SELECT lang, rank, s AS phrase, a, l, r, n, score::BIGINT AS score FROM o JOIN t USING (lang) WHERE rank <= 2000"""
