"""Near-duplicate documents: HyperMinHash sketches propose, full shingle sets confirm.

1. Each text becomes a set of hashed n-word shingles. Equal sets are one *class* from here on, so a text copied into a
   third of all rows costs as much as any other.
2. A class has a HyperMinHash sketch: hashes fall into 128 buckets; a bucket's smallest hash is kept as its leading-zero
   count and ten mantissa bits. 25 bands of 5 registers each give a band key; classes that share a key are candidates.
   A small set leaves buckets empty; for the bands, an empty register takes the value of the first filled one in a fixed
   random order of its own, so that two sets agree in a register about as often as their Jaccard similarity says. A pair
   at similarity 0.85 shares no key with probability below 5e-7.
3. Each key links its classes to its smallest one, which is a row for each class and key and never a pair for each two
   classes. The components of these links are *families*: all true links lie inside a family.
4. A family's texts are brought together and compared inside a task. A large family is cut into blocks of bounded size.
   First each block meets the family's first block only, which joins a group of near copies into one component, or a few.
   Texts outside their family's largest component then meet all of its blocks; texts of one component need not meet. So
   a group of m near copies takes about m / 500 tasks, and only a family that falls apart takes more. In one that has very
   many blocks, such texts meet only those with which they share a band, so it isn't quadratic in the family either.
   Inside a task, the sketches' collision-corrected Jaccard estimate rules out pairs that are five standard errors below
   the threshold; pairs that links found so far join already need no more work; all others are counted exactly on the
   full sets. A task returns at most one link for each text it has.
5. The components of the confirmed links are the result.

Joins on keys that many rows may share (a set's key, a band, a family) read tables and not aggregates, so that Spark can
split the partitions of hot keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .components import components
from .groups import gathered, groups
from .shared import dropped, flags_of, written

REGISTERS, MANTISSA_BITS, BANDS, ROWS = 128, 10, 25, 5
EMPTY = np.uint16(0xFFFF)
#: Most texts, and shingles, of one block of a family.
BLOCK_TEXTS, BLOCK_SHINGLES = 500, 1_000_000
#: Blocks of a family beyond which its open texts meet by bands: a text has as many bands, and so many copies at least.
MOST_BLOCKS = 2 * BANDS
#: Flags for the members of families, 16 for each up to so many.
MOST_FLAGS = 1 << 26


def shingle_sets(words: tokens.Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, first): text i's sorted distinct shingle hashes are values[first[i]:first[i+1]].

    A text with fewer than n words, but any, has its whole sequence as its one shingle.
    """
    hashes = words.hashes()
    at, value = words.windows(hashes, n)
    counts = words.counts
    bounds = np.searchsorted(at, words.first)
    sets = []
    for i, count in enumerate(counts):
        if count >= n:
            sets.append(np.unique(value[bounds[i] : bounds[i + 1]]))
        elif count:
            own = hashes[words.first[i] : words.first[i + 1]]
            up, _ = tokens.powers(len(own))
            sets.append(tokens.mixed(np.array([np.sum(own * up)], np.uint64) ^ np.uint64(count)))
        else:
            sets.append(np.zeros(0, np.uint64))
    first = np.zeros(len(sets) + 1, np.int64)
    np.cumsum([len(s) for s in sets], out=first[1:])
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), first


def set_keys(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Two 64-bit sums that name a set."""
    out = np.zeros((len(first) - 1, 2), np.uint64)
    for k, salt in enumerate((0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179)):
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(tokens.mixed(values ^ np.uint64(salt)), out=sums[1:])
        out[:, k] = tokens.mixed(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(np.uint64))
    return out


def sketches(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A row of 128 registers for each set."""
    n = len(first) - 1
    rest = np.full(n * REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    owner = np.repeat(np.arange(n, dtype=np.int64), np.diff(first))
    np.minimum.at(rest, owner * REGISTERS + (values & np.uint64(REGISTERS - 1)).astype(np.int64), values >> np.uint64(7))
    fraction, exponent = np.frexp(rest.astype(np.float64))
    mantissa = np.clip((2 * fraction - 1) * (1 << MANTISSA_BITS), 0, (1 << MANTISSA_BITS) - 1).astype(np.uint16)
    register = (exponent.astype(np.uint16) << np.uint16(MANTISSA_BITS)) | mantissa
    register[rest == np.iinfo(np.uint64).max] = EMPTY
    return register.reshape(n, REGISTERS)


_ORDERS = np.stack([np.random.default_rng(k).permutation(REGISTERS) for k in range(REGISTERS)])


def filled(sketch: np.ndarray) -> np.ndarray:
    """Sketches whose empty registers have taken the value of another one (optimal densification)."""
    out = sketch.copy()
    row, register = np.nonzero((sketch == EMPTY) & (sketch != EMPTY).any(axis=1)[:, None])
    for t in range(REGISTERS):
        if not len(row):
            break
        value = sketch[row, _ORDERS[register, t]]
        out[row, register] = value
        left = value == EMPTY
        row, register = row[left], register[left]
    return out


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """A key for each set and band."""
    parts = filled(sketch)[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2])
    for r in range(ROWS):
        key = tokens.mixed(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return key


def estimated(one: np.ndarray, many: np.ndarray, n_one: int, n_many: np.ndarray) -> np.ndarray:
    """Jaccard estimates, less the registers expected to agree by chance.

    Two different minima fall on one register value with probability near 0.18 * 2**-bits * 4ab/(a+b)**2: the chance
    that two exponential variables of rates a and b lie in one bin, bins being as wide as 2**-bits of their position.
    """
    agree = ((many == one) & (many != EMPTY)).sum(axis=1)
    either = ((many != EMPTY) | (one != EMPTY)).sum(axis=1)
    a, b = float(n_one), n_many.astype(np.float64)
    chance = 0.18 / (1 << MANTISSA_BITS) * 4 * a * b / (a + b) ** 2
    expected = chance * (either - agree)
    return (agree - expected) / np.maximum(either - expected, 1)


def _profile(n: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = tokens.column_of(batch, "doc_id")
            for i, j, words in tokens.sliced(tokens.column_of(batch, "text"), tokens.WHITESPACE, lower=True):
                values, first = shingle_sets(words, n)
                size = np.diff(first)
                keys = set_keys(values, first).view(np.int64)
                none = size == 0
                band = band_keys(sketches(values, first))[~none]
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.where(none, 0, BANDS))]).astype(np.int32)), pa.array(band.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array(size), pa.array(keys[:, 0], mask=none), pa.array(keys[:, 1], mask=none), lists], schema=schema)

    return run


class _Forest:
    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def roots(self) -> np.ndarray:
        p = self.parent
        while (q := p[p]).tobytes() != p.tobytes():
            p = q
        self.parent = p
        return p


def _links_in_tile(node: np.ndarray, side: np.ndarray, joined: np.ndarray, values: np.ndarray, first: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links in a tile. Texts of two sides are compared across the sides only; texts with equal
    ``joined`` not at all.
    """
    n = len(node)
    size = np.diff(first)
    sketch = sketches(values, first)
    ids = np.unique(values, return_inverse=True)[1]
    mark = np.zeros(int(ids.max(initial=0)) + 1, bool)
    margin = percent / 100 - 5 * np.sqrt(percent / 100 * (1 - percent / 100) / REGISTERS)
    forest, out = _Forest(n), []
    _, lead, code = np.unique(joined, return_index=True, return_inverse=True)
    forest.parent = lead[code]
    across = len(np.unique(side)) > 1
    for u in range(n):
        later = np.arange(u + 1, n)
        if across:
            later = later[side[later] != side[u]]
        small, big = np.minimum(size[later], size[u]), np.maximum(size[later], size[u])
        later = later[100 * small >= percent * big]
        if not len(later):
            continue
        # sets of few shingles leave most registers empty; the estimate then has few registers to go by
        slack = margin * np.minimum(1, np.minimum(size[later], size[u]) / REGISTERS)
        later = later[estimated(sketch[u], sketch[later], size[u], size[later]) >= slack]
        later = later[forest.roots()[later] != forest.root(u)]
        if not len(later):
            continue
        mark[ids[first[u] : first[u + 1]]] = True
        lengths = size[later]
        starts = np.cumsum(lengths) - lengths
        where = np.repeat(first[later] - starts, lengths) + np.arange(lengths.sum())
        common = np.add.reduceat(mark[ids[where]].astype(np.int64), starts)
        mark[ids[first[u] : first[u + 1]]] = False
        for v in later[100 * common >= percent * (size[u] + lengths - common)]:
            if (a := forest.root(u)) != (b := forest.root(int(v))):
                forest.parent[max(a, b)] = min(a, b)
                out.append((int(node[u]), int(node[v])))
    return out


def _compare(n: int, percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links_of(tile: pa.Table) -> pa.RecordBatch:
        node, side, joined = (tile[c].to_numpy() for c in ("node", "side", "joined"))
        wanted = np.stack([tile["k1"].to_numpy(), tile["k2"].to_numpy()], axis=1)
        sets, kept = [], []
        for i, j, words in tokens.sliced(tile["text"].combine_chunks(), tokens.WHITESPACE, lower=True):
            values, first = shingle_sets(words, n)
            same = (set_keys(values, first).view(np.int64) == wanted[i:j]).all(axis=1)  # rows that share an id with another text
            for k in np.flatnonzero(same):
                sets.append(values[first[k] : first[k + 1]])
                kept.append(i + k)
        kept = np.array(kept, np.int64)
        _, once = np.unique(np.stack([node[kept], side[kept]]), axis=1, return_index=True)
        once = once[np.argsort(side[kept[once]], kind="stable")]
        sets = [sets[k] for k in once]
        kept = kept[once]
        if len(kept) < 2:
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 2, schema=schema)
        first = np.zeros(len(sets) + 1, np.int64)
        np.cumsum([len(s) for s in sets], out=first[1:])
        found = _links_in_tile(node[kept], side[kept], joined[kept], np.concatenate(sets), first, percent)
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in groups(batches, "family", "ti", "tj"):
            yield links_of(tile)

    return run


def _tiles(rows: DataFrame, others: Column, blocks: Column) -> DataFrame:
    """A copy of each text for each tile: texts outside their group's largest component, dealt to ``others`` parts (side 1), meet
    all of its ``blocks`` (side 0). rows: node, k1, k2, family, joined, block, largest.
    """
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    keep = ("node", "k1", "k2", "family", "joined")
    outside = rows.where(F.col("joined") != F.col("largest"))
    other = outside.select(*keep, F.pmod(F.xxhash64(F.lit(1), "node"), others).cast("int").alias("ti"), F.lit(1).alias("side"), every(blocks).alias("tj"))
    each = rows.select(*keep, every(others).alias("ti"), F.lit(0).alias("side"), F.col("block").alias("tj"))
    return other.unionByName(each.select(other.columns))


def _by_band(many: DataFrame, profiles: DataFrame) -> DataFrame:
    """Tiles of families with very many blocks: only texts with a band in common meet, as any two that are linked have one."""
    own = profiles.select(F.col("doc_id").alias("node"), "k1", "k2", "bands").dropDuplicates(["node", "k1", "k2"])
    rows = many.select("node", "k1", "k2", "n", "family", "joined").join(own, ["node", "k1", "k2"]).withColumn("band", F.explode("bands")).drop("bands")
    rows = written(rows.withColumn("family", F.xxhash64("family", "band")).drop("band"), "banded")
    parts = F.ceil(F.greatest(F.sum("m") / BLOCK_TEXTS, F.sum("n") / BLOCK_SHINGLES)).cast("int")
    sizes = rows.groupBy("family", "joined").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("n"))
    groups_ = sizes.groupBy("family").agg(F.max(F.struct("m", "joined")).alias("x"), F.sum("m").alias("all"), parts.alias("blocks"))
    open_ = groups_.select("family", F.col("x.joined").alias("largest"), F.ceil((F.col("all") - F.col("x.m")) / BLOCK_TEXTS).cast("int").alias("others"), "blocks").where("others > 0")
    placed = rows.join(written(open_, "open"), "family").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    return _tiles(placed, F.col("others"), F.col("blocks"))


def _open_families(placed: DataFrame, profiles: DataFrame, linked: DataFrame, links: DataFrame, compared: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Components once the texts of large families that lie outside their family's largest component have met those that they may
    be linked with: all of the family's blocks, or, in a family of more than ``MOST_BLOCKS``, the texts that share a band.
    """
    several = placed.where("blocks > 1").join(linked, "node", "left").withColumn("joined", F.coalesce("component", "node")).drop("component")
    several = written(several, "several")
    sizes = several.groupBy("family", "joined").agg(F.count(F.lit(1)).alias("m"))
    largest = sizes.groupBy("family").agg(F.max(F.struct("m", "joined")).alias("x"), F.sum("m").alias("all"))
    largest = written(largest.select("family", F.col("x.joined").alias("largest"), (F.col("all") - F.col("x.m")).alias("rest")).where("rest > 0"), "largest")
    if not largest.isEmpty():
        open_ = several.join(largest, "family").withColumn("others", F.ceil(F.col("rest") / BLOCK_TEXTS).cast("int"))
        tiles = _tiles(open_.where(F.col("blocks") <= MOST_BLOCKS), F.col("others"), F.col("blocks"))
        many = open_.where(F.col("blocks") > MOST_BLOCKS)
        if not many.isEmpty():
            tiles = tiles.unionByName(_by_band(many, profiles))
        linked = written(components(links.union(compared(tiles))), "linked")
    dropped(several, largest)
    return linked


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs`` (doc_id, text; other columns are left alone).

    ``words``: words (runs of no ASCII white space, A-Z lower-cased) to a shingle. ``percent``: two documents are linked
    if 100 * common shingles >= percent * shingles of either. A component's id is its smallest doc_id; only that row is
    kept. Null and empty texts have no shingles and are linked with nothing. Repeated rows get equal results. A row
    without a doc_id is linked with nothing and kept.
    """
    profiles = written(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_profile(words), "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>"), "profiles")
    named = profiles.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = named.groupBy("k1", "k2").agg(F.min("doc_id").alias("node"), F.max("n_shingles").alias("n"), F.first("bands").alias("bands"))
    rows = classes.select("node", F.explode("bands").alias("band"))
    shared = written(rows.groupBy("band").agg(F.min("node").alias("lead"), F.count(F.lit(1)).alias("m")).where("m > 1").select("band", "lead"), "bands")
    families = components(rows.join(shared, "band").select(F.col("node").alias("a"), F.col("lead").alias("b")))
    families = families.union(families.select(F.col("component").alias("node"), "component").distinct())
    keys = named.groupBy("k1", "k2").agg(F.min("doc_id").alias("node"), F.max("n_shingles").alias("n"))
    members = written(keys.join(families.withColumnRenamed("component", "family"), "node"), "members")
    parts = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_TEXTS, F.sum("n") / BLOCK_SHINGLES)).cast("int")
    large = written(members.groupBy("family").agg(parts.alias("blocks")).where("blocks > 1"), "large")
    placed = members.join(large, "family", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # the families' texts, and few others, which meet no tile; texts outside families are not shuffled
    flags, in_family = flags_of(members.select(F.xxhash64("node").alias("k")), 16 * members.count(), MOST_FLAGS)
    ours = written(docs.select(F.col("doc_id").cast("long").alias("node"), "text").where(in_family(F.xxhash64("node"))), "texts")

    def compared(tiles: DataFrame) -> DataFrame:
        texts = ours.join(tiles.select("node", "k1", "k2", "family", "ti", "tj", "side", "joined"), "node")
        return written(gathered(texts, "family", "ti", "tj").mapInArrow(_compare(words, percent), "a long, b long"), "confirmed")

    # each block meets the first one of its family
    one = placed.withColumn("joined", F.col("node")).withColumn("ti", F.lit(0))
    met = one.withColumn("tj", F.explode(F.when(F.col("block") > 0, F.array("block")).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))))
    links = compared(met.withColumn("side", F.when(F.col("block") > 0, 1).otherwise(0)))
    linked = written(components(links), "linked")
    if not large.isEmpty():
        linked = _open_families(placed, profiles, linked, links, compared)
    named_component = written(keys.join(linked, "node", "left").select("k1", "k2", F.coalesce("component", "node").alias("component")), "components")
    dropped(members, large, ours, flags)
    out = profiles.drop("bands").join(named_component, ["k1", "k2"], "left").withColumn("component_id", F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def op4_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=3, percent=85)


#: For tables of test size: the join of equal shingles is quadratic in a family.
ORACLE_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
u AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM g),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n + b.n AS n, count(*) AS k FROM u a JOIN u b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c WHERE 100 * k >= 85 * (n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS root FROM g UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node),
m AS (SELECT node, min(root) AS root FROM r GROUP BY node)
SELECT doc_id, len(s)::BIGINT AS n_shingles, root AS component_id, doc_id = root AS kept FROM g JOIN m ON doc_id = node"""
