"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree. DataFrame functions only.

1. Sizes are summed by source. Sources, by code point, null last, have the weights in turn; they share the total of all
   sizes by weight, but none gets more than ``cap`` times its size, and what is above is shared by weight among the rest
   until none is above.
2. A source's rows are hashed into blocks of about ``BLOCK_ROWS`` rows, so a source with a third of all rows just has
   more blocks. A target of 2.4 times the size draws every block twice, and 0.4 of the words from a third pass: blocks
   in a random order of their own until the quota is full; the last block is taken row by row, in a random order, and
   its last row in part. So a source's taken words are its target, rounded.
3. Each source has a whole number of drawn blocks. A binary tree over the output shards splits these quotas: at each
   node the left half's blocks are one multivariate-hypergeometric draw from the node's, which is how many of each source
   a uniformly shuffled deck of all blocks would hold there. At the leaves, each shard takes its number of blocks of each
   source from the source's permuted draws; ranges of ranks are disjoint, so no draw is used twice. Rows are then
   shuffled inside their shard by a random key.

The driver holds numbers for sources times shards only. Rows are shuffled once, by (source, block). Blocks and draws are
put in order in ranges of their hashes, so that a hot source's blocks are not all in one task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

BLOCK_ROWS = 500
#: Blocks, or draws, of a source that one task puts in order, on average.
CELL_BLOCKS = 20_000
#: Most sources whose tables (a row for each source) are broadcast; beyond it the joins with them shuffle.
BROADCAST_SOURCES = 10_000
#: The weights of the first, second, third, fourth ... source.
WEIGHTS = (5.0, 2.0, 1.0)


def targets(sizes: list[int], weights: list[float], total: float, cap: float) -> list[float]:
    """Shares of ``total`` by weight, none above ``cap`` times its size, the excess reshared by weight."""
    out = [0.0] * len(sizes)
    open_sources = set(range(len(sizes)))
    left = float(total)
    while open_sources:
        unit = left / sum(weights[i] for i in open_sources)
        above = [i for i in open_sources if weights[i] * unit > cap * sizes[i]]
        if not above:
            for i in open_sources:
                out[i] = weights[i] * unit
            break
        for i in above:
            out[i] = cap * sizes[i]
            left -= out[i]
            open_sources.discard(i)
    return out


def splitting_tree(quotas: list[int], shards: int, seed: int) -> list[list[int]]:
    """For each shard, how many of each source's blocks it takes. Columns sum to the quotas; shards differ by one block."""
    rng = np.random.default_rng(seed)
    total = sum(quotas)
    capacity = [(total * (k + 1)) // shards - (total * k) // shards for k in range(shards)]
    out: list[list[int]] = [[0] * len(quotas) for _ in range(shards)]
    open_nodes = [(0, shards, list(quotas))]
    while open_nodes:
        lo, hi, have = open_nodes.pop()
        if hi - lo == 1:
            out[lo] = have
            continue
        mid = (lo + hi) // 2
        want, rest, left = sum(capacity[lo:mid]), sum(have), []
        for q in have:
            taken = int(rng.hypergeometric(q, rest - q, want)) if q and want else 0
            left.append(taken)
            want -= taken
            rest -= q
        open_nodes += [(lo, mid, left), (mid, hi, [q - t for q, t in zip(have, left)])]
    return out


def _before(df: DataFrame, order: Column, value: Column, cells: int, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over the rows of its _source that come before it, by the hash ``order``.

    Rows lie in ``cells`` ranges of the hash; sums of ranges go first, so that no task has all of a hot source.
    """
    df = df.withColumns({"_order": F.shiftrightunsigned(order, 1), "_value": value.cast("long")})
    df = df.withColumn("_cell", F.least(F.lit(cells - 1), F.floor(F.col("_order") / float(1 << 63) * cells)).cast("int"))
    upto = lambda *keys: Window.partitionBy("_source", *keys[:-1]).orderBy(*keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
    ties = [c for c in ("_block", "_pass") if c in df.columns]
    inside = df.withColumn(name, F.coalesce(F.sum("_value").over(upto("_cell", ["_order", *ties])), F.lit(0)))
    if cells > 1:
        sums = df.groupBy("_source", "_cell").agg(F.sum("_value").alias("_sum"))
        starts = sums.select("_source", "_cell", F.coalesce(F.sum("_sum").over(upto(["_cell"])), F.lit(0)).alias("_start"))
        inside = inside.join(starts, ["_source", "_cell"]).withColumn(name, F.col(name) + F.col("_start")).drop("_start")
    return inside.drop("_order", "_value", "_cell")


def mix(docs: DataFrame, size: Column, source: str = "source", weights: tuple[float, ...] = WEIGHTS, cap: float = 3.0, n_shards: int = 64, seed: int = 7) -> DataFrame:
    """``docs`` with _size, _source_size, _target (double), _taken (long: words the mix takes of this row, repeats
    counted) and _draws: array of (shard int, words long, order long), one entry for each time the row is drawn.

    A source of no words has target 0; its rows, and rows of no words, may be drawn but add nothing. A null source is a
    source. Rows are dealt into blocks by the hash of all their columns, so rows without an id, or with one id, are spread;
    rows that are equal in every column share a block and are drawn each by itself. A null size counts as 0. The result
    depends on the table's content and the seed only. Other columns pass through; names with a leading ``_`` are this
    function's own. The number of sources must suit the driver, as the list of weights does.
    """
    spark = docs.sparkSession
    own = [f.name for f in docs.schema.fields if not f.name.startswith("_") and "map<" not in f.dataType.simpleString()]
    sized = docs.withColumns({"_source": F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("")), "_size": F.coalesce(size, F.lit(0)).cast("long"), "_key": F.xxhash64(F.lit(seed), *own)})
    # 's' + name sorts as the name does; a null source is '' here and comes last
    found = sorted(sized.groupBy("_source").agg(F.sum("_size").alias("words"), F.count(F.lit(1)).alias("rows")).collect(), key=lambda r: (r[0] == "", r[0].encode()))
    goal = targets([r["words"] for r in found], [weights[i % len(weights)] for i in range(len(found))], sum(r["words"] for r in found), cap)
    plan = []
    for r, t in zip(found, goal):
        passes = int(t // r["words"]) if r["words"] else 0
        plan.append((r["_source"], r["words"], t, passes, round(t) - passes * r["words"], max(1, -(-r["rows"] // BLOCK_ROWS))))
    cells = max([1, *(-(-p[5] // CELL_BLOCKS) for p in plan)])
    # broadcast, so that rows are not dealt by source, where a hot source would be one task
    small = F.broadcast if len(plan) <= BROADCAST_SOURCES else lambda df: df
    sources = small(spark.createDataFrame(plan, "_source string, _source_size long, _target double, _passes int, _part long, _blocks long"))
    dealt = sized.join(sources, "_source").withColumn("_block", F.pmod("_key", "_blocks"))
    blocks = written(dealt.groupBy("_source", "_block", "_passes", "_part").agg(F.sum("_size").alias("_words")), "blocks")
    ordered = _before(blocks, F.xxhash64(F.lit(seed), F.lit("part"), "_source", "_block"), F.col("_words"), cells, "_earlier")
    needed = ordered.withColumn("_need", F.greatest(F.least(F.col("_part") - F.col("_earlier"), F.col("_words")), F.lit(0)))
    drawn = F.col("_passes") + F.when(F.col("_need") > 0, 1).otherwise(0)
    quota = {r["_source"]: r["n"] for r in needed.groupBy("_source").agg(F.sum(drawn).alias("n")).collect()}
    names = [p[0] for p in plan]
    tree = splitting_tree([int(quota[n]) for n in names], n_shards, seed) if names else []
    ends = [(n, np.cumsum([shard[i] for shard in tree]).tolist()) for i, n in enumerate(names)]
    ranges = small(spark.createDataFrame(ends, "_source string, _ends array<long>"))
    draws = needed.where(drawn > 0).select("_source", "_block", "_need", F.col("_passes").alias("_whole"), F.explode(F.sequence(F.lit(1), drawn)).alias("_pass"))
    ranked = _before(draws, F.xxhash64(F.lit(seed), F.lit("draw"), "_source", "_block", "_pass"), F.lit(1), cells, "_rank").join(ranges, "_source")
    draws = ranked.withColumn("_shard", F.size(F.filter("_ends", lambda e: e <= F.col("_rank"))))
    draws = draws.groupBy("_source", "_block").agg(F.max("_need").alias("_need"), F.sort_array(F.collect_list(F.struct(F.col("_pass").alias("pass"), F.col("_shard").alias("shard"), (F.col("_pass") <= F.col("_whole")).alias("whole")))).alias("_all"))
    joined = dealt.join(draws, ["_source", "_block"], "left")
    inside = Window.partitionBy("_source", "_block").orderBy(F.xxhash64(F.lit(seed), F.lit("row"), "_key"), "_key", "_size").rowsBetween(Window.unboundedPreceding, -1)
    part = F.greatest(F.lit(0), F.least(F.col("_size"), F.col("_need") - F.coalesce(F.sum("_size").over(inside), F.lit(0))))
    joined = joined.withColumn("_rest", F.coalesce(part, F.lit(0)))
    taken = lambda d: F.when(d["whole"], F.col("_size")).otherwise(F.col("_rest"))
    held = F.filter(F.coalesce("_all", F.expr("cast(array() as array<struct<pass:int,shard:int,whole:boolean>>)")), lambda d: d["whole"] | (F.col("_rest") > 0))
    as_draw = lambda d: F.struct(d["shard"].alias("shard"), taken(d).alias("words"), F.xxhash64(F.lit(seed), F.lit("order"), "_key", d["pass"]).alias("order"))
    out = joined.withColumn("_draws", F.transform(held, as_draw))
    out = out.withColumn("_taken", F.aggregate("_draws", F.lit(0).cast("long"), lambda acc, d: acc + d["words"]))
    return out.drop("_source", "_key", "_blocks", "_block", "_passes", "_part", "_need", "_all", "_rest")


def laid_out(mixed: DataFrame) -> DataFrame:
    """The draws of ``mix``, a row for each, in the struct _draw instead of _draws: a shard's draws lie in one partition,
    in the order of the shuffle. A partition may hold several shards, one after another.
    """
    drawn = mixed.withColumn("_draw", F.explode("_draws")).drop("_draws")
    return drawn.repartition(F.col("_draw.shard")).sortWithinPartitions("_draw.shard", "_draw.order")


def word_count(text: str = "text") -> Column:
    """Runs of characters that are no ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def op1_mixing(spark, sf_dir: str) -> DataFrame:
    """The mix of all documents; ``shards`` and ``orders``: where each draw of a document goes, and its place there."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", word_count().alias("words"), F.xxhash64("text").alias("check"))
    mixed = mix(docs, F.col("words"))
    joined = lambda field: F.array_join(F.transform("_draws", lambda d: d[field].cast("string")), ",")
    return mixed.select(
        "doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), F.col("_taken").alias("taken"), joined("shard").alias("shards"), joined("order").alias("orders")
    )
