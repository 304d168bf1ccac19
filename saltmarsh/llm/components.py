"""Connected components of a table of links, by alternating large-star and small-star rounds.

Each round is two aggregations and two equi-joins; the table of links never leaves the cluster and shrinks towards one
row for each node. The number of rounds is logarithmic in the longest chain. Each round's table is written to the shared
folder, which cuts lineage and survives lost executors. (Kiveris et al., Connected Components in MapReduce and Beyond.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import dropped, written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node of ``links`` (columns a, b); component is the smallest node reachable.

    Self links, repeated links and links with a null end are allowed and say nothing. A node without other links is not
    in the result.
    """
    one = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    table = written(one, "links")
    state = _state(table)
    while state[0]:
        both = table.union(table.select("v", "u"))
        # a node with very many links is mostly the least of them, and changes nothing; the join reads a table and not an
        # aggregate, so that Spark can split such a node's partition
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).where("m < u"), "least")
        large = both.where(F.col("v") > F.col("u")).join(least, "u", "left").select(F.col("v").alias("u"), F.coalesce("m", "u").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = written(small.union(smallest).distinct(), "links")
        now = _state(after)
        dropped(table, least)
        table = after
        if now == state:
            break
        state = now
    return table.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _state(links: DataFrame) -> tuple:
    """The links' number and an order-free checksum."""
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("v", "u"))).first())
