"""Connected components of links between ids, by alternating large and small stars.

Every round is a few joins and partial aggregates over the links and ends in a
written table; nothing is collected but the number of links and a checksum.
The number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from feedloom.session import materialize


def _large_star(links: DataFrame) -> DataFrame:
    """Of each node, the greater neighbours are linked to its least neighbour or itself."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Of each node, it and its lesser neighbours are linked to the least of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def _written(links: DataFrame) -> tuple[DataFrame, tuple]:
    """``links`` as a written table, and its number of rows and checksum, taken while it is written."""
    seen = Observation()
    rows = links.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum"))
    table = materialize(rows, "links")
    return table, (seen.get["n"], seen.get["sum"])


def components(links: DataFrame) -> DataFrame:
    """``links`` (u, v) of a sortable id -> (node, component): the least id each linked node can reach."""
    high, low = F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")
    now, state = _written(links.where("u != v").select(high, low).distinct())
    before = None
    while state != before and state[0]:
        before = state
        now, state = _written(_small_star(_large_star(now)).distinct())
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
