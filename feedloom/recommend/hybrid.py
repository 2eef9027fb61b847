"""Hybrid lists (D7): candidate lists of several recommenders made into one.

``scores``: a list's scores are brought to 0..1 within a user (the best 1, the worst 0; 1 where all are equal), and
an item gets the weighted sum over the lists that hold it.  ``ranks``: an item gets weight / (RANK_OFFSET + rank) from each.
Lists may have any lengths, and a user may be missing from any of them.  Sums are in
whole units, so that their order does not matter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.recommend.pairs import UNIT

RANK_OFFSET = 60


def stacked(lists: dict[str, DataFrame]) -> DataFrame:
    """(source, user_id, item_id, rank, score) of all lists; an item that one list holds twice counts with its best rank."""
    parts = [df.groupBy("user_id", "item_id").agg(F.min("rank").alias("rank"), F.max(F.col("score").cast("double")).alias("score"))
             .select(F.lit(name).alias("source"), "user_id", "item_id", "rank", "score") for name, df in lists.items()]
    return reduce(DataFrame.unionByName, parts)


def fuse(lists: dict[str, DataFrame], weights: dict[str, float], k: int = 10, method: str = "scores") -> DataFrame:
    """(user_id, item_id, rank, score, sources): the ``k`` items of every user with the largest fused score, ties by id.

    ``lists`` are (user_id, item_id, rank, score) by name, each of bounded length a user; ``weights`` are over 0."""
    if set(lists) != set(weights) or not lists or min(weights.values()) <= 0:
        raise ValueError("every list needs a weight over 0")
    if method not in ("scores", "ranks"):
        raise ValueError("method is scores or ranks")
    rows = stacked(lists)
    weight = reduce(lambda c, w: c.when(F.col("source") == w[0], F.lit(float(w[1]))), list(weights.items())[1:],
                    F.when(F.col("source") == next(iter(weights)), F.lit(float(next(iter(weights.values()))))))
    if method == "scores":
        own = Window.partitionBy("source", "user_id")  # one list of one user
        least, most = F.min("score").over(own), F.max("score").over(own)
        rows = rows.select("*", least.alias("least"), most.alias("most"))
        part = F.when(F.col("most") > F.col("least"), (F.col("score") - F.col("least")) / (F.col("most") - F.col("least"))).otherwise(1.0)
    else:
        part = F.lit(1.0) / (F.col("rank") + RANK_OFFSET)
    units = F.floor(part * weight * UNIT).cast("bigint")
    fused = rows.select("user_id", "item_id", "source", units.alias("units")).groupBy("user_id", "item_id").agg(
        F.sum("units").alias("units"), F.count(F.lit(1)).cast("int").alias("sources"))
    order = Window.partitionBy("user_id").orderBy(F.desc("units"), "item_id")
    best = fused.select("user_id", "item_id", F.row_number().over(order).alias("rank"), (F.col("units") / UNIT).alias("score"), "sources")
    return best.where(F.col("rank") <= k)
