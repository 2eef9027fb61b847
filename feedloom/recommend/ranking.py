"""Ranking metrics at K (D8): Precision, Recall, MAP, NDCG and hit rate.

Per user with relevant items, with h(r) = 1 if the item at rank r is relevant:

* precision@K = hits / K, recall@K = hits / relevant;
* average precision@K = sum of (hits up to r) / r over hits, by min(relevant, K);
* NDCG@K = sum of 1 / log2(r + 1) over hits, by the same sum over ranks 1 to min(relevant, K);
* hit rate@K = 1 if there is a hit.

Means are over all users with relevant items; one who got no list, or no hit, counts
as zero.  Lists of users without relevant items are not judged.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.operators.scalars import combine_one_row

METRICS = ["precision", "recall", "map", "ndcg", "hit_rate"]


def user_metrics(recommended: DataFrame, relevant: DataFrame, ks: tuple[int, ...] = (5, 10)) -> DataFrame:
    """(user_id, k, n_relevant, hits, precision, recall, map, ndcg, hit_rate) per user with relevant items.

    ``recommended`` has user_id, item_id, rank (from 1); an item listed twice counts at its first rank.
    At most max(ks) hits a user leave the join, whatever the length of a user's lists."""
    if not ks or min(ks) < 1:
        raise ValueError("ks must be positive")
    most = max(ks)
    truth = relevant.select("user_id", "item_id").where(F.col("user_id").isNotNull() & F.col("item_id").isNotNull()).distinct()
    listed = recommended.where(F.col("rank").between(1, most)).groupBy("user_id", "item_id").agg(F.min("rank").alias("rank"))
    hits = listed.join(truth, ["user_id", "item_id"])
    hits = hits.select("user_id", "rank", F.row_number().over(Window.partitionBy("user_id").orderBy("rank", "item_id")).alias("nth"))
    each_k = F.explode(F.array(*[F.lit(int(k)) for k in sorted(set(ks))])).alias("k")
    at = hits.select("user_id", "rank", "nth", each_k).where(F.col("rank") <= F.col("k"))
    sums = at.groupBy("user_id", "k").agg(F.count(F.lit(1)).alias("hits"), F.sum(F.col("nth") / F.col("rank")).alias("ap"),
                                          F.sum(1 / F.log2(F.col("rank") + 1)).alias("dcg"))
    users = truth.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_relevant")).select("user_id", "n_relevant", each_k)
    both = users.join(sums, ["user_id", "k"], "left").na.fill(0, ["hits", "ap", "dcg"])
    ideal = [0.0]
    for r in range(1, most + 1):
        ideal.append(ideal[-1] + 1 / math.log2(r + 1))
    possible = F.least(F.col("n_relevant"), F.col("k").cast("bigint")).cast("int")
    best = F.element_at(F.array(*[F.lit(x) for x in ideal[1:]]), possible)
    return both.select("user_id", "k", "n_relevant", "hits", (F.col("hits") / F.col("k")).alias("precision"),
                       (F.col("hits") / F.col("n_relevant")).alias("recall"), (F.col("ap") / possible).alias("map"),
                       (F.col("dcg") / best).alias("ndcg"), (F.col("hits") > 0).cast("double").alias("hit_rate"))


def ranking_metrics(recommended: DataFrame, relevant: DataFrame, ks: tuple[int, ...] = (5, 10)) -> DataFrame:
    """A row per k: users judged and the means of all metrics; no rows if nothing is relevant."""
    return mean_metrics(user_metrics(recommended, relevant, ks), [])


def mean_metrics(judged: DataFrame, by: list[str]) -> DataFrame:
    """Means of ``user_metrics`` per k and the columns ``by``."""
    return judged.groupBy(*by, "k").agg(F.count(F.lit(1)).alias("users"), *[F.avg(m).alias(m) for m in METRICS])


def catalogue_coverage(recommended: DataFrame, items: DataFrame) -> DataFrame:
    """One row: distinct items listed, items there are, and their ratio (null for none)."""
    listed = recommended.select("item_id").join(items.select("item_id"), "item_id", "left_semi").distinct().agg(F.count(F.lit(1)).alias("listed"))
    there = items.select("item_id").where(F.col("item_id").isNotNull()).distinct().agg(F.count(F.lit(1)).alias("items"))
    return combine_one_row(listed, there).select("listed", "items", F.try_divide(F.col("listed"), F.col("items")).alias("coverage"))
