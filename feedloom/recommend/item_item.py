"""Item-item collaborative filtering (D5): cosine of the sets of users that like two items.

similarity(i, j) = common(i, j) / sqrt(n(i) * n(j)), for pairs with at least
``min_common`` common users and ``min_similarity``.  Counts are exact.

All pairs of a user's items would be quadratic in the longest history.  Users are
therefore light or heavy (more than ``heavy`` items).  Pairs under light users are
counted outright.  A pair that only heavy users share must have enough of them:
with h(i) heavy users, c common ones can reach the bounds only if
h(i) >= c >= max(min_common, min_similarity^2 * n(i)), for both items, so a heavy
user's items that fall short of it make no pairs.  What is left of a heavy
history meets in blocks, and heavy users are then counted for candidate pairs only.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.operators.index import fit_index
from feedloom.operators.label import LabelPolicy, positive_flag
from feedloom.recommend.pairs import BLOCK, PAIRS, pairs_sharing, recommend_by_neighbours, top_neighbours
from feedloom.session import materialize

HEAVY = 1000


def liked(train: DataFrame, policy: LabelPolicy = LabelPolicy()) -> DataFrame:
    """Distinct (user_id, item_id) with a positive event; null ids like nothing."""
    known = F.col("user_id").isNotNull() & F.col("item_id").isNotNull()
    return train.where(known & (positive_flag(train, policy.positive_rating_threshold) == 1)).select("user_id", "item_id").distinct()


def _counted(light: DataFrame, histories: DataFrame) -> DataFrame:
    """(i, j, common): all pairs under users with short histories, made from one list a user in tasks of about ``PAIRS`` pairs."""
    many = histories.agg(F.sum(F.col("h") * F.col("h") / 2)).first()[0] or 0
    lists = light.repartition(max(1, math.ceil(many / PAIRS)), "user_id").groupBy("user_id").agg(F.array_sort(F.collect_list("item")).alias("items"))
    first = lists.select("items", F.posexplode("items").alias("at", "i"))
    both = first.select("i", F.explode(F.slice("items", F.col("at") + 2, F.size("items"))).alias("j"))
    return both.groupBy("i", "j").agg(F.count(F.lit(1)).alias("common"))


def co_occurrence(likes: DataFrame, min_common: int = 2, min_similarity: float = 0.05, heavy: int = HEAVY, block: int = BLOCK) -> DataFrame:
    """(i, j, common, n_i, n_j), i < j: all pairs of items within both bounds."""
    if min_common < 1 or not 0 <= min_similarity <= 1:
        raise ValueError("min_common must be positive, min_similarity between 0 and 1")
    # items are counted by codes in the order of their ids; fewer users than min_common make no pair
    known = likes.where(F.col("item_id").isNotNull())
    sizes = known.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    sizes = materialize(sizes.where(F.col("n") >= min_common).withColumnRenamed("item_id", "value"), "sizes")
    sizes = materialize(sizes.join(fit_index(sizes, "value", ["value"]).withColumnRenamed("idx", "item"), "value"), "codes")
    likes = materialize(known.withColumnRenamed("item_id", "value").join(sizes, "value").select("user_id", "item"), "likes")
    held_by = materialize(likes.groupBy("user_id").agg(F.count(F.lit(1)).alias("h")), "histories")
    many = materialize(held_by.where(F.col("h") > heavy).select("user_id"), "heavy")
    any_heavy = not many.isEmpty()
    counted = _counted(likes.join(many, "user_id", "left_anti") if any_heavy else likes, held_by.where(F.col("h") <= heavy))
    held = materialize(likes.join(many, "user_id", "left_semi"), "heavy-likes")
    if any_heavy:
        own = held.groupBy("item").agg(F.count(F.lit(1)).alias("h"))
        least = F.greatest(F.lit(min_common), F.col("n") * (min_similarity**2 * (1 - 1e-12)))
        strong = own.join(sizes, "item").where(F.col("h") >= least).select("item")
        shared = pairs_sharing(held.join(strong, "item", "left_semi"), "user_id", "item", block).select("i", "j").distinct()
        pairs = counted.unionByName(shared.withColumn("common", F.lit(0).cast("bigint"))).groupBy("i", "j").agg(F.sum("common").alias("common"))
    else:
        pairs = counted.where(F.col("common") >= min_common)  # nobody is left to count
    for side in ("i", "j"):
        pairs = pairs.join(sizes.select(F.col("item").alias(side), F.col("n").alias(f"n_{side}"), F.col("value").alias(f"{side}_id")), side)
    bound = F.lit(min_similarity) * min_similarity * F.col("n_i") * F.col("n_j")
    # the smaller of two sets bounds what they share
    smaller = F.least("n_i", "n_j")
    pairs = materialize(pairs.where((smaller >= min_common) & (smaller * smaller >= bound * (1 - 1e-12))), "pairs")
    first = held.select(F.col("item").alias("i"), "user_id")
    second = held.select(F.col("item").alias("j"), "user_id")
    by_heavy = (pairs.select("i", "j").join(first, "i").join(second, ["j", "user_id"]).groupBy("i", "j").agg(F.count(F.lit(1)).alias("more")))
    whole = pairs.join(by_heavy, ["i", "j"], "left").select(F.col("i_id").alias("i"), F.col("j_id").alias("j"),
                                                            (F.col("common") + F.coalesce("more", F.lit(0))).alias("common"), "n_i", "n_j")
    return whole.where((F.col("common") >= min_common) & (F.col("common") * F.col("common") >= bound))


def item_neighbours(likes: DataFrame, neighbours: int = 20, min_common: int = 2, min_similarity: float = 0.05, heavy: int = HEAVY,
                    block: int = BLOCK) -> DataFrame:
    """(item_id, other_id, common, similarity, rank): the most similar others of every item, ties by id."""
    pairs = co_occurrence(likes, min_common, min_similarity, heavy, block)
    similarity = F.col("common") / F.sqrt((F.col("n_i") * F.col("n_j")).cast("double"))
    pairs = materialize(pairs.select("i", "j", "common", similarity.alias("similarity")), "similar")
    ways = [pairs.select(F.col(a).alias("item_id"), F.col(b).alias("other_id"), "common", "similarity") for a, b in (("i", "j"), ("j", "i"))]
    return top_neighbours(ways[0].unionByName(ways[1]), neighbours)


def recommend_collaborative(train: DataFrame, users: DataFrame, k: int = 10, neighbours: int = 20, min_common: int = 2,
                            min_similarity: float = 0.05, policy: LabelPolicy = LabelPolicy()) -> DataFrame:
    """(user_id, item_id, rank, score) by the neighbours of what a user likes; users who like nothing, or only
    items without neighbours, get no rows (a fallback serves them)."""
    likes = materialize(liked(train, policy), "liked")
    near = materialize(item_neighbours(likes, neighbours, min_common, min_similarity), "neighbours")
    return recommend_by_neighbours(likes, near, train, users, k)
