"""Popularity recommender over unseen items (D3).

All users share one ranked list.  What a user gets is the first k places of it that
their own history leaves free, and these follow from the places that the
history takes: no user meets more of the list than that.  The list is looked at in
blocks of places.  Per user and block the taken places are counted (a partial
aggregate), so that even a user who has seen nearly everything comes down to at most
k blocks in which a free place is wanted, and only these are opened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.operators.explore import item_popularity
from feedloom.operators.index import fit_index
from feedloom.session import materialize

BLOCK = 4096                # places of the ranked list looked at together
HEAD = 1 << 16              # places that many users may reach: looked up by broadcast
BROADCAST_BYTES = 32 << 20  # of item ids, beyond which the head is joined like the rest


def rank_items(train: DataFrame) -> DataFrame:
    """(item_id, interactions, place): all items of ``train``, most interactions first, then by id, from place 0."""
    counts = materialize(item_popularity(train.where(F.col("item_id").isNotNull())), "popularity")
    places = fit_index(counts.withColumn("_less", -F.col("interactions")), "item_id", ["_less", "item_id"])
    return counts.join(places.select(F.col("value").alias("item_id"), F.col("idx").alias("place")), "item_id")


def _free_places(held: DataFrame, who: DataFrame, n: int, k: int, block: int) -> DataFrame:
    """(user_id, place): of every user, the first k places below ``n`` that ``held`` (user_id, place) does not take."""
    held = held.select("user_id", "place", F.floor(F.col("place") / block).cast("int").alias("block"))
    taken = held.groupBy("user_id", "block").agg(F.count(F.lit(1)).alias("rows"))
    order = Window.partitionBy("user_id").orderBy("block")
    taken = materialize(taken.select("*", F.coalesce(F.sum("rows").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
                                     (F.row_number().over(order) - 1).alias("at")), "taken")
    # blocks that the history touches, while fewer than k places before them are free
    partly = taken.where((F.col("block").cast("bigint") * block - F.col("before") < k)).select("user_id", "block")
    # and the first one that it does not touch, which has enough alone
    whole = taken.groupBy("user_id").agg(
        F.coalesce(F.min(F.when(F.col("block") > F.col("at"), F.col("at"))), F.count(F.lit(1))).cast("int").alias("block"),
        F.sum(F.when(F.col("block") == F.col("at"), F.col("rows"))).alias("rows"))
    first = who.join(whole, "user_id", "left").select("user_id", F.coalesce("block", F.lit(0)).alias("block"), F.coalesce("rows", F.lit(0)).alias("rows"))
    first = first.where((F.col("block").cast("bigint") * block - F.col("rows") < k) & (F.col("block").cast("bigint") * block < n))
    opened = held.join(partly, ["user_id", "block"], "left_semi").groupBy("user_id", "block").agg(F.collect_set("place").alias("places"))
    nothing = F.array().cast("array<int>")
    opened = opened.unionByName(first.select("user_id", "block", nothing.alias("places")))
    low = F.col("block") * F.lit(block)
    # the first k free places of a block lie within its first k + taken ones
    span = F.sequence(low, F.least(low + F.lit(block - 1), F.lit(n - 1), low + F.size("places") + F.lit(k - 1)))
    free = opened.select("user_id", F.explode(F.slice(F.array_except(span, F.col("places")), 1, k)).alias("place"))
    rank = F.row_number().over(Window.partitionBy("user_id").orderBy("place"))
    return free.select("user_id", "place", rank.alias("rank")).where(F.col("rank") <= k)


def recommend_popular(train: DataFrame, users: DataFrame, k: int = 10, block: int = BLOCK, head: int = HEAD) -> DataFrame:
    """D3: (user_id, item_id, rank, score): for every user of ``users``, the k items with most interactions in
    ``train`` among those the user has none with; ties by item id; ranks from 1; score is the number of interactions.

    Users without history get the head of the list; users who have seen all but a few items get these
    few.  Null users are left out, repeated ones are one; no items, no rows."""
    if k < 1:
        raise ValueError("k must be at least 1")
    block = max(block, k)
    ranked = materialize(rank_items(train), "ranked")
    n = ranked.count()
    who = materialize(users.select("user_id").where(F.col("user_id").isNotNull()).distinct(), "users")
    own = train.select("user_id", "item_id").join(who, "user_id", "left_semi").distinct()
    held = materialize(own.join(ranked.select("item_id", "place"), "item_id").select("user_id", "place"), "held")
    wanted = materialize(_free_places(held, who, max(n, 1), k, block), "wanted") if n else None
    if wanted is None:
        return who.select("user_id", F.lit(None).cast("string").alias("item_id"), F.lit(1).alias("rank"), F.lit(0).cast("bigint").alias("score")).where("false")
    top = ranked.where(F.col("place") < head)
    small = (top.agg(F.sum(F.octet_length("item_id") + F.lit(32))).first()[0] or 0) <= BROADCAST_BYTES
    # every user reaches the first places: they are broadcast (size checked) or, at worst, split by adaptive execution
    near = wanted.where(F.col("place") < head).join(F.broadcast(top) if small else top.hint("merge"), "place")
    far = wanted.where(F.col("place") >= head).join(ranked.where(F.col("place") >= head).hint("merge"), "place")
    return near.unionByName(far).select("user_id", "item_id", "rank", F.col("interactions").alias("score"))
