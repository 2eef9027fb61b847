"""Cold start (D9): segments by the training indices, fallback lists, and metrics a segment.

A user or item that the training split does not know has index -1.  Users are ``cold`` (index -1), ``sparse``
(fewer than ``enough`` distinct items in training) or ``active``; items are ``cold`` or ``known``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.operators.index import UNKNOWN_INDEX, apply_index
from feedloom.recommend.ranking import mean_metrics, user_metrics

COLD, SPARSE, ACTIVE, KNOWN = "cold", "sparse", "active", "known"


def user_segments(users: DataFrame, mapping: DataFrame, train: DataFrame, enough: int = 5) -> DataFrame:
    """(user_id, segment) of the distinct non-null users, by the training index ``mapping`` and their history."""
    who = users.select("user_id").where(F.col("user_id").isNotNull()).distinct()
    history = train.select("user_id", "item_id").distinct().groupBy("user_id").agg(F.count(F.lit(1)).alias("_items"))
    marked = apply_index(who, mapping, "user_id", "_idx").join(history, "user_id", "left")
    segment = F.when(F.col("_idx") == UNKNOWN_INDEX, COLD).when(F.coalesce("_items", F.lit(0)) < enough, SPARSE).otherwise(ACTIVE)
    return marked.select("user_id", segment.alias("segment"))


def item_segments(items: DataFrame, mapping: DataFrame) -> DataFrame:
    """(item_id, segment) of the distinct non-null items."""
    what = items.select("item_id").where(F.col("item_id").isNotNull()).distinct()
    return apply_index(what, mapping, "item_id", "_idx").select(
        "item_id", F.when(F.col("_idx") == UNKNOWN_INDEX, COLD).otherwise(KNOWN).alias("segment"))


def fill_up(lists: list[DataFrame], k: int = 10) -> DataFrame:
    """(user_id, item_id, rank, source): every user's items of the first list, then those of the next that
    are not there yet, up to ``k``; ``source`` is the number of the list (from 0).

    The last list should hold every user with k items: then every user is served."""
    rows = None
    for n, df in enumerate(lists):
        part = df.select("user_id", "item_id", F.struct(F.lit(n).alias("source"), F.col("rank").cast("int").alias("rank")).alias("place"))
        rows = part if rows is None else rows.unionByName(part)
    first = rows.groupBy("user_id", "item_id").agg(F.min("place").alias("place"))
    rank = F.row_number().over(Window.partitionBy("user_id").orderBy("place", "item_id"))
    return first.select("user_id", "item_id", rank.alias("rank"), F.col("place.source").alias("source")).where(F.col("rank") <= k)


def metrics_by_user_segment(lists: DataFrame, relevant: DataFrame, segments: DataFrame, ks: tuple[int, ...] = (5, 10)) -> DataFrame:
    """Mean metrics per k and segment of the users judged; a user without a segment counts as cold."""
    judged = user_metrics(lists, relevant, ks).join(segments, "user_id", "left")
    return mean_metrics(judged.withColumn("segment", F.coalesce("segment", F.lit(COLD))), ["segment"])


def metrics_by_item_segment(lists: DataFrame, relevant: DataFrame, segments: DataFrame, ks: tuple[int, ...] = (5, 10)) -> DataFrame:
    """Mean metrics per k where only items of one segment count as relevant; users with none of them are not judged there."""
    marked = relevant.select("user_id", "item_id").distinct().join(segments, "item_id", "left")
    marked = marked.select("user_id", "item_id", F.coalesce("segment", F.lit(COLD)).alias("segment"))
    parts = [mean_metrics(user_metrics(lists, marked.where(F.col("segment") == s), ks).withColumn("segment", F.lit(s)), ["segment"])
             for s in (COLD, KNOWN)]
    return parts[0].unionByName(parts[1])
