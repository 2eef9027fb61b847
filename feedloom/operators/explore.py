"""Exploratory summaries.

Values stay unrounded in tables; ``round_summary`` rounds a collected one-row
summary the way the report shows it (Python ``round``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom import messages
from feedloom.functions.time import utc_date
from feedloom.operators.scalars import combine_one_row
from feedloom.session import checkpoint_dir

DEFAULT_TITLE = messages.DEFAULT_TITLE


def _valid_rating(col: F.Column) -> F.Column:
    return col.isNotNull() & ~F.isnan(col)


def dataset_summary(interactions: DataFrame, items: DataFrame, positive_threshold: float = 4.0) -> DataFrame:
    """A10: ten scalars; distinct users and items are separate narrow branches.

    Ratios use ``try_divide`` so an empty table yields nulls instead of failing.
    """
    rating = F.col("rating")
    t = F.lit(positive_threshold).cast(interactions.schema["rating"].dataType)
    base = interactions.agg(
        F.count(F.lit(1)).alias("interactions"),
        F.avg(F.when(_valid_rating(rating), rating)).alias("mean_rating"),
        F.count_if(F.coalesce((rating >= t) & ~F.isnan(rating), F.lit(False))).alias("_positives"),
    )
    # Distinct counts leave nulls out, as pandas ``nunique`` does.
    users = (interactions.select("user_id").where(F.col("user_id").isNotNull()).distinct()
             .agg(F.count(F.lit(1)).alias("users")))
    items_n = (interactions.select("item_id").where(F.col("item_id").isNotNull()).distinct()
               .agg(F.count(F.lit(1)).alias("items")))
    meta = items.agg(F.count(F.lit(1)).alias("metadata_items"))
    row = combine_one_row(base, users, items_n, meta)
    n = F.col("interactions").cast("double")
    cells = F.col("users").cast("double") * F.col("items").cast("double")
    density = F.try_divide(n, cells)
    return row.select(
        "interactions", "users", "items", "metadata_items",
        F.col("mean_rating").cast("double").alias("mean_rating"),
        F.try_divide(F.col("_positives").cast("double"), n).alias("positive_interaction_rate"),
        F.try_divide(n, F.col("users").cast("double")).alias("avg_interactions_per_user"),
        F.try_divide(n, F.col("items").cast("double")).alias("avg_interactions_per_item"),
        density.alias("matrix_density"),
        (F.lit(1.0) - density).alias("sparsity"),
    )


ROUNDING = {  # fixed report precision per summary field
    "mean_rating": 3, "positive_interaction_rate": 4,
    "avg_interactions_per_user": 3, "avg_interactions_per_item": 3,
}


def round_summary(row: dict) -> dict:
    """Round a collected one-row summary for presentation (Python ``round``)."""
    return {k: (round(v, ROUNDING[k]) if k in ROUNDING and v is not None else v) for k, v in row.items()}


def rating_counts(interactions: DataFrame) -> DataFrame:
    """Interactions per rating value, nulls/NaN dropped, by rating."""
    return (interactions.where(_valid_rating(F.col("rating")))
            .groupBy("rating").agg(F.count(F.lit(1)).alias("interactions"))
            .orderBy("rating"))


def user_activity(interactions: DataFrame) -> DataFrame:
    """Interactions per user."""
    return interactions.groupBy("user_id").agg(F.count(F.lit(1)).alias("interactions"))


def user_activity_histogram(interactions: DataFrame, clip: int = 10) -> DataFrame:
    """A14 + F9: users per activity level, levels above ``clip`` grouped at ``clip``."""
    level = F.least(F.col("interactions"), F.lit(clip)).alias("interactions_per_user")
    return (user_activity(interactions).groupBy(level)
            .agg(F.count(F.lit(1)).alias("users")).orderBy("interactions_per_user"))


def item_popularity(interactions: DataFrame) -> DataFrame:
    """Interactions per item."""
    return interactions.groupBy("item_id").agg(F.count(F.lit(1)).alias("interactions"))


def active_period(interactions: DataFrame) -> DataFrame:
    """First and last UTC date with an interaction."""
    agg = interactions.agg(F.min("event_time").alias("_lo"), F.max("event_time").alias("_hi"))
    return agg.select(utc_date(F.col("_lo")).alias("active_start"), utc_date(F.col("_hi")).alias("active_end"))


def top_items(interactions: DataFrame, items: DataFrame, k: int = 5) -> DataFrame:
    """O4 + J5 + F13: the k most-interacted items (ties by item id) with titles.

    The limit runs before any join (``TakeOrderedAndProject`` keeps k rows per
    task), and the k-row result is checkpointed once so the aggregation over
    all interactions runs a single time.  The k ids are broadcast (size
    bounded by ``k``) into a semi join that streams the item table once, so
    items are never shuffled or broadcast however large they grow; the final
    left join is k x k rows.
    """
    checkpoint_dir(interactions.sparkSession)
    top = (item_popularity(interactions).orderBy(F.desc("interactions"), F.asc("item_id")).limit(k)
           .checkpoint(eager=True))
    titles = items.select("item_id", "title").join(F.broadcast(top.select("item_id")), "item_id", "left_semi")
    joined = top.join(titles, on="item_id", how="left")
    return joined.select(
        "item_id",
        F.coalesce(F.nullif(F.col("title"), F.lit("")), F.lit(DEFAULT_TITLE)).alias("title"),
        "interactions",
    ).orderBy(F.desc("interactions"), F.asc("item_id"))
