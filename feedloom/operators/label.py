"""Relevance labels."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom import messages
from feedloom.functions.time import utc_date
from feedloom.schemas import INTERACTION_REQUIRED, ORDINAL, missing_columns


@dataclass(frozen=True)
class LabelPolicy:
    """One threshold turns a rating into a binary label; checked before planning."""

    positive_rating_threshold: float = 4.0

    def __post_init__(self) -> None:
        t = self.positive_rating_threshold
        if math.isnan(t) or not 1.0 <= t <= 5.0:
            raise ValueError(messages.THRESHOLD_RANGE)


def positive_flag(df: DataFrame, threshold: float) -> F.Column:
    """``rating >= threshold`` compared in the rating's own type; null/NaN -> 0.

    A FLOAT rating is compared with a FLOAT threshold (4.1 >= 4.1 holds), and
    NaN is excluded explicitly because Spark orders NaN above every number.
    """
    rating = F.col("rating")
    t = F.lit(threshold).cast(df.schema["rating"].dataType)
    return F.coalesce((rating >= t) & ~F.isnan(rating), F.lit(False)).cast("tinyint")


def label_interactions(interactions: DataFrame, policy: LabelPolicy = LabelPolicy(),
                       sort: bool = True) -> DataFrame:
    missing = missing_columns(interactions.columns, INTERACTION_REQUIRED)
    if missing:
        raise ValueError(messages.LABEL_MISSING_COLUMNS.format(columns=", ".join(missing)))
    if sort:  # before the labels are added: they need not move
        interactions = interactions.orderBy("user_id", "timestamp_ms", *([ORDINAL] if ORDINAL in interactions.columns else []))
    return interactions.select(
        "*",
        positive_flag(interactions, policy.positive_rating_threshold).alias("is_positive"),
        utc_date(F.col("event_time")).alias("event_date"),
    )


def label_summary(labeled: DataFrame) -> DataFrame:
    """Totals and the positive share (0.0 for an empty table), unrounded."""
    agg = labeled.agg(
        F.count(F.lit(1)).alias("interactions"),
        F.coalesce(F.sum("is_positive"), F.lit(0)).cast("bigint").alias("positive_interactions"),
    )
    return agg.select(
        "interactions", "positive_interactions",
        (F.col("interactions") - F.col("positive_interactions")).alias("negative_or_neutral_interactions"),
        F.when(F.col("interactions") == 0, F.lit(0.0))
        .otherwise(F.col("positive_interactions") / F.col("interactions"))
        .alias("positive_interaction_rate"),
    )
