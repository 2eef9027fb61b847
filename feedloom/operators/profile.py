"""Source profiling (A1-A9, X1): record counts, distinct ids, exact duplicates,
missing-field counters, raw rating histogram, active range, join coverage.

Inputs are review / metadata record frames (see ``feedloom.schemas``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.predicates import falsy, missing_value
from feedloom.functions.time import iso_utc_from_ms
from feedloom.schemas import METADATA_CONTENT_FIELDS, REVIEW_REQUIRED_FIELDS


def _truthy_ids(df: DataFrame, name: str) -> DataFrame:
    col = F.col(name)
    return df.select(col.alias("id")).where(col.isNotNull() & (col != "")).distinct()


def profile_reviews(records: DataFrame) -> DataFrame:
    """A1: one row of review-source statistics, in one pass over the records.

    1. one row per (user, item, timestamp) key with its record count and
       integer-timestamp range (a partial aggregate, so a hot key or copy group
       is combined map-side; nulls group together, as Python tuples do);
    2. grouping sets over that reduced table: per user, per item, and the
       whole (``Expand`` multiplies only the reduced table, by three);
    3. one small aggregate: records, truthy distinct users and items,
       duplicates (= records - keys) and the ISO first/last timestamps.
    """
    per_key = records.groupBy("user_id", "parent_asin", "timestamp_key").agg(
        F.count(F.lit(1)).alias("_n"), F.min("timestamp_int").alias("_lo"), F.max("timestamp_int").alias("_hi"))
    sets = per_key.groupingSets([["user_id"], ["parent_asin"], []], "user_id", "parent_asin").agg(
        F.grouping_id().alias("_g"), F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_keys"),
        F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    # grouping_id: 1 = per user, 2 = per item, 3 = whole input.
    whole = F.col("_g") == 3
    truthy = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    row = sets.agg(
        F.max(F.when(whole, F.col("_n"))).alias("_records"),
        F.count_if((F.col("_g") == 1) & truthy("user_id")).alias("unique_users"),
        F.count_if((F.col("_g") == 2) & truthy("parent_asin")).alias("unique_reviewed_items"),
        F.max(F.when(whole, F.col("_n") - F.col("_keys"))).alias("_dups"),
        F.max(F.when(whole, F.col("_lo"))).alias("_lo"),
        F.max(F.when(whole, F.col("_hi"))).alias("_hi"))
    return row.select(
        F.coalesce("_records", F.lit(0)).cast("bigint").alias("records"),
        "unique_users", "unique_reviewed_items",
        F.coalesce("_dups", F.lit(0)).cast("bigint").alias("exact_duplicate_events"),
        iso_utc_from_ms(F.col("_lo")).alias("first_interaction_utc"),
        iso_utc_from_ms(F.col("_hi")).alias("last_interaction_utc"),
    )


def _missing_long(df: DataFrame, fields, predicate) -> DataFrame:
    """A5: per-field counters in long form, zero counters dropped, sorted by field."""
    counts = df.agg(*[F.count_if(predicate(df, f)).alias(f) for f in fields])
    pairs = ", ".join(f"'{f}', `{f}`" for f in fields)
    long = counts.selectExpr(f"stack({len(fields)}, {pairs}) as (field, missing)")
    return long.where(F.col("missing") > 0).orderBy("field")


def review_missing_fields(records: DataFrame) -> DataFrame:
    return _missing_long(records, REVIEW_REQUIRED_FIELDS, missing_value)


def raw_rating_histogram(records: DataFrame) -> DataFrame:
    """Counts keyed by the rating as written ('5.0' and '5' differ), text order."""
    return (records.where(F.col("rating_text").isNotNull())
            .groupBy(F.col("rating_text").alias("rating"))
            .agg(F.count(F.lit(1)).alias("records"))
            .orderBy("rating"))


def profile_metadata(metadata: DataFrame) -> DataFrame:
    """Metadata record count and distinct truthy item ids, in one scan."""
    per_id = metadata.groupBy("parent_asin").agg(F.count(F.lit(1)).alias("_n"))
    return per_id.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("records"),
        F.count_if(F.coalesce(F.col("parent_asin"), F.lit("")) != "").alias("unique_metadata_items"))


def metadata_missing_fields(metadata: DataFrame) -> DataFrame:
    return _missing_long(metadata, METADATA_CONTENT_FIELDS, falsy)


def join_coverage(records: DataFrame, metadata: DataFrame) -> DataFrame:
    """A9 + X1: reviewed ids that have metadata, and their share (0.0 when none).

    One pass: the distinct reviewed ids are left-joined to the flagged distinct
    listed ids (both sides are sets, so no key is hot) and a single aggregate
    counts both the reviewed and the matched ids.
    """
    reviewed = _truthy_ids(records, "parent_asin")
    listed = _truthy_ids(metadata, "parent_asin").select("id", F.lit(True).alias("_listed"))
    row = reviewed.join(listed, on="id", how="left").agg(
        F.count(F.lit(1)).alias("_reviewed"),
        F.count_if(F.col("_listed")).alias("reviewed_items_with_metadata"))
    return row.select(
        "reviewed_items_with_metadata",
        F.when(F.col("_reviewed") == 0, F.lit(0.0))
        .otherwise(F.col("reviewed_items_with_metadata") / F.col("_reviewed"))
        .alias("reviewed_item_metadata_coverage"),
    )
