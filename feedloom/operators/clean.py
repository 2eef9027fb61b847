"""Cleaning: review records -> interactions, metadata records -> items.

"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, VariantType

from feedloom.functions.text import item_text, join_text
from feedloom.functions.time import event_time_from_ms
from feedloom.operators.dedup import keep_first
from feedloom.operators.scalars import combine_one_row
from feedloom.schemas import EVENT_KEY, INTERACTION_COLUMNS, ITEM_COLUMNS, ORDINAL


def typed(df: DataFrame, name: str, dtype: str | DataType, safe: bool = False) -> Column:
    """ANSI cast of a field (raises on bad text, as the contract cast does).

    VARIANT fields go through ``variant_get``; a missing field is a typed null.
    ``safe=True`` gives null instead of raising (for quarantine checks).
    """
    if name not in df.columns:
        return F.lit(None).cast(dtype)
    col = F.col(name)
    target = dtype if isinstance(dtype, str) else dtype.simpleString()
    if isinstance(df.schema[name].dataType, VariantType):
        return (F.try_variant_get if safe else F.variant_get)(col, "$", target)
    return F.try_cast(col, target) if safe else col.cast(dtype)


REVIEW_CASTS = {"rating": "float", "timestamp": "bigint", "verified_purchase": "boolean",
                "helpful_vote": "int", "helpful_votes": "int"}
ITEM_CASTS = {"price": "float", "average_rating": "float", "rating_number": "int"}


def _failed_fields(df: DataFrame, casts: dict[str, str]) -> Column:
    present = [c for c in casts if c in df.columns]
    failed = [F.when(F.col(c).isNotNull() & typed(df, c, casts[c], safe=True).isNull(), F.lit(c))
              for c in present]
    if not failed:
        return F.array().cast("array<string>")
    return F.filter(F.array(*failed), lambda x: x.isNotNull())


def _cast_failures(df: DataFrame, casts: dict[str, str]) -> DataFrame:
    flagged = df.withColumn("failed_fields", _failed_fields(df, casts))
    return flagged.where(F.size("failed_fields") > 0)


def cast_failures(records: DataFrame) -> DataFrame:
    """P3 quarantine: review records whose contract casts would fail, with the field names."""
    return _cast_failures(records, REVIEW_CASTS)


def item_cast_failures(metadata: DataFrame) -> DataFrame:
    """P4 quarantine: metadata records whose numeric casts would fail."""
    return _cast_failures(metadata, ITEM_CASTS)


def _helpful_votes(records: DataFrame) -> Column:
    # helpful_vote, else helpful_votes, else 0.  A present-but-null
    # helpful_vote also becomes 0 (the contract column is not nullable).
    parts = [typed(records, c, "int") for c in ("helpful_vote", "helpful_votes") if c in records.columns]
    return F.coalesce(*parts, F.lit(0)) if parts else F.lit(0)


def project_reviews(records: DataFrame) -> DataFrame:
    """P1 + P2 + P3: rename, fallback and contract casts (before the null filter)."""
    return records.select(
        typed(records, "user_id", "string").alias("user_id"),
        typed(records, "parent_asin", "string").alias("item_id"),
        F.col("rating").alias("_rating_raw"),
        F.col("timestamp").alias("_ts_raw"),
        typed(records, "verified_purchase", "boolean").alias("verified_purchase"),
        _helpful_votes(records).alias("helpful_votes"),
        F.col(ORDINAL),
    )


def clean_interactions(records: DataFrame, sort: bool = True, on_cast_error: str = "raise") -> DataFrame:
    """Select, drop incomplete, cast, keep-first dedup, derive event time, order.

    Output: the seven contract columns plus ``ordinal`` (kept so downstream
    stable sorts and first-seen indexing need no recomputation of input order).
    Two shuffles: the dedup hash exchange (hot copies pre-limited map-side) and
    the range exchange of the final sort (whose sampled bounds split a hot user
    across tasks because the ordinal breaks ties).

    ``on_cast_error="raise"`` (default) fails the job on a value the contract
    cannot cast, as the contract demands; ``"skip"`` leaves such rows out -
    they are exactly the rows of ``cast_failures(records)``, the quarantine.
    """
    if on_cast_error not in ("raise", "skip"):
        raise ValueError("on_cast_error must be 'raise' or 'skip'")
    if on_cast_error == "skip":
        records = records.where(F.size(_failed_fields(records, REVIEW_CASTS)) == 0)
    p = project_reviews(records)
    rating_raw = p.schema["_rating_raw"].dataType
    rating_num = (F.variant_get(F.col("_rating_raw"), "$", "double")
                  if isinstance(rating_raw, VariantType) else F.col("_rating_raw"))
    ts_raw = p.schema["_ts_raw"].dataType
    ts_num = (F.variant_get(F.col("_ts_raw"), "$", "bigint")
              if isinstance(ts_raw, VariantType) else F.col("_ts_raw"))
    present = (
        F.col("user_id").isNotNull() & F.col("item_id").isNotNull()
        & F.col("_rating_raw").isNotNull() & F.col("_ts_raw").isNotNull()
    )
    if not isinstance(rating_raw, VariantType) and rating_raw.typeName() in ("float", "double"):
        present = present & ~F.isnan(F.col("_rating_raw"))
    cast = p.where(present).select(
        "user_id", "item_id",
        rating_num.cast("float").alias("rating"),
        ts_num.cast("bigint").alias("timestamp_ms"),
        "verified_purchase", "helpful_votes", ORDINAL,
    )
    deduped = keep_first(cast, EVENT_KEY, [ORDINAL])
    out = deduped.select(
        *INTERACTION_COLUMNS[:-1],
        event_time_from_ms(F.col("timestamp_ms")).alias("event_time"),
        ORDINAL,
    )
    return out.orderBy("user_id", "timestamp_ms", ORDINAL) if sort else out


def reviewed_item_ids(interactions: DataFrame) -> DataFrame:
    """The distinct item ids of the interactions (partial aggregate first)."""
    return interactions.select("item_id").distinct()


def clean_items(metadata: DataFrame, interactions: DataFrame, sort: bool = True,
                on_cast_error: str = "raise") -> DataFrame:
    """Keep reviewed items only, keep-first dedup, then cast and build normalised text, order.

    The semi join runs first (J1); its build side is the *distinct* reviewed
    ids, so AQE broadcasts it only when the measured size is under the
    broadcast threshold and otherwise shuffles.  Copies are dropped on the raw
    fields (R2) before anything is cast or built, so neither a bad value in a
    later copy nor the text of a dropped one costs anything.

    ``on_cast_error="skip"`` leaves out records that ``item_cast_failures``
    lists, before the dedup, as ``clean_interactions`` does.
    """
    if on_cast_error not in ("raise", "skip"):
        raise ValueError("on_cast_error must be 'raise' or 'skip'")
    if on_cast_error == "skip":
        metadata = metadata.where(F.size(_failed_fields(metadata, ITEM_CASTS)) == 0)
    reviewed = reviewed_item_ids(interactions).withColumnRenamed("item_id", "parent_asin")
    listed = metadata.join(reviewed, on="parent_asin", how="left_semi")
    kept = keep_first(listed, ["parent_asin"], [ORDINAL])
    title = join_text(kept, "title")
    description = join_text(kept, "description")
    features = join_text(kept, "features")
    store = join_text(kept, "store")
    out = kept.select(
        typed(kept, "parent_asin", "string").alias("item_id"),
        title.alias("title"),
        description.alias("description"),
        features.alias("features"),
        store.alias("store"),
        typed(kept, "price", "float").alias("price"),
        typed(kept, "average_rating", "float").alias("average_rating"),
        typed(kept, "rating_number", "int").alias("rating_number"),
        item_text(title, description, features, store).alias("item_text"),
        F.col(ORDINAL),
    )
    out = out.select(*ITEM_COLUMNS, ORDINAL)
    return out.orderBy("item_id", ORDINAL) if sort else out


def preprocessing_summary(interactions: DataFrame, items: DataFrame) -> DataFrame:
    """O8 + A17: output row counts and items whose text is exactly empty (no strip)."""
    return combine_one_row(
        interactions.agg(F.count(F.lit(1)).alias("interactions")),
        items.agg(
            F.count(F.lit(1)).alias("items"),
            F.count_if(F.length("item_text") == 0).alias("items_without_text"),
        ),
    )
