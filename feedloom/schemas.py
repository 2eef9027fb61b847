"""

A *review record* frame is what the sources hand to cleaning and profiling:
``ordinal`` (source order, any orderable type), ``user_id``, ``parent_asin``
(STRING), ``rating`` (numeric or text), ``rating_text`` (the value as written),
``timestamp`` (as written), ``timestamp_int`` (BIGINT, null when absent or not an integer),
``timestamp_key`` (the value that tells events apart),
``verified_purchase``, ``helpful_vote`` / ``helpful_votes`` (optional).

A *metadata record* frame has ``ordinal``, ``parent_asin`` and the content
fields ``title``, ``description``, ``features``, ``store``, ``categories`` as
STRING, ARRAY<STRING> or VARIANT, plus ``price``, ``average_rating``,
``rating_number``.
"""

from __future__ import annotations

from pyspark.sql import types as T

INTERACTIONS = T.StructType([
    T.StructField("user_id", T.StringType(), False),
    T.StructField("item_id", T.StringType(), False),
    T.StructField("rating", T.FloatType(), False),
    T.StructField("timestamp_ms", T.LongType(), False),
    T.StructField("verified_purchase", T.BooleanType(), True),
    T.StructField("helpful_votes", T.IntegerType(), False),
    T.StructField("event_time", T.TimestampType(), False),
])

ITEMS = T.StructType([
    T.StructField("item_id", T.StringType(), False),
    T.StructField("title", T.StringType(), False),
    T.StructField("description", T.StringType(), False),
    T.StructField("features", T.StringType(), False),
    T.StructField("store", T.StringType(), False),
    T.StructField("price", T.FloatType(), True),
    T.StructField("average_rating", T.FloatType(), True),
    T.StructField("rating_number", T.IntegerType(), True),
    T.StructField("item_text", T.StringType(), False),
])

INTERACTION_COLUMNS = [f.name for f in INTERACTIONS.fields]
ITEM_COLUMNS = [f.name for f in ITEMS.fields]

# Fixed values of the processed-data contract.
INTERACTION_REQUIRED = {"user_id", "item_id", "rating", "timestamp_ms", "event_time"}
ITEM_REQUIRED = {"item_id", "item_text"}
EVENT_KEY = ["user_id", "item_id", "timestamp_ms"]
REVIEW_REQUIRED_FIELDS = ("user_id", "parent_asin", "rating", "timestamp")
METADATA_CONTENT_FIELDS = ("title", "description", "features", "categories")

ORDINAL = "ordinal"


def missing_columns(columns, required) -> list[str]:
    """Required minus present, sorted (metadata only, no job)."""
    return sorted(set(required) - set(columns))
