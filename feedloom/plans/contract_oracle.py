"""DuckDB SQL of the queries over stored tables, orders and the contract's edges."""

from __future__ import annotations

from feedloom.plans import oracle as o


def placed(order: str) -> str:
    return f"row_number() OVER (ORDER BY {order}) - 1 AS position"


_DROPPED = ",\n".join([o.RAW_EVENTS, o.DIRTY])
_MIXED = o.RAW_EVENTS + """,
mixed AS (
  SELECT user_id, parent_asin, CASE WHEN ordinal % 7 = 0 THEN "timestamp" || '.5' WHEN ordinal % 11 = 0 THEN '"' || "timestamp" || '"'
    ELSE CAST("timestamp" AS VARCHAR) END AS "timestamp",
  CASE WHEN ordinal % 7 <> 0 AND ordinal % 11 <> 0 THEN "timestamp" END AS whole FROM raw_events)"""
_UNTITLED = o.RAW_ITEMS.replace("CASE WHEN p_size = 1 THEN ''", "CASE WHEN p_partkey % 2 = 0 OR p_size = 1 THEN ''")

ORACLE = {
    "clean_interactions_order": o.with_(o.EVENTS_BASE, f"SELECT {o.INTERACTION_OUT}, {placed('user_id, timestamp_ms, ordinal')} FROM I"),
    "clean_items_order": o.with_(o.EVENTS_BASE, f"SELECT item_id, title, {placed('item_id')} FROM T"),
    "lines_label_interactions_order": o.with_(o.LINES_BASE, f"""SELECT user_id, item_id, timestamp_ms,
  CAST(COALESCE(rating >= CAST(4.0 AS FLOAT) AND NOT isnan(rating), false) AS TINYINT) AS is_positive, {placed('user_id, timestamp_ms, ordinal')} FROM I"""),
    "metadata_missing_fields_order": f"SELECT *, {placed('field')} FROM ({o.ORACLE['metadata_missing_fields']})",
    "lines_rating_histogram_order": o.with_(o.RAW_LINES, f"""SELECT *, {placed('rating')} FROM (
  SELECT CAST(rating AS VARCHAR) AS rating, count(*) AS records FROM raw_lines WHERE rating IS NOT NULL GROUP BY 1)"""),
    "built_interactions": o.ORACLE["clean_interactions"],
    "built_items": o.ORACLE["clean_items"],
    "built_preprocessing_summary": o.ORACLE["preprocessing_summary"],
    "lines_stored_labels": o.ORACLE["lines_label_interactions"],
    "lines_stored_label_summary": f"""SELECT 4.0::DOUBLE AS positive_rating_threshold, interactions, positive_interactions,
  negative_or_neutral_interactions, round(positive_interaction_rate, 6) AS positive_interaction_rate FROM ({o.ORACLE['lines_label_summary']})""",
    "gate_report": f"SELECT *, 'failed' AS gate FROM ({o.ORACLE['validation_findings']})",
    "required_columns_findings": o.with_(_DROPPED, """SELECT 'error' AS severity, 'interactions' AS dataset, 'required_columns' AS "check",
  'Missing required columns: event_time, rating.' AS message, CAST(0 AS BIGINT) AS affected_rows
UNION ALL SELECT 'error', 'items', 'required_columns', 'Missing required columns: item_text.', 0
UNION ALL SELECT 'error', 'cross_dataset', 'interaction_item_join', 'Every interaction item must exist in the item dataset.', count(*)
FROM dirty_interactions x WHERE NOT EXISTS (SELECT 1 FROM dirty_items t WHERE t.item_id IS NOT DISTINCT FROM x.item_id)"""),
    "saved_item_index": o.ORACLE["item_index"],
    "jsonl_mixed_timestamps": o.with_(_MIXED, o.profile_reviews_sql("mixed").replace('min("timestamp")', "min(whole)").replace('max("timestamp")', "max(whole)")),
    "lines_untitled_top_items": o.with_(",\n".join([o.RAW_LINES, _UNTITLED, o.clean_cte("I", "raw_lines"), o.items_cte("T", "raw_items", "I")]), o.TOP_ITEMS),
    "lines_dataset_summary_rounded": f"""SELECT interactions, users, items, metadata_items, round(mean_rating, 3) AS mean_rating,
  round(positive_interaction_rate, 4) AS positive_interaction_rate, round(avg_interactions_per_user, 3) AS avg_interactions_per_user,
  round(avg_interactions_per_item, 3) AS avg_interactions_per_item, matrix_density, sparsity FROM ({o.ORACLE['lines_dataset_summary']})""",
}
