"""DuckDB SQL oracle for every driver query (independent of the Spark code).

The record views of ``feedloom.sources.fixtures`` are restated as CTEs over
the pre-registered tables; each query is then written in plain SQL.
"""

from __future__ import annotations

from feedloom.functions.text import NON_WS, WS_RUN


def norm(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS_RUN}', ' ', 'g'), ' ')"


def iso(x: str) -> str:
    return (f"(strftime(make_timestamp(({x}) * 1000), '%Y-%m-%dT%H:%M:%S') || "
            f"CASE WHEN ({x}) % 1000 <> 0 THEN '.' || lpad(CAST((({x}) % 1000) * 1000 AS VARCHAR), 6, '0') "
            f"ELSE '' END || '+00:00')")


RAW_EVENTS = """raw_events AS (
  SELECT event_id AS ordinal,
    CASE WHEN event_id % 101 = 0 THEN '' ELSE 'u' || CAST(user_id AS VARCHAR) END AS user_id,
    CASE WHEN event_type = 'error' THEN 'r' ELSE 'i' END || json_extract_string(props, '$.k') AS parent_asin,
    CAST(CASE WHEN event_id % 97 = 0 THEN NULL ELSE CASE event_type WHEN 'purchase' THEN 5 WHEN 'signup' THEN 4
         WHEN 'click' THEN 3 WHEN 'view' THEN 2 WHEN 'error' THEN 1 END END AS DOUBLE) AS rating,
    epoch_ms(date_trunc('day', ts)) AS "timestamp",
    event_type = 'purchase' AS verified_purchase,
    CASE WHEN event_type = 'error' THEN NULL ELSE CAST(event_id % 7 AS INTEGER) END AS helpful_vote
  FROM events)"""

RAW_ITEMS = """raw_items AS (
  SELECT p_partkey AS ordinal, 'i' || CAST(p_partkey AS VARCHAR) AS parent_asin,
    CASE WHEN p_size = 1 THEN '' ELSE chr(12288) || ' ' || replace(p_name, ' ', ' ' || chr(160)) || chr(10) END AS title,
    [p_type, '', p_brand] AS description,
    [p_name] AS features,
    CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_brand END AS store,
    CASE WHEN p_size > 25 THEN [p_type] ELSE []::VARCHAR[] END AS categories,
    p_retailprice AS price, CAST(NULL AS DOUBLE) AS average_rating, p_size AS rating_number
  FROM part)"""

RAW_LINES = """raw_lines AS (
  SELECT {'o': l_orderkey, 'n': l_linenumber, 'p': l_partkey, 's': l_suppkey} AS ordinal,
    'u' || CAST(o_custkey AS VARCHAR) AS user_id, 'i' || CAST(l_partkey AS VARCHAR) AS parent_asin,
    CAST(ceil(l_quantity / 10) AS DOUBLE) AS rating, epoch_ms(l_shipdate) AS "timestamp",
    o_orderstatus = 'F' AS verified_purchase, CAST(l_linenumber AS INTEGER) AS helpful_vote
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

DIRTY = """dirty_interactions AS (
  SELECT user_id, parent_asin AS item_id,
    CAST(CASE WHEN ordinal % 89 = 0 THEN 6.0 ELSE rating END AS FLOAT) AS rating,
    CASE WHEN ordinal % 83 = 0 THEN 0 ELSE "timestamp" END AS timestamp_ms,
    make_timestamp((CASE WHEN ordinal % 83 = 0 THEN 0 ELSE "timestamp" END) * 1000) AS event_time
  FROM raw_events),
dirty_items AS (
  SELECT CASE WHEN p_size = 50 THEN NULL ELSE 'i' || CAST(p_partkey AS VARCHAR) END AS item_id,
    CASE WHEN p_size <= 2 THEN chr(12288) ELSE p_type END AS item_text
  FROM part)"""


def clean_cte(name: str, src: str) -> str:
    return f"""{name} AS (
  SELECT user_id, item_id, rating, timestamp_ms, verified_purchase, helpful_votes,
    make_timestamp(timestamp_ms * 1000) AS event_time, ordinal
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id, item_id, timestamp_ms ORDER BY ordinal) AS rn
        FROM (SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(parent_asin AS VARCHAR) AS item_id,
                CAST(rating AS FLOAT) AS rating, CAST("timestamp" AS BIGINT) AS timestamp_ms,
                verified_purchase, CAST(COALESCE(helpful_vote, 0) AS INTEGER) AS helpful_votes, ordinal
              FROM {src}
              WHERE user_id IS NOT NULL AND parent_asin IS NOT NULL AND rating IS NOT NULL
                AND NOT isnan(rating) AND "timestamp" IS NOT NULL))
  WHERE rn = 1)"""


def _join_list(x: str) -> str:
    return norm(f"COALESCE(array_to_string(list_filter({x}, lambda e: e IS NOT NULL AND e <> ''), ' '), '')")


def items_cte(name: str, src: str, interactions: str) -> str:
    return f"""{name} AS (
  SELECT item_id, title, description, features, store, price, average_rating, rating_number,
    concat_ws(' ', NULLIF(title, ''), NULLIF(description, ''), NULLIF(features, ''), NULLIF(store, '')) AS item_text,
    ordinal
  FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY ordinal) AS rn
        FROM (SELECT CAST(parent_asin AS VARCHAR) AS item_id,
                {norm("COALESCE(title, '')")} AS title,
                {_join_list("description")} AS description,
                {_join_list("features")} AS features,
                {norm("COALESCE(store, '')")} AS store,
                CAST(price AS FLOAT) AS price, CAST(average_rating AS FLOAT) AS average_rating,
                CAST(rating_number AS INTEGER) AS rating_number, ordinal
              FROM {src} WHERE parent_asin IN (SELECT item_id FROM {interactions})))
  WHERE rn = 1)"""


INTERACTION_OUT = ("user_id, item_id, rating, timestamp_ms, verified_purchase, helpful_votes, "
                   "strftime(event_time, '%Y-%m-%d %H:%M:%S.%f') AS event_time")
ITEM_OUT = "item_id, title, description, features, store, price, average_rating, rating_number, item_text"

EVENTS_BASE = ",\n".join([RAW_EVENTS, RAW_ITEMS, clean_cte("I", "raw_events"), items_cte("T", "raw_items", "I")])
LINES_BASE = ",\n".join([RAW_LINES, RAW_ITEMS, clean_cte("I", "raw_lines"), items_cte("T", "raw_items", "I")])


def with_(base: str, body: str) -> str:
    return f"WITH {base}\n{body}"


def profile_reviews_sql(src: str) -> str:
    return f"""SELECT
  (SELECT count(*) FROM {src}) AS records,
  (SELECT count(DISTINCT user_id) FROM {src} WHERE user_id <> '') AS unique_users,
  (SELECT count(DISTINCT parent_asin) FROM {src} WHERE parent_asin <> '') AS unique_reviewed_items,
  (SELECT CAST(COALESCE(sum(n - 1), 0) AS BIGINT)
     FROM (SELECT count(*) AS n FROM {src} GROUP BY user_id, parent_asin, "timestamp")) AS exact_duplicate_events,
  (SELECT {iso('min("timestamp")')} FROM {src}) AS first_interaction_utc,
  (SELECT {iso('max("timestamp")')} FROM {src}) AS last_interaction_utc"""


def findings_sql(inter: str, items: str) -> str:
    return f"""f AS (
  SELECT 1 AS seq, 'error' AS severity, 'interactions' AS dataset, 'null_required_values' AS "check",
    'Required values are null.' AS message,
    count(*) FILTER (WHERE user_id IS NULL OR item_id IS NULL OR rating IS NULL OR isnan(rating)
                     OR timestamp_ms IS NULL OR event_time IS NULL) AS affected_rows FROM {inter}
  UNION ALL SELECT 2, 'error', 'interactions', 'rating_range', 'Ratings must be between 1.0 and 5.0.',
    count(*) FILTER (WHERE rating IS NULL OR isnan(rating) OR NOT (rating BETWEEN 1.0 AND 5.0)) FROM {inter}
  UNION ALL SELECT 3, 'error', 'interactions', 'timestamp_range', 'Timestamps must be positive Unix milliseconds.',
    count(*) FILTER (WHERE timestamp_ms <= 0) FROM {inter}
  UNION ALL SELECT 4, 'error', 'interactions', 'duplicate_events', 'Duplicate user-item-timestamp events are not allowed.',
    (SELECT CAST(COALESCE(sum(n - 1), 0) AS BIGINT)
       FROM (SELECT count(*) AS n FROM {inter} GROUP BY user_id, item_id, timestamp_ms))
  UNION ALL SELECT 6, 'error', 'items', 'null_item_ids', 'Item IDs cannot be null.',
    count(*) FILTER (WHERE item_id IS NULL) FROM {items}
  UNION ALL SELECT 7, 'error', 'items', 'duplicate_item_ids', 'Item IDs must be unique.',
    (SELECT CAST(COALESCE(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM {items} GROUP BY item_id))
  UNION ALL SELECT 8, 'warning', 'items', 'missing_item_text',
    'Items without text cannot receive content-based recommendations.',
    count(*) FILTER (WHERE NOT regexp_matches(COALESCE(item_text, ''), '{NON_WS}')) FROM {items}
  UNION ALL SELECT 9, 'error', 'cross_dataset', 'interaction_item_join',
    'Every interaction item must exist in the item dataset.',
    count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM {items} t WHERE t.item_id IS NOT DISTINCT FROM x.item_id))
    FROM {inter} x)"""


FINDINGS_OUT = 'SELECT severity, dataset, "check", message, affected_rows FROM f WHERE affected_rows > 0'


def label_cte(src: str) -> str:
    return f"""L AS (SELECT {INTERACTION_OUT.replace("strftime(event_time", "strftime(x.event_time")},
    CAST(COALESCE(rating >= CAST(4.0 AS FLOAT) AND NOT isnan(rating), false) AS TINYINT) AS is_positive,
    CAST(CAST(x.event_time AS DATE) AS VARCHAR) AS event_date FROM {src} x)"""


LABEL_SUMMARY = """SELECT n AS interactions, p AS positive_interactions, n - p AS negative_or_neutral_interactions,
  CASE WHEN n = 0 THEN CAST(0.0 AS DOUBLE) ELSE p / n END AS positive_interaction_rate
FROM (SELECT count(*) AS n, CAST(COALESCE(sum(is_positive), 0) AS BIGINT) AS p FROM L)"""

DATASET_SUMMARY = """SELECT interactions, users, items, metadata_items, mean_rating,
  CAST(positives AS DOUBLE) / interactions AS positive_interaction_rate,
  CAST(interactions AS DOUBLE) / users AS avg_interactions_per_user,
  CAST(interactions AS DOUBLE) / items AS avg_interactions_per_item,
  CAST(interactions AS DOUBLE) / (CAST(users AS DOUBLE) * CAST(items AS DOUBLE)) AS matrix_density,
  1.0 - CAST(interactions AS DOUBLE) / (CAST(users AS DOUBLE) * CAST(items AS DOUBLE)) AS sparsity
FROM (SELECT count(*) AS interactions, count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items,
        CAST(avg(rating) FILTER (WHERE NOT isnan(rating)) AS DOUBLE) AS mean_rating,
        count(*) FILTER (WHERE rating >= CAST(4.0 AS FLOAT) AND NOT isnan(rating)) AS positives FROM I),
     (SELECT count(*) AS metadata_items FROM T)"""

TOP_ITEMS = """SELECT c.item_id, COALESCE(NULLIF(t.title, ''), 'Untitled product') AS title, c.interactions
FROM (SELECT item_id, count(*) AS interactions FROM I GROUP BY item_id
      ORDER BY interactions DESC, item_id LIMIT 5) c
LEFT JOIN T t ON c.item_id = t.item_id"""

ACTIVITY = """SELECT least(n, 10) AS interactions_per_user, count(*) AS users
FROM (SELECT count(*) AS n FROM I GROUP BY user_id) GROUP BY 1"""

USER_INDEX = """U AS (SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER) AS idx
  FROM (SELECT DISTINCT user_id AS value FROM I))"""


def index_by_ordinal_sql(column: str) -> str:
    return with_(EVENTS_BASE, f"""SELECT value, CAST(row_number() OVER (ORDER BY seen) - 1 AS INTEGER) AS idx
  FROM (SELECT {column} AS value, min(ordinal) AS seen FROM I GROUP BY {column})""")


def item_index_cte(name: str, src: str) -> str:
    return f"""{name} AS (SELECT item_id AS value,
    CAST(row_number() OVER (ORDER BY user_id, timestamp_ms, ordinal) - 1 AS INTEGER) AS idx
  FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY user_id, timestamp_ms, ordinal) AS rn
        FROM {src}) WHERE rn = 1)"""


ENCODE_BASE = ",\n".join([EVENTS_BASE, USER_INDEX, item_index_cte("M", "I"), RAW_LINES, clean_cte("H", "raw_lines"),
                          f"""E AS (SELECT h.user_id, h.item_id, h.rating, h.timestamp_ms, h.verified_purchase,
    h.helpful_votes, strftime(h.event_time, '%Y-%m-%d %H:%M:%S.%f') AS event_time,
    CAST(COALESCE(u.idx, -1) AS INTEGER) AS user_idx, CAST(COALESCE(m.idx, -1) AS INTEGER) AS item_idx
  FROM H h LEFT JOIN U u ON h.user_id = u.value LEFT JOIN M m ON h.item_id = m.value)"""])

ORACLE: dict[str, str] = {
    "clean_interactions": with_(EVENTS_BASE, f"SELECT {INTERACTION_OUT} FROM I"),
    "clean_items": with_(EVENTS_BASE, f"SELECT {ITEM_OUT} FROM T"),
    "preprocessing_summary": with_(EVENTS_BASE, """SELECT (SELECT count(*) FROM I) AS interactions,
  (SELECT count(*) FROM T) AS items,
  (SELECT count(*) FILTER (WHERE length(item_text) = 0) FROM T) AS items_without_text"""),
    "items_without_text": with_(EVENTS_BASE, """SELECT count(*) FILTER (WHERE length(item_text) = 0)
  AS items_without_text FROM T"""),
    # later copies of an item never win
    "clean_items_with_copies": with_(EVENTS_BASE, f"SELECT {ITEM_OUT} FROM T"),
    "items_without_text_bare": with_(EVENTS_BASE, """SELECT count(*) AS items_without_text FROM part
  WHERE p_size <= 5 AND 'i' || CAST(p_partkey AS VARCHAR) IN (SELECT item_id FROM I)"""),
    "item_index_by_ordinal": index_by_ordinal_sql("item_id"),
    "user_index_by_ordinal": index_by_ordinal_sql("user_id"),
    "profile_reviews": with_(RAW_EVENTS, profile_reviews_sql("raw_events")),
    "review_missing_fields": with_(RAW_EVENTS, """SELECT field, missing FROM (
  SELECT 'parent_asin' AS field, count(*) FILTER (WHERE parent_asin IS NULL OR parent_asin = '') AS missing FROM raw_events
  UNION ALL SELECT 'rating', count(*) FILTER (WHERE rating IS NULL) FROM raw_events
  UNION ALL SELECT 'timestamp', count(*) FILTER (WHERE "timestamp" IS NULL) FROM raw_events
  UNION ALL SELECT 'user_id', count(*) FILTER (WHERE user_id IS NULL OR user_id = '') FROM raw_events)
WHERE missing > 0"""),
    "raw_rating_histogram": with_(RAW_EVENTS, """SELECT CAST(rating AS VARCHAR) AS rating, count(*) AS records
FROM raw_events WHERE rating IS NOT NULL GROUP BY 1"""),
    "profile_metadata": with_(RAW_ITEMS, """SELECT (SELECT count(*) FROM raw_items) AS records,
  (SELECT count(DISTINCT parent_asin) FROM raw_items WHERE parent_asin <> '') AS unique_metadata_items"""),
    "metadata_missing_fields": with_(RAW_ITEMS, """SELECT field, missing FROM (
  SELECT 'categories' AS field, count(*) FILTER (WHERE categories IS NULL OR len(categories) = 0) AS missing FROM raw_items
  UNION ALL SELECT 'description', count(*) FILTER (WHERE description IS NULL OR len(description) = 0) FROM raw_items
  UNION ALL SELECT 'features', count(*) FILTER (WHERE features IS NULL OR len(features) = 0) FROM raw_items
  UNION ALL SELECT 'title', count(*) FILTER (WHERE title IS NULL OR title = '') FROM raw_items)
WHERE missing > 0"""),
    "join_coverage": with_(",\n".join([RAW_EVENTS, RAW_ITEMS,
                                       "r AS (SELECT DISTINCT parent_asin AS id FROM raw_events WHERE parent_asin <> '')",
                                       "m AS (SELECT DISTINCT parent_asin AS id FROM raw_items WHERE parent_asin <> '')"]),
                           """SELECT matched AS reviewed_items_with_metadata,
  CASE WHEN reviewed = 0 THEN CAST(0.0 AS DOUBLE) ELSE matched / reviewed END AS reviewed_item_metadata_coverage
FROM (SELECT (SELECT count(*) FROM r) AS reviewed, (SELECT count(*) FROM r WHERE id IN (SELECT id FROM m)) AS matched)"""),
    "validation_findings": with_(EVENTS_BASE + ",\n" + findings_sql("I", "T"), FINDINGS_OUT),
    "validation_findings_dirty": with_(",\n".join([RAW_EVENTS, DIRTY, findings_sql("dirty_interactions", "dirty_items")]),
                                       FINDINGS_OUT),
    "validation_report_dirty": with_(",\n".join([RAW_EVENTS, DIRTY, findings_sql("dirty_interactions", "dirty_items"),
                                                 "g AS (" + FINDINGS_OUT + ")"]),
                                     """SELECT count(*) FILTER (WHERE severity = 'error') = 0 AS is_valid,
  count(*) FILTER (WHERE severity = 'error') AS errors,
  count(*) FILTER (WHERE severity = 'warning') AS warnings FROM g"""),
    "referential_orphans": with_(EVENTS_BASE, f"""SELECT {INTERACTION_OUT.replace("strftime(event_time", "strftime(x.event_time")} FROM I x
WHERE NOT EXISTS (SELECT 1 FROM T t WHERE t.item_id IS NOT DISTINCT FROM x.item_id)"""),
    "label_interactions": with_(EVENTS_BASE + ",\n" + label_cte("I"), "SELECT * FROM L"),
    "label_summary": with_(EVENTS_BASE + ",\n" + label_cte("I"), LABEL_SUMMARY),
    "dataset_summary": with_(EVENTS_BASE, DATASET_SUMMARY),
    "rating_counts": with_(EVENTS_BASE, """SELECT rating, count(*) AS interactions FROM I
WHERE rating IS NOT NULL AND NOT isnan(rating) GROUP BY rating"""),
    "user_activity_histogram": with_(EVENTS_BASE, ACTIVITY),
    "active_period": with_(EVENTS_BASE, """SELECT CAST(CAST(min(event_time) AS DATE) AS VARCHAR) AS active_start,
  CAST(CAST(max(event_time) AS DATE) AS VARCHAR) AS active_end FROM I"""),
    "top_items": with_(EVENTS_BASE, TOP_ITEMS),
    "user_activity": with_(EVENTS_BASE, "SELECT user_id, count(*) AS interactions FROM I GROUP BY user_id"),
    "item_popularity": with_(EVENTS_BASE, "SELECT item_id, count(*) AS interactions FROM I GROUP BY item_id"),
    "reviewed_item_ids": with_(EVENTS_BASE, "SELECT DISTINCT item_id FROM I"),
    "index_sizes": with_(EVENTS_BASE, "SELECT count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items FROM I"),
    "user_index": with_(EVENTS_BASE + ",\n" + USER_INDEX, "SELECT value, idx FROM U"),
    "item_index": with_(EVENTS_BASE + ",\n" + item_index_cte("M", "I"), "SELECT value, idx FROM M"),
    "encode_holdout": with_(ENCODE_BASE, "SELECT * FROM E"),
    "decode_indices": with_(ENCODE_BASE, """SELECT e.item_idx, m.value AS decoded_item_id
FROM E e LEFT JOIN M m ON e.item_idx = m.idx"""),
    "lines_clean_interactions": with_(LINES_BASE, f"SELECT {INTERACTION_OUT} FROM I"),
    "lines_clean_items": with_(LINES_BASE, f"SELECT {ITEM_OUT} FROM T"),
    "lines_validation_findings": with_(LINES_BASE + ",\n" + findings_sql("I", "T"), FINDINGS_OUT),
    "lines_label_interactions": with_(LINES_BASE + ",\n" + label_cte("I"), "SELECT * FROM L"),
    "lines_label_summary": with_(LINES_BASE + ",\n" + label_cte("I"), LABEL_SUMMARY),
    "lines_dataset_summary": with_(LINES_BASE, DATASET_SUMMARY),
    "lines_top_items": with_(LINES_BASE, TOP_ITEMS),
    "lines_user_activity_histogram": with_(LINES_BASE, ACTIVITY),
    "lines_profile_reviews": with_(RAW_LINES, profile_reviews_sql("raw_lines")),
    "lines_item_index": with_(LINES_BASE + ",\n" + item_index_cte("M", "I"), "SELECT value, idx FROM M"),
}

# The JSON-lines path must reproduce the parquet-view results exactly.
for _key in ("profile_reviews", "review_missing_fields", "raw_rating_histogram", "metadata_missing_fields",
             "clean_interactions", "clean_items", "join_coverage"):
    ORACLE["jsonl_" + _key] = ORACLE[_key]

# The streaming ingest must reproduce the batch results exactly, too.
ORACLE["stream_profile_reviews"] = ORACLE["profile_reviews"]
ORACLE["stream_clean_interactions"] = ORACLE["clean_interactions"]

ORACLE["source_audit_by_folder"] = """SELECT event_type AS folder, count(*) AS lines,
  count(*) FILTER (WHERE event_id % 53 <> 0 AND event_id % 59 <> 0 AND event_id % 61 <> 0) AS records,
  count(*) FILTER (WHERE event_id % 53 = 0) AS blank_lines,
  count(*) FILTER (WHERE event_id % 53 <> 0 AND (event_id % 59 = 0 OR event_id % 61 = 0)) AS malformed_lines
FROM events GROUP BY event_type"""

ORACLE["source_audit_totals"] = """SELECT count(*) AS lines, count(*) AS records, CAST(0 AS BIGINT) AS blank_lines,
  CAST(0 AS BIGINT) AS malformed_lines, CAST(0 AS BIGINT) AS invalid_files FROM events"""
