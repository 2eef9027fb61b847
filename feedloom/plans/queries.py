"""Driver queries: each ``(spark, sf_dir) -> DataFrame`` runs one operator group
over the record views of the driver tables.  ``present`` drops the internal
``ordinal`` and shows instants as UTC ``yyyy-MM-dd HH:mm:ss.SSSSSS`` text and
dates as ``yyyy-MM-dd`` text: Spark and DuckDB hand timestamps to pandas at
different resolutions (ns vs us), so text is the one form whose values *and*
dtypes agree however the comparison reads them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampType

from feedloom.operators import clean, explore, index, label, profile, validate
from feedloom.operators.scalars import combine_one_row
from feedloom.session import materialize, scratch_path
from feedloom.sources import fixtures as fx
from feedloom.sources import jsonl
from feedloom.sources.audit import source_audit
from feedloom.streaming.ingest import read_ingested, start_raw_ingest

Query = Callable[[SparkSession, str], DataFrame]


def present(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if f.name == "ordinal":
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, TimestampType):
            c = F.date_format(c.cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, DateType):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# --- shared building blocks ------------------------------------------------
# Queries with one consumer stay lazy.  Where several consumers read the
# cleaned tables, they are written once (as the build job does) and re-read.

def events_interactions(spark, d, sort=True):
    return clean.clean_interactions(fx.raw_events(spark, d), sort=sort)


def lines_interactions(spark, d, sort=True):
    return clean.clean_interactions(fx.raw_lines(spark, d), sort=sort)


def stored_tables(spark, d, source="events"):
    raw = fx.raw_events(spark, d) if source == "events" else fx.raw_lines(spark, d)
    inter = materialize(clean.clean_interactions(raw, sort=False), f"{source}-interactions")
    items = materialize(clean.clean_items(fx.raw_items(spark, d), inter, sort=False), f"{source}-items")
    return inter, items


INTERACTION_ORDER = ["user_id", "timestamp_ms", "ordinal"]


def events_encoders(spark, d):
    inter = materialize(events_interactions(spark, d, sort=False), "events-interactions")
    return index.fit_encoders(inter, INTERACTION_ORDER)


# --- registry ----------------------------------------------------------------

def q_clean_interactions(spark, d):
    return present(events_interactions(spark, d))


def q_clean_items(spark, d):
    inter = events_interactions(spark, d, sort=False)
    return present(clean.clean_items(fx.raw_items(spark, d), inter))


def q_preprocessing_summary(spark, d):
    return clean.preprocessing_summary(*stored_tables(spark, d))


def q_clean_items_with_copies(spark, d):
    inter = events_interactions(spark, d, sort=False)
    return present(clean.clean_items(fx.items_with_copies(spark, d), inter))


def q_items_without_text_bare(spark, d):
    items = clean.clean_items(fx.bare_items(spark, d), events_interactions(spark, d, False), sort=False)
    return items.agg(F.count_if(F.length("item_text") == 0).alias("items_without_text"))


def q_items_without_text(spark, d):
    items = clean.clean_items(fx.raw_items(spark, d), events_interactions(spark, d, False), sort=False)
    return items.agg(F.count_if(F.length("item_text") == 0).alias("items_without_text"))


def q_profile_reviews(spark, d):
    return profile.profile_reviews(fx.raw_events(spark, d))


def q_review_missing_fields(spark, d):
    return profile.review_missing_fields(fx.raw_events(spark, d))


def q_raw_rating_histogram(spark, d):
    return profile.raw_rating_histogram(fx.raw_events(spark, d))


def q_profile_metadata(spark, d):
    return profile.profile_metadata(fx.raw_items(spark, d))


def q_metadata_missing_fields(spark, d):
    return profile.metadata_missing_fields(fx.raw_items(spark, d))


def q_join_coverage(spark, d):
    return profile.join_coverage(fx.raw_events(spark, d), fx.raw_items(spark, d))


def q_validation_findings(spark, d):
    return validate.validation_findings(*stored_tables(spark, d))


def q_validation_findings_dirty(spark, d):
    return validate.validation_findings(fx.dirty_interactions(spark, d), fx.dirty_items(spark, d))


def q_validation_report_dirty(spark, d):
    return validate.validation_report(q_validation_findings_dirty(spark, d))


def q_referential_orphans(spark, d):
    return present(validate.referential_orphans(*stored_tables(spark, d)))


def q_label_interactions(spark, d):
    return present(label.label_interactions(events_interactions(spark, d, False)))


def q_label_summary(spark, d):
    return label.label_summary(label.label_interactions(events_interactions(spark, d, False), sort=False))


def q_dataset_summary(spark, d):
    return explore.dataset_summary(*stored_tables(spark, d))


def q_rating_counts(spark, d):
    return explore.rating_counts(events_interactions(spark, d, False))


def q_user_activity_histogram(spark, d):
    return explore.user_activity_histogram(events_interactions(spark, d, False))


def q_active_period(spark, d):
    return present(explore.active_period(events_interactions(spark, d, False)))


def q_top_items(spark, d):
    return explore.top_items(*stored_tables(spark, d))


def events_index(spark, d, column):
    """One mapping only; ``events_encoders`` fits both."""
    return index.fit_index(events_interactions(spark, d, sort=False), column, INTERACTION_ORDER)


def q_user_index(spark, d):
    return events_index(spark, d, "user_id")


def q_item_index(spark, d):
    return events_index(spark, d, "item_id")


def q_item_index_by_ordinal(spark, d):
    return index.fit_index(events_interactions(spark, d, sort=False), "item_id", ["ordinal"])


def q_user_index_by_ordinal(spark, d):
    return index.fit_index(events_interactions(spark, d, sort=False), "user_id", ["ordinal"])


def q_encode_holdout(spark, d):
    users, items = events_encoders(spark, d)
    return present(index.encode_interactions(lines_interactions(spark, d, False), users, items))


def q_decode_indices(spark, d):
    items = events_index(spark, d, "item_id")
    encoded = index.apply_index(lines_interactions(spark, d, False).select("item_id"), items, "item_id", "item_idx")
    return index.invert_index(encoded.select("item_idx"), items, "item_idx", "decoded_item_id")


def q_user_activity(spark, d):
    return explore.user_activity(events_interactions(spark, d, False))


def q_item_popularity(spark, d):
    return explore.item_popularity(events_interactions(spark, d, False))


def q_reviewed_item_ids(spark, d):
    return clean.reviewed_item_ids(events_interactions(spark, d, False))


def q_index_sizes(spark, d):
    users, items = events_encoders(spark, d)
    return combine_one_row(index.index_size(users).withColumnRenamed("size", "users"),
                           index.index_size(items).withColumnRenamed("size", "items"))


# bench-size variants over lineitem x orders

def q_lines_clean_interactions(spark, d):
    return present(lines_interactions(spark, d))


def q_lines_clean_items(spark, d):
    inter = lines_interactions(spark, d, sort=False)
    return present(clean.clean_items(fx.raw_items(spark, d), inter))


def q_lines_validation_findings(spark, d):
    return validate.validation_findings(*stored_tables(spark, d, "lines"))


def q_lines_label_interactions(spark, d):
    return present(label.label_interactions(lines_interactions(spark, d, False)))


def q_lines_label_summary(spark, d):
    return label.label_summary(label.label_interactions(lines_interactions(spark, d, False), sort=False))


def q_lines_dataset_summary(spark, d):
    return explore.dataset_summary(*stored_tables(spark, d, "lines"))


def q_lines_top_items(spark, d):
    return explore.top_items(*stored_tables(spark, d, "lines"))


def q_lines_user_activity_histogram(spark, d):
    return explore.user_activity_histogram(lines_interactions(spark, d, False))


def q_lines_profile_reviews(spark, d):
    return profile.profile_reviews(fx.raw_lines(spark, d))


def q_lines_item_index(spark, d):
    return index.fit_index(lines_interactions(spark, d, False), "item_id", INTERACTION_ORDER)


# raw JSON-lines path: Spark writes the views as gzip JSONL, then ingests them

def _events_jsonl(spark, d):
    return fx.write_jsonl(fx.raw_events(spark, d), scratch_path(spark, "events-jsonl"))


def _items_jsonl(spark, d):
    return fx.write_jsonl(fx.raw_items(spark, d), scratch_path(spark, "items-jsonl"))


def _ingest(spark, path):
    return jsonl.ingest_records(spark, path, scratch_path(spark, "ingest"), mode="failfast")


def jsonl_reviews(spark, d):
    return jsonl.review_records(_ingest(spark, _events_jsonl(spark, d)))


def jsonl_metadata(spark, d):
    return jsonl.metadata_records(_ingest(spark, _items_jsonl(spark, d)))


def q_jsonl_profile_reviews(spark, d):
    return profile.profile_reviews(jsonl_reviews(spark, d))


def q_jsonl_review_missing_fields(spark, d):
    return profile.review_missing_fields(jsonl_reviews(spark, d))


def q_jsonl_raw_rating_histogram(spark, d):
    return profile.raw_rating_histogram(jsonl_reviews(spark, d))


def q_jsonl_metadata_missing_fields(spark, d):
    return profile.metadata_missing_fields(jsonl_metadata(spark, d))


def q_jsonl_clean_interactions(spark, d):
    return present(clean.clean_interactions(jsonl_reviews(spark, d)))


def q_jsonl_clean_items(spark, d):
    inter = clean.clean_interactions(jsonl_reviews(spark, d), sort=False)
    return present(clean.clean_items(jsonl_metadata(spark, d), inter))


def q_jsonl_join_coverage(spark, d):
    return profile.join_coverage(jsonl_reviews(spark, d), jsonl_metadata(spark, d))


def stream_reviews(spark, d):
    """Review records that went through the incremental (streaming) ingest."""
    landing = _events_jsonl(spark, d)
    table = scratch_path(spark, "stream-table")
    start_raw_ingest(spark, landing, table, scratch_path(spark, "stream-checkpoint")).awaitTermination()
    return jsonl.review_records(read_ingested(spark, table))


def q_stream_profile_reviews(spark, d):
    return profile.profile_reviews(stream_reviews(spark, d))


def q_stream_clean_interactions(spark, d):
    return present(clean.clean_interactions(stream_reviews(spark, d)))


def q_source_audit(spark, d):
    return source_audit(spark, _events_jsonl(spark, d))


def q_source_audit_by_folder(spark, d):
    audit = source_audit(spark, fx.write_dirty_jsonl(spark, d, scratch_path(spark, "dirty-jsonl")))
    return audit.groupBy(F.regexp_extract("file", "event_type=([^/]*)", 1).alias("folder")).agg(
        *[F.sum(c).alias(c) for c in ("lines", "records", "blank_lines", "malformed_lines")])


def q_source_audit_totals(spark, d):
    audit = q_source_audit(spark, d)
    return audit.agg(
        F.sum("lines").alias("lines"), F.sum("records").alias("records"),
        F.sum("blank_lines").alias("blank_lines"), F.sum("malformed_lines").alias("malformed_lines"),
        F.count_if(~F.col("valid")).alias("invalid_files"))


QUERIES: dict[str, Query] = {
    "clean_interactions": q_clean_interactions,
    "clean_items": q_clean_items,
    "preprocessing_summary": q_preprocessing_summary,
    "items_without_text": q_items_without_text,
    "clean_items_with_copies": q_clean_items_with_copies,
    "items_without_text_bare": q_items_without_text_bare,
    "item_index_by_ordinal": q_item_index_by_ordinal,
    "user_index_by_ordinal": q_user_index_by_ordinal,
    "source_audit_by_folder": q_source_audit_by_folder,
    "profile_reviews": q_profile_reviews,
    "review_missing_fields": q_review_missing_fields,
    "raw_rating_histogram": q_raw_rating_histogram,
    "profile_metadata": q_profile_metadata,
    "metadata_missing_fields": q_metadata_missing_fields,
    "join_coverage": q_join_coverage,
    "validation_findings": q_validation_findings,
    "validation_findings_dirty": q_validation_findings_dirty,
    "validation_report_dirty": q_validation_report_dirty,
    "referential_orphans": q_referential_orphans,
    "label_interactions": q_label_interactions,
    "label_summary": q_label_summary,
    "dataset_summary": q_dataset_summary,
    "rating_counts": q_rating_counts,
    "user_activity_histogram": q_user_activity_histogram,
    "active_period": q_active_period,
    "top_items": q_top_items,
    "user_activity": q_user_activity,
    "item_popularity": q_item_popularity,
    "reviewed_item_ids": q_reviewed_item_ids,
    "index_sizes": q_index_sizes,
    "user_index": q_user_index,
    "item_index": q_item_index,
    "encode_holdout": q_encode_holdout,
    "decode_indices": q_decode_indices,
    "lines_clean_interactions": q_lines_clean_interactions,
    "lines_clean_items": q_lines_clean_items,
    "lines_validation_findings": q_lines_validation_findings,
    "lines_label_interactions": q_lines_label_interactions,
    "lines_label_summary": q_lines_label_summary,
    "lines_dataset_summary": q_lines_dataset_summary,
    "lines_top_items": q_lines_top_items,
    "lines_user_activity_histogram": q_lines_user_activity_histogram,
    "lines_profile_reviews": q_lines_profile_reviews,
    "lines_item_index": q_lines_item_index,
    "jsonl_profile_reviews": q_jsonl_profile_reviews,
    "jsonl_review_missing_fields": q_jsonl_review_missing_fields,
    "jsonl_raw_rating_histogram": q_jsonl_raw_rating_histogram,
    "jsonl_metadata_missing_fields": q_jsonl_metadata_missing_fields,
    "jsonl_clean_interactions": q_jsonl_clean_interactions,
    "jsonl_clean_items": q_jsonl_clean_items,
    "jsonl_join_coverage": q_jsonl_join_coverage,
    "stream_profile_reviews": q_stream_profile_reviews,
    "stream_clean_interactions": q_stream_clean_interactions,
    "source_audit": q_source_audit,
    "source_audit_totals": q_source_audit_totals,
}
