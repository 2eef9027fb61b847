"""Driver queries over what the jobs store, the order of what they return, and the contract's edges."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.operators import clean, explore, index, label, profile, validate
from feedloom.operators.order import with_position
from feedloom.plans import build
from feedloom.plans import queries as q
from feedloom.session import scratch_path
from feedloom.sources import fixtures as fx
from feedloom.sources import jsonl
from feedloom.sources.sinks import read_table


def q_interactions_order(spark, d):
    return with_position(q.present(q.events_interactions(spark, d)))


def q_items_order(spark, d):
    items = clean.clean_items(fx.raw_items(spark, d), q.events_interactions(spark, d, sort=False))
    return with_position(items.select("item_id", "title"))


def q_labels_order(spark, d):
    labeled = label.label_interactions(q.lines_interactions(spark, d, False))
    return with_position(labeled.select("user_id", "item_id", "timestamp_ms", "is_positive"))


def q_missing_fields_order(spark, d):
    return with_position(profile.metadata_missing_fields(fx.raw_items(spark, d)))


def q_rating_histogram_order(spark, d):
    return with_position(profile.raw_rating_histogram(fx.raw_lines(spark, d)))


def _built(spark, d):
    """Both raw files through the whole job; the folder it wrote."""
    out = scratch_path(spark, "built")
    build.build_tables(spark, q._events_jsonl(spark, d), q._items_jsonl(spark, d), out)
    return out


def q_built_interactions(spark, d):
    return q.present(read_table(spark, f"{_built(spark, d)}/interactions.parquet", ["user_id", "item_id", "rating"]))


def q_built_items(spark, d):
    return q.present(read_table(spark, f"{_built(spark, d)}/items.parquet", ["item_id", "item_text"]))


def q_built_summary(spark, d):
    return spark.read.json(f"{_built(spark, d)}/preprocessing_summary.json")


def _labeled(spark, d):
    """Stored tables of the larger view through the gate and the labelling job; the folder it wrote."""
    out = scratch_path(spark, "labeled")
    q.lines_interactions(spark, d, False).write.parquet(f"{out}/interactions.parquet")
    items = clean.clean_items(fx.raw_items(spark, d), spark.read.parquet(f"{out}/interactions.parquet"), sort=False)
    items.write.parquet(f"{out}/items.parquet")
    build.gate_and_label(spark, f"{out}/interactions.parquet", f"{out}/items.parquet", out)
    return out


def q_stored_labels(spark, d):
    return q.present(spark.read.parquet(f"{_labeled(spark, d)}/interactions_labeled.parquet"))


def q_stored_label_summary(spark, d):
    return spark.read.json(f"{_labeled(spark, d)}/interaction_label_summary.json").select("policy.*", "*").drop("policy")


def q_gate_report(spark, d):
    """Findings that the gate has written before it failed, of events whose retired items are in no catalogue."""
    path = scratch_path(spark, "gate")
    try:
        validate.gate(validate.validation_findings(*q.stored_tables(spark, d)), path)
        outcome = "passed"
    except validate.ValidationError:
        outcome = "failed"
    return spark.read.json(f"{path}/issues").withColumn("gate", F.lit(outcome))


def q_required_columns(spark, d):
    return validate.validation_findings(fx.dirty_interactions(spark, d).drop("rating", "event_time"), fx.dirty_items(spark, d).drop("item_text"))


def q_saved_item_index(spark, d):
    path = scratch_path(spark, "mapping")
    index.save_mapping(q.events_index(spark, d, "item_id"), path)
    return index.load_mapping(spark, path)


def q_mixed_timestamps(spark, d):
    path = fx.write_mixed_timestamps(spark, d, scratch_path(spark, "mixed-jsonl"))
    return profile.profile_reviews(jsonl.review_records(q._ingest(spark, path)))


def q_untitled_top_items(spark, d):
    inter = q.lines_interactions(spark, d, False)
    return explore.top_items(inter, clean.clean_items(fx.untitled_items(spark, d), inter, sort=False))


def q_rounded_summary(spark, d):
    summary = explore.dataset_summary(*q.stored_tables(spark, d, "lines"))
    return spark.createDataFrame([explore.round_summary(summary.first().asDict())], summary.schema)


QUERIES = {
    "clean_interactions_order": q_interactions_order,
    "clean_items_order": q_items_order,
    "lines_label_interactions_order": q_labels_order,
    "metadata_missing_fields_order": q_missing_fields_order,
    "lines_rating_histogram_order": q_rating_histogram_order,
    "built_interactions": q_built_interactions,
    "built_items": q_built_items,
    "built_preprocessing_summary": q_built_summary,
    "lines_stored_labels": q_stored_labels,
    "lines_stored_label_summary": q_stored_label_summary,
    "gate_report": q_gate_report,
    "required_columns_findings": q_required_columns,
    "saved_item_index": q_saved_item_index,
    "jsonl_mixed_timestamps": q_mixed_timestamps,
    "lines_untitled_top_items": q_untitled_top_items,
    "lines_dataset_summary_rounded": q_rounded_summary,
}
