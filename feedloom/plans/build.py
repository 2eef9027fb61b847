"""End-to-end jobs: the reference's three command-line flows as Spark jobs.

* ``build_tables``   raw JSON lines -> parsed records (persisted once) -> clean
                     interactions and items -> parquet + counts      (3.1)
* ``gate_and_label`` stored tables -> findings (written) -> gate -> labels
                     -> parquet + label summary                      (3.2)
* ``profile_sources`` raw JSON lines -> review / metadata profiles and
                     join coverage                                   (3.3)
* ``explore``        stored tables -> EDA summary and distributions  (3.3)
* ``fit_and_encode`` training table -> mappings (written) -> encoded frames

Every intermediate that several steps read is a written table (a lineage cut
that survives executor loss); nothing is collected except one-row summaries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators import clean, explore as eda, index, label, profile, validate
from feedloom.session import scratch_path
from feedloom.sources import jsonl, sinks


def build_tables(spark: SparkSession, reviews, metadata, out_dir: str, mode: str = "failfast",
                 on_cast_error: str = "raise") -> dict:
    """3.1.  ``mode`` governs malformed JSON lines, ``on_cast_error`` values the
    contract cannot cast; with ``"skip"`` those rows are written to
    ``_quarantine/cast_failures`` and ``_quarantine/item_cast_failures`` instead
    of failing the job."""
    out = out_dir.rstrip("/")
    review_rec = jsonl.review_records(jsonl.ingest_records(spark, reviews, f"{out}/_parsed/reviews", mode))
    meta_rec = jsonl.metadata_records(jsonl.ingest_records(spark, metadata, f"{out}/_parsed/metadata", mode))
    inter_path = f"{out}/interactions.parquet"
    if on_cast_error == "skip":
        clean.cast_failures(review_rec).write.mode("overwrite").parquet(f"{out}/_quarantine/cast_failures")
    counts_i = sinks.write_observed(clean.clean_interactions(review_rec, on_cast_error=on_cast_error),
                                    inter_path, "interactions")
    stored = spark.read.parquet(inter_path)
    if on_cast_error == "skip":
        clean.item_cast_failures(meta_rec).write.mode("overwrite").parquet(f"{out}/_quarantine/item_cast_failures")
    items = clean.clean_items(meta_rec, stored, on_cast_error=on_cast_error)
    counts_t = sinks.write_observed(items, f"{out}/items.parquet", "items",
                                    [F.count_if(F.length("item_text") == 0).alias("items_without_text")])
    summary = {"interactions": counts_i["rows"], "items": counts_t["rows"],
               "items_without_text": counts_t["items_without_text"]}
    sinks.write_summary(spark.createDataFrame([summary]), f"{out}/preprocessing_summary.json")
    return summary


def gate_and_label(spark: SparkSession, interactions_path: str, items_path: str, out_dir: str,
                   policy: label.LabelPolicy = label.LabelPolicy()) -> dict:
    out = out_dir.rstrip("/")
    inter = spark.read.parquet(interactions_path)
    items = spark.read.parquet(items_path)
    findings = validate.validation_findings(inter, items)
    validate.gate(findings, f"{out}/validation_report.json")
    labeled = label.label_interactions(inter, policy)
    counts = sinks.write_labeled(labeled, f"{out}/interactions_labeled.parquet")
    total, positives = counts["rows"], counts["positives"]
    summary = {"policy": {"positive_rating_threshold": policy.positive_rating_threshold},
               "interactions": total, "positive_interactions": positives,
               "negative_or_neutral_interactions": total - positives,
               "positive_interaction_rate": round(positives / total, 6) if total else 0.0}
    row = ((policy.positive_rating_threshold,), total, positives, total - positives,
           summary["positive_interaction_rate"])
    sinks.write_summary(
        spark.createDataFrame([row], "policy struct<positive_rating_threshold: double>, interactions bigint, "
                                     "positive_interactions bigint, negative_or_neutral_interactions bigint, "
                                     "positive_interaction_rate double"),
        f"{out}/interaction_label_summary.json")
    return summary


def profile_sources(spark: SparkSession, reviews, metadata, mode: str = "failfast",
                    out_dir: str | None = None) -> dict[str, DataFrame]:
    """Profiles as small frames; with ``out_dir`` each is also written as JSON (S6), coverage rounded
    as the report shows it.  The raw files are parsed once and the profiles read what was stored."""
    base = f"{out_dir.rstrip('/')}/_parsed" if out_dir else scratch_path(spark, "parsed")
    r = jsonl.review_records(jsonl.ingest_records(spark, reviews, f"{base}/reviews", mode))
    m = jsonl.metadata_records(jsonl.ingest_records(spark, metadata, f"{base}/metadata", mode))
    frames = {
        "reviews": profile.profile_reviews(r),
        "missing_required_fields": profile.review_missing_fields(r),
        "rating_distribution": profile.raw_rating_histogram(r),
        "metadata": profile.profile_metadata(m),
        "missing_content_fields": profile.metadata_missing_fields(m),
        "join_coverage": profile.join_coverage(r, m),
    }
    if out_dir:
        for name, frame in frames.items():
            if name == "join_coverage":
                frame = frame.withColumn("reviewed_item_metadata_coverage", F.round("reviewed_item_metadata_coverage", 6))
            # the histogram has a row per distinct rating text, which dirty input does not bound
            sinks.write_summary(frame, f"{out_dir.rstrip('/')}/raw_data_inspection/{name}", single=name != "rating_distribution")
    return frames


def explore(interactions: DataFrame, items: DataFrame, top_k: int = 5) -> dict[str, DataFrame]:
    return {
        "summary": eda.dataset_summary(interactions, items),
        "rating_counts": eda.rating_counts(interactions),
        "user_activity": eda.user_activity_histogram(interactions),
        "active_period": eda.active_period(interactions),
        "top_items": eda.top_items(interactions, items, top_k),
    }


def fit_and_encode(training: DataFrame, out_dir: str, *frames: DataFrame) -> list[DataFrame]:
    out = out_dir.rstrip("/")
    users, items = index.fit_encoders(training)
    index.save_mapping(users, f"{out}/user_index.parquet")
    index.save_mapping(items, f"{out}/item_index.parquet")
    spark = training.sparkSession
    users = index.load_mapping(spark, f"{out}/user_index.parquet")
    items = index.load_mapping(spark, f"{out}/item_index.parquet")
    return [index.encode_interactions(f, users, items) for f in frames]
