import json

import pytest

from feedloom.operators.validate import ValidationError
from feedloom.plans.build import build_tables, explore, fit_and_encode, gate_and_label, profile_sources
from feedloom.sources.jsonl import review_records
from feedloom.operators.clean import clean_interactions
from feedloom.streaming.ingest import read_ingested, start_raw_ingest


def _raw(write):
    reviews = write("reviews.jsonl.gz", [
        {"user_id": "u1", "parent_asin": "a", "rating": 5.0, "timestamp": 3_000, "helpful_vote": 1},
        {"user_id": "u1", "parent_asin": "a", "rating": 5.0, "timestamp": 3_000, "helpful_vote": 1},
        {"user_id": "u2", "parent_asin": "b", "rating": 2.0, "timestamp": 1_000},
        {"user_id": "u1", "parent_asin": "b", "rating": 4.0, "timestamp": 2_000},
    ])
    meta = write("meta.jsonl.gz", [
        {"parent_asin": "a", "title": " Alpha ", "description": ["x"], "features": [], "categories": ["c"]},
        {"parent_asin": "b", "title": "Beta", "store": "S"},
        {"parent_asin": "z", "title": "unused"},
    ])
    return reviews, meta


def test_build_gate_label_explore_encode(spark, tmp_path, write_jsonl_gz):
    reviews, meta = _raw(write_jsonl_gz)
    out = str(tmp_path / "out")
    summary = build_tables(spark, reviews, meta, out)
    assert summary == {"interactions": 3, "items": 2, "items_without_text": 0}
    inter = spark.read.parquet(f"{out}/interactions.parquet")
    assert [(r.user_id, r.item_id) for r in inter.collect()] == [("u1", "b"), ("u1", "a"), ("u2", "b")]
    labels = gate_and_label(spark, f"{out}/interactions.parquet", f"{out}/items.parquet", out)
    assert labels["interactions"] == 3 and labels["positive_interactions"] == 2
    assert labels["positive_interaction_rate"] == round(2 / 3, 6)
    written = spark.read.json(f"{out}/interaction_label_summary.json").first()
    assert written.policy.positive_rating_threshold == 4.0 and written.positive_interactions == 2
    eda = explore(inter, spark.read.parquet(f"{out}/items.parquet"))
    assert eda["summary"].first().users == 2
    assert [r.item_id for r in eda["top_items"].collect()] == ["b", "a"]
    (encoded,) = fit_and_encode(inter, out, inter)
    got = sorted((r.user_id, r.item_id, r.user_idx, r.item_idx) for r in encoded.collect())
    assert got == [("u1", "a", 0, 1), ("u1", "b", 0, 0), ("u2", "b", 1, 0)]


def test_gate_fails_on_invalid_tables(spark, tmp_path):
    inter = spark.createDataFrame([("u", "a", 9.0, 1)], "user_id string, item_id string, rating float, timestamp_ms long")
    inter = inter.selectExpr("*", "timestamp_millis(timestamp_ms) as event_time")
    inter.write.parquet(str(tmp_path / "i"))
    spark.createDataFrame([("a", "t")], "item_id string, item_text string").write.parquet(str(tmp_path / "t"))
    with pytest.raises(ValidationError):
        gate_and_label(spark, str(tmp_path / "i"), str(tmp_path / "t"), str(tmp_path / "o"))
    report = spark.read.json(str(tmp_path / "o" / "validation_report.json" / "issues")).collect()
    assert [r.check for r in report] == ["rating_range"]
    summary = spark.read.json(str(tmp_path / "o" / "validation_report.json" / "summary")).first()
    assert (summary.is_valid, summary.errors, summary.warnings) == (False, 1, 0)


def test_profile_sources(spark, tmp_path, write_jsonl_gz):
    reviews, meta = _raw(write_jsonl_gz)
    p = profile_sources(spark, reviews, meta, out_dir=str(tmp_path / "prof"))
    assert spark.read.json(str(tmp_path / "prof" / "raw_data_inspection" / "reviews")).first().records == 4
    assert p["reviews"].first().exact_duplicate_events == 1
    assert p["join_coverage"].first().reviewed_item_metadata_coverage == 1.0


def test_streaming_ingest_appends_new_files_in_arrival_order(spark, tmp_path):
    import gzip
    landing = tmp_path / "landing"
    landing.mkdir()

    def drop(name, recs):
        with gzip.open(landing / name, "wt") as f:
            for r in recs:
                f.write((r if isinstance(r, str) else json.dumps(r)) + "\n")

    table, ckpt = str(tmp_path / "table"), str(tmp_path / "ckpt")
    drop("b1.jsonl.gz", [{"user_id": "u", "parent_asin": "a", "rating": 1, "timestamp": 5}])
    start_raw_ingest(spark, str(landing), table, ckpt).awaitTermination()
    drop("a2.jsonl.gz", [{"user_id": "u", "parent_asin": "a", "rating": 5, "timestamp": 5},
                         {"user_id": "u", "parent_asin": "c", "rating": 4, "timestamp": 6}, "{bad"])
    start_raw_ingest(spark, str(landing), table, ckpt).awaitTermination()
    records = read_ingested(spark, table)
    assert records.count() == 3
    rows = clean_interactions(review_records(records)).collect()
    # the copy that arrived first (rating 1) wins although its file sorts later by name
    assert [(r.item_id, r.rating) for r in rows] == [("a", 1.0), ("c", 4.0)]


def test_streaming_batch_replay_is_idempotent(spark, tmp_path):
    import gzip
    from feedloom.streaming.ingest import _append_batch
    landing = tmp_path / "l"
    landing.mkdir()
    with gzip.open(landing / "x.jsonl.gz", "wt") as f:
        f.write('{"user_id": "u", "parent_asin": "a", "rating": 1, "timestamp": 5}\n')
    batch = spark.read.text(str(landing)).select("value", "_metadata")
    write = _append_batch(str(tmp_path / "t"))
    write(batch, 0)
    write(batch, 0)  # replay of the same micro-batch
    assert read_ingested(spark, str(tmp_path / "t")).count() == 1


def test_build_can_quarantine_uncastable_rows(spark, tmp_path, write_jsonl_gz):
    reviews = write_jsonl_gz("r.jsonl.gz", [
        {"user_id": "u", "parent_asin": "a", "rating": "five", "timestamp": 1},
        {"user_id": "u", "parent_asin": "a", "rating": 5, "timestamp": 2},
    ])
    meta = write_jsonl_gz("m.jsonl.gz", [{"parent_asin": "a", "title": "A"}])
    out = str(tmp_path / "out")
    with pytest.raises(Exception):
        build_tables(spark, reviews, meta, str(tmp_path / "strict"))
    summary = build_tables(spark, reviews, meta, out, on_cast_error="skip")
    assert summary["interactions"] == 1
    bad = spark.read.parquet(f"{out}/_quarantine/cast_failures").collect()
    assert [tuple(r.failed_fields) for r in bad] == [("rating",)]
