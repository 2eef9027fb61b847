from pyspark.sql import functions as F

from feedloom.functions.time import iso_utc_from_ms
from feedloom.operators.profile import (join_coverage, metadata_missing_fields, profile_metadata,
                                        profile_reviews, raw_rating_histogram, review_missing_fields)
from feedloom.sources.jsonl import metadata_records, read_records, review_records


def _sources(spark, write):
    """Five events of three users on three items (one copy each of two events), four listed items."""
    event = lambda who, what, when: {"user_id": who, "parent_asin": what, "rating": 3, "timestamp": when}
    reviews = review_records(read_records(spark, write("events.jsonl.gz", [
        event("kim", "mug", 86_400_000), event("lee", "mug", 5), event("kim", "mug", 86_400_000),
        event("lee", "mug", 5), event("pat", "jar", 7), event("pat", "tin", 7)])))
    listed = [{"parent_asin": "tin", "title": "Tin", "description": ["d"]}, {"parent_asin": "cup", "features": ["f"], "title": ""},
              {"parent_asin": "mug", "categories": ["c"]}, {"parent_asin": "mug", "title": "Mug"}]
    return reviews, metadata_records(read_records(spark, write("listed.jsonl.gz", listed)))


def test_copies_ids_period_and_coverage_of_sources(spark, write_jsonl_gz):
    reviews, listed = _sources(spark, write_jsonl_gz)
    assert profile_reviews(reviews).first().asDict() == {
        "records": 6, "unique_users": 3, "unique_reviewed_items": 3, "exact_duplicate_events": 2,
        "first_interaction_utc": "1970-01-01T00:00:00.005000+00:00", "last_interaction_utc": "1970-01-02T00:00:00+00:00"}
    c = join_coverage(reviews, listed).first()
    assert (c.reviewed_items_with_metadata, round(c.reviewed_item_metadata_coverage, 6)) == (2, 0.666667)


def test_metadata_counters(spark, write_jsonl_gz):
    _, listed = _sources(spark, write_jsonl_gz)
    assert profile_metadata(listed).first().asDict() == {"records": 4, "unique_metadata_items": 3}
    assert [tuple(r) for r in metadata_missing_fields(listed).collect()] == [
        ("categories", 3), ("description", 3), ("features", 3), ("title", 2)]


def test_instants_are_written_in_utc_with_fractions_only_when_there_are_any(spark):
    times = {-1: "1969-12-31T23:59:59.999000+00:00", 951_782_400_000: "2000-02-29T00:00:00+00:00",
             1_000: "1970-01-01T00:00:01+00:00", 1_001: "1970-01-01T00:00:01.001000+00:00"}
    df = spark.createDataFrame([(t,) for t in times], "t long")
    assert {r.t: r.s for r in df.select("t", iso_utc_from_ms(F.col("t")).alias("s")).collect()} == times


def test_missing_fields_counts_none_and_empty_string_only(spark, write_jsonl_gz):
    reviews = review_records(read_records(spark, write_jsonl_gz("r.jsonl.gz", [
        {"user_id": "", "parent_asin": "i", "rating": 0, "timestamp": "x"},
        {"user_id": None, "parent_asin": "", "rating": None},
        {"user_id": "u", "parent_asin": "i", "rating": "", "timestamp": 1.5},
    ])))
    assert [tuple(r) for r in review_missing_fields(reviews).collect()] == [
        ("parent_asin", 1), ("rating", 2), ("timestamp", 1), ("user_id", 2)]
    p = profile_reviews(reviews).first()
    assert p.first_interaction_utc is None and p.last_interaction_utc is None


def test_rating_histogram_keeps_text_form(spark, write_jsonl_gz):
    reviews = review_records(read_records(spark, write_jsonl_gz("r.jsonl.gz", [
        '{"rating": 5.0}', '{"rating": 5}', '{"rating": 5}', '{"rating": null}', '{"x": 1}'])))
    assert [tuple(r) for r in raw_rating_histogram(reviews).collect()] == [("5", 2), ("5.0", 1)]


def test_duplicates_count_null_keys_as_equal(spark, write_jsonl_gz):
    reviews = review_records(read_records(spark, write_jsonl_gz("r.jsonl.gz", [
        {"user_id": "u"}, {"user_id": "u"}, {"user_id": "u", "timestamp": 1}])))
    assert profile_reviews(reviews).first().exact_duplicate_events == 1


def test_integer_timestamps_only_enter_the_range(spark, write_jsonl_gz):
    reviews = review_records(read_records(spark, write_jsonl_gz("r.jsonl.gz", [
        {"timestamp": 5.0}, {"timestamp": 0}, {"timestamp": 86_400_000}, {"timestamp": "7"}])))
    p = profile_reviews(reviews).first()
    assert p.first_interaction_utc == "1970-01-01T00:00:00+00:00"
    assert p.last_interaction_utc == "1970-01-02T00:00:00+00:00"


def test_profile_of_empty_source_is_zeros(spark, tmp_path):
    import gzip
    path = tmp_path / "empty.jsonl.gz"
    with gzip.open(path, "wt") as f:
        f.write("\n")
    p = profile_reviews(review_records(read_records(spark, str(path)))).first().asDict()
    assert p == {"records": 0, "unique_users": 0, "unique_reviewed_items": 0, "exact_duplicate_events": 0,
                 "first_interaction_utc": None, "last_interaction_utc": None}
