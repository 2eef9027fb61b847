import pytest

from feedloom.operators.clean import clean_interactions, clean_items
from feedloom.sources.jsonl import metadata_records, read_records, review_records


def _reviews(spark, write, records, name="reviews.jsonl.gz"):
    return review_records(read_records(spark, write(name, records)))


def _vote(who, what, stars, when, **more):
    return {"user_id": who, "parent_asin": what, "rating": stars, "timestamp": when, **more}


def test_one_event_per_user_item_time_and_ordered_output(spark, write_jsonl_gz):
    """Three copies of one event (the first wins), the same pair at another time, another user."""
    rows = clean_interactions(_reviews(spark, write_jsonl_gz, [
        _vote("zoe", "lamp", 2.0, 900, helpful_vote=7),
        _vote("ann", "desk", 1.0, 400, helpful_votes=3),
        _vote("zoe", "lamp", 2.0, 900, helpful_vote=8),
        _vote("zoe", "lamp", 4.0, 100, verified_purchase=True),
        _vote("zoe", "lamp", 3.0, 900),
    ])).collect()
    assert [(r.user_id, r.timestamp_ms, r.rating, r.helpful_votes) for r in rows] == [
        ("ann", 400, 1.0, 3), ("zoe", 100, 4.0, 0), ("zoe", 900, 2.0, 7)]


def test_item_text_joins_fields_and_only_reviewed_items_stay(spark, write_jsonl_gz):
    reviews = _reviews(spark, write_jsonl_gz, [_vote("u", "lamp", 5, 1), _vote("u", "rug", 4, 2), _vote("u", "ghost", 3, 3)])
    meta = metadata_records(read_records(spark, write_jsonl_gz("meta.jsonl.gz", [
        {"parent_asin": "rug", "description": "woven\t by\nhand", "features": ["", "two  tone"]},
        {"parent_asin": "chair", "title": "never reviewed"},
        {"parent_asin": "lamp", "title": " Reading lamp", "store": "Lumen & Co ", "price": 31.25, "rating_number": 4},
    ])))
    rows = clean_items(meta, clean_interactions(reviews)).collect()
    assert [(r.item_id, r.item_text, r.price, r.rating_number) for r in rows] == [
        ("lamp", "Reading lamp Lumen & Co", 31.25, 4), ("rug", "woven by hand two tone", None, None)]


def test_a_bad_value_in_a_dropped_copy_does_not_matter(spark, write_jsonl_gz):
    reviews = clean_interactions(_reviews(spark, write_jsonl_gz, [_vote("u", "lamp", 5, 1)]))
    records = [{"parent_asin": "lamp", "title": "first", "price": 3}, {"parent_asin": "lamp", "title": "second", "price": "from 5"}]
    meta = metadata_records(read_records(spark, write_jsonl_gz("m1.jsonl.gz", records)))
    assert [(r.title, r.price) for r in clean_items(meta, reviews).collect()] == [("first", 3.0)]
    turned = metadata_records(read_records(spark, write_jsonl_gz("m2.jsonl.gz", records[::-1])))
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        clean_items(turned, reviews).collect()
    assert [r.title for r in clean_items(turned, reviews, on_cast_error="skip").collect()] == ["first"]


def test_keep_first_follows_input_order_not_values(spark, write_jsonl_gz):
    records = [
        {"user_id": "u", "parent_asin": "i", "rating": 1.0, "timestamp": 5, "helpful_vote": 9},
        {"user_id": "u", "parent_asin": "i", "rating": 5.0, "timestamp": 5, "helpful_vote": 1},
    ]
    rows = clean_interactions(_reviews(spark, write_jsonl_gz, records)).collect()
    assert [(r.rating, r.helpful_votes) for r in rows] == [(1.0, 9)]


def test_keep_first_items(spark, write_jsonl_gz):
    reviews = _reviews(spark, write_jsonl_gz, [{"user_id": "u", "parent_asin": "a", "rating": 3, "timestamp": 1}])
    meta = metadata_records(read_records(spark, write_jsonl_gz("m.jsonl.gz", [
        {"parent_asin": "a", "title": "first"}, {"parent_asin": "a", "title": "second"}])))
    rows = clean_items(meta, clean_interactions(reviews)).collect()
    assert [(r.item_id, r.title) for r in rows] == [("a", "first")]


def test_rows_missing_required_fields_are_dropped_but_empty_strings_stay(spark, write_jsonl_gz):
    records = [
        {"user_id": "", "parent_asin": "i", "rating": 4, "timestamp": 1},
        {"user_id": None, "parent_asin": "i", "rating": 4, "timestamp": 1},
        {"parent_asin": "i", "rating": 4, "timestamp": 2},
        {"user_id": "u", "parent_asin": "i", "timestamp": 3},
        {"user_id": "u", "parent_asin": "i", "rating": 4},
        {"user_id": "u", "parent_asin": "i", "rating": "5", "timestamp": 4, "helpful_votes": 7},
    ]
    rows = clean_interactions(_reviews(spark, write_jsonl_gz, records)).collect()
    assert [(r.user_id, r.rating, r.timestamp_ms, r.helpful_votes) for r in rows] == [
        ("", 4.0, 1, 0), ("u", 5.0, 4, 7)]


def test_event_time_is_utc(spark, write_jsonl_gz):
    rows = clean_interactions(_reviews(spark, write_jsonl_gz, [
        {"user_id": "u", "parent_asin": "i", "rating": 4, "timestamp": 86_400_000}])).selectExpr(
        "cast(unix_millis(event_time) as bigint) as ms").collect()
    assert rows[0].ms == 86_400_000


def test_typed_records_clean_to_contract_types(spark):
    df = spark.createDataFrame(
        [(1, "u", "i", 4.0, "4.0", 10, 10, 10, True, None)],
        "ordinal long, user_id string, parent_asin string, rating double, rating_text string, "
        "timestamp long, timestamp_int long, timestamp_key long, verified_purchase boolean, helpful_vote int")
    out = clean_interactions(df)
    types = dict(out.dtypes)
    assert types["rating"] == "float" and types["timestamp_ms"] == "bigint"
    assert types["helpful_votes"] == "int" and types["event_time"] == "timestamp"
