
import json

import pytest
from pyspark.sql import functions as F

from feedloom.operators.clean import clean_interactions, clean_items
from feedloom.sources.jsonl import metadata_records, quarantine, read_records, review_records


def test_present_but_null_helpful_vote_becomes_zero(spark, write_jsonl_gz):
    path = write_jsonl_gz("r.jsonl.gz", [
        {"user_id": "u", "parent_asin": "a", "rating": 4, "timestamp": 1, "helpful_vote": None},
        {"user_id": "u", "parent_asin": "b", "rating": 4, "timestamp": 2, "helpful_votes": 3},
        {"user_id": "u", "parent_asin": "c", "rating": 4, "timestamp": 3, "helpful_vote": 5, "helpful_votes": 9},
    ])
    rows = clean_interactions(review_records(read_records(spark, path))).collect()
    assert [r.helpful_votes for r in rows] == [0, 3, 5]


def test_unparsable_rating_fails_the_job(spark, write_jsonl_gz):
    path = write_jsonl_gz("r.jsonl.gz", [{"user_id": "u", "parent_asin": "a", "rating": "abc", "timestamp": 1}])
    with pytest.raises(Exception):
        clean_interactions(review_records(read_records(spark, path))).collect()


def test_nan_and_duplicate_keys_are_quarantined(spark, write_jsonl_gz):
    path = write_jsonl_gz("r.jsonl.gz", ['{"rating": NaN}', '{"a": 1, "a": 2}', '{"a": 3}', "null", "[1]"])
    assert read_records(spark, path, mode="permissive").count() == 1
    assert quarantine(spark, path).count() == 4


def test_empty_inputs_give_empty_typed_tables(spark, tmp_path):
    empty = tmp_path / "empty.jsonl.gz"
    import gzip
    with gzip.open(empty, "wt") as f:
        f.write("")
    records = review_records(read_records(spark, str(empty)))
    inter = clean_interactions(records)
    assert inter.count() == 0
    assert dict(inter.dtypes)["rating"] == "float"
    items = clean_items(metadata_records(read_records(spark, str(empty))), inter)
    assert items.count() == 0 and "item_text" in items.columns


def test_input_order_survives_many_splits_of_one_file(spark, tmp_path):
    path = tmp_path / "big.jsonl"
    with open(path, "w") as f:
        for i in range(3000):
            f.write(json.dumps({"n": i, "pad": "x" * (i % 50)}) + "\n")
            if i % 97 == 0:
                f.write("\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        records = read_records(spark, str(path))
        assert records.rdd.getNumPartitions() > 4
        got = [r.n for r in records.select("ordinal", F.expr("variant_get(v, '$.n', 'int')").alias("n"))
               .orderBy("ordinal").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == list(range(3000))


def test_failfast_line_number_across_splits(spark, tmp_path):
    path = tmp_path / "split.jsonl"
    lines = [json.dumps({"n": i, "pad": "y" * 40}) for i in range(2000)]
    lines[1500] = "{not json"
    lines.insert(10, "")
    path.write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        with pytest.raises(ValueError, match=r"Invalid JSON at split.jsonl:1502$"):
            read_records(spark, str(path))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_cast_quarantine_lists_bad_rows_and_skip_mode_leaves_them_out(spark, write_jsonl_gz):
    from feedloom.operators.clean import cast_failures, item_cast_failures
    path = write_jsonl_gz("r.jsonl.gz", [
        {"user_id": "u", "parent_asin": "a", "rating": "abc", "timestamp": 1},
        {"user_id": "u", "parent_asin": "b", "rating": 4, "timestamp": "later"},
        {"user_id": "u", "parent_asin": "c", "rating": "5", "timestamp": 3},
    ])
    records = review_records(read_records(spark, path))
    bad = sorted((r.parent_asin, tuple(r.failed_fields)) for r in cast_failures(records).collect())
    assert bad == [("a", ("rating",)), ("b", ("timestamp",))]
    rows = clean_interactions(records, on_cast_error="skip").collect()
    assert [(r.item_id, r.rating) for r in rows] == [("c", 5.0)]
    meta = metadata_records(read_records(spark, write_jsonl_gz("m.jsonl.gz", [
        {"parent_asin": "a", "price": "n/a"}, {"parent_asin": "b", "price": 2.5}])))
    assert [r.parent_asin for r in item_cast_failures(meta).collect()] == ["a"]
