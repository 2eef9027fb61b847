import pytest
from pyspark.sql import functions as F

from feedloom.operators.label import LabelPolicy, label_interactions, label_summary


def _frame(spark, ratings, times):
    rows = [("user-1", f"item-{i + 1}", r, t) for i, (r, t) in enumerate(zip(ratings, times))]
    df = spark.createDataFrame(rows, "user_id string, item_id string, rating float, timestamp_ms long")
    return df.withColumn("event_time", F.to_timestamp(F.lit("2024-01-02 00:00:00")))


def test_ratings_at_the_threshold_are_positive_and_rows_are_in_time_order(spark):
    labeled = label_interactions(_frame(spark, [3.5, 2.0, 3.4], [30, 20, 10]), LabelPolicy(3.5))
    assert [(r.timestamp_ms, r.is_positive) for r in labeled.collect()] == [(10, 0), (20, 0), (30, 1)]
    assert {str(r.event_date) for r in labeled.collect()} == {"2024-01-02"}
    assert label_summary(labeled).first().asDict() == {
        "interactions": 3, "positive_interactions": 1, "negative_or_neutral_interactions": 2, "positive_interaction_rate": 1 / 3}


@pytest.mark.parametrize("threshold", [0.99, 5.01, -4.0, float("inf"), float("nan")])
def test_thresholds_outside_the_scale_are_refused(threshold):
    with pytest.raises(ValueError, match="between 1.0 and 5.0"):
        LabelPolicy(threshold)


@pytest.mark.parametrize("threshold", [1.0, 5.0])
def test_the_ends_of_the_scale_are_thresholds(threshold):
    assert LabelPolicy(threshold).positive_rating_threshold == threshold


def test_nan_and_null_are_not_positive_and_float_threshold_compares_as_float(spark):
    labeled = label_interactions(_frame(spark, [float("nan"), None, 4.1], [1, 2, 3]), LabelPolicy(4.1))
    assert [r.is_positive for r in labeled.collect()] == [0, 0, 1]


def test_event_date_is_utc_whatever_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([("u", "i", 4.0, 1)], "user_id string, item_id string, rating float, timestamp_ms long")
        df = df.withColumn("event_time", F.timestamp_millis(F.lit(3_600_000).cast("bigint")))
        assert str(label_interactions(df).first().event_date) == "1970-01-01"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_missing_columns_and_empty_summary(spark):
    with pytest.raises(ValueError, match="missing columns: event_time"):
        label_interactions(spark.createDataFrame([("u", "i", 1.0, 1)],
                                                 "user_id string, item_id string, rating float, timestamp_ms long"))
    empty = label_interactions(_frame(spark, [], []))
    assert label_summary(empty).first().asDict() == {
        "interactions": 0, "positive_interactions": 0,
        "negative_or_neutral_interactions": 0, "positive_interaction_rate": 0.0}
