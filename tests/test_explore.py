from pyspark.sql import functions as F

from feedloom.operators.explore import (active_period, dataset_summary, rating_counts, round_summary, top_items,
                                        user_activity_histogram)


def _interactions(spark, rows):
    df = spark.createDataFrame(rows, "user_id string, item_id string, rating float, timestamp_ms long")
    return df.withColumn("event_time", F.timestamp_millis("timestamp_ms"))


def test_summary_of_a_sparse_matrix(spark):
    """Seven events on five of twelve cells, three of them by one user on one item."""
    rows = [("kim", "mug", 5.0, t) for t in (1, 2, 3)] + [("kim", "jar", 1.0, 4), ("lee", "jar", 4.0, 5), ("lee", "tin", 2.0, 6), ("pat", "cup", 3.0, 7)]
    listed = spark.createDataFrame([("mug",), ("jar",), ("tin",), ("cup",), ("pan",)], "item_id string")
    s = round_summary(dataset_summary(_interactions(spark, rows), listed).first().asDict())
    assert (s["interactions"], s["metadata_items"], s["mean_rating"]) == (7, 5, 3.571)
    assert s["positive_interaction_rate"] == 0.5714
    assert abs(s["matrix_density"] - 7 / 12) < 1e-9 and abs(s["sparsity"] - 5 / 12) < 1e-9


def test_empty_summary_gives_nulls_not_errors(spark):
    inter = _interactions(spark, [])
    s = dataset_summary(inter, spark.createDataFrame([], "item_id string")).first()
    assert s.interactions == 0 and s.matrix_density is None and s.mean_rating is None


def test_distributions_period_and_top_items(spark):
    rows = ([("u1", "b", 5.0, 86_400_000 * 3)] * 3 + [("u2", "a", 1.0, 0)] * 3
            + [("u3", "c", float("nan"), 10)] + [(f"u{i}", "z", 4.0, 10) for i in range(12)])
    inter = _interactions(spark, rows)
    assert [tuple(r) for r in rating_counts(inter).collect()] == [(1.0, 3), (4.0, 12), (5.0, 3)]
    assert [tuple(r) for r in user_activity_histogram(inter, clip=2).collect()] == [(1, 9), (2, 3)]
    p = active_period(inter).first()
    assert (str(p.active_start), str(p.active_end)) == ("1970-01-01", "1970-01-04")
    items = spark.createDataFrame([("a", ""), ("b", "Bee")], "item_id string, title string")
    got = [tuple(r) for r in top_items(inter, items, k=3).collect()]
    assert got == [("z", "Untitled product", 12), ("a", "Untitled product", 3), ("b", "Bee", 3)]


def test_distinct_counts_leave_nulls_out(spark):
    inter = _interactions(spark, [("u1", "a", 5.0, 1), (None, "a", 4.0, 2), ("u1", None, 3.0, 3)])
    s = dataset_summary(inter, spark.createDataFrame([("a",)], "item_id string")).first()
    assert (s.interactions, s.users, s.items) == (3, 1, 1)
