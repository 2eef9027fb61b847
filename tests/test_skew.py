"""A third of all rows on one key: results stay whole and exact."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from feedloom.operators.clean import clean_interactions, clean_items
from feedloom.operators.explore import dataset_summary, top_items
from feedloom.operators.index import encode_interactions, fit_encoders
from feedloom.operators.validate import validation_findings

N = 3000


def _records(spark, parts):
    df = spark.range(N).select(
        F.col("id").alias("ordinal"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), (F.col("id") % 50).cast("string")))
        .alias("user_id"),
        F.when(F.col("id") % 3 == 0, F.lit("i0")).otherwise(F.concat(F.lit("i"), (F.col("id") % 17).cast("string")))
        .alias("parent_asin"),
        (F.col("id") % 5 + 1).cast("double").alias("rating"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 29).cast("bigint").alias("timestamp"))
    return df.repartition(parts)


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_hot_copy_group_keeps_first_and_counts_exactly(spark, parts):
    records = _records(spark, parts)
    pdf = records.toPandas().sort_values("ordinal")
    inter = clean_interactions(records)
    expected = (pdf.drop_duplicates(subset=["user_id", "parent_asin", "timestamp"], keep="first")
                .sort_values(["user_id", "timestamp"], kind="stable"))
    got = inter.select("user_id", "item_id", "rating", "timestamp_ms").collect()
    assert [tuple(r) for r in got] == list(zip(expected.user_id, expected.parent_asin,
                                               expected.rating.astype("float32"), expected.timestamp))
    raw_contract = records.select("user_id", F.col("parent_asin").alias("item_id"),
                                  F.col("rating").cast("float").alias("rating"),
                                  F.col("timestamp").alias("timestamp_ms"),
                                  F.timestamp_millis("timestamp").alias("event_time"))
    items = spark.createDataFrame([("i0", "t")], "item_id string, item_text string")
    got = {r.check: r.affected_rows for r in validation_findings(raw_contract, items).collect()}
    dup = len(pdf) - len(pdf.drop_duplicates(subset=["user_id", "parent_asin", "timestamp"]))
    assert got["duplicate_events"] == dup
    assert got["interaction_item_join"] == int((pdf.parent_asin != "i0").sum())


def test_hot_user_index_and_summary(spark):
    records = _records(spark, 8)
    inter = clean_interactions(records, sort=False)
    users, items = fit_encoders(inter, ["user_id", "timestamp_ms", "ordinal"])
    encoded = encode_interactions(inter, users, items)
    assert encoded.where("user_idx < 0 or item_idx < 0").count() == 0
    assert encoded.count() == inter.count()
    s = dataset_summary(inter, inter.select("item_id").distinct()).first()
    pdf = inter.toPandas()
    assert (s.users, s.items, s.interactions) == (pdf.user_id.nunique(), pdf.item_id.nunique(), len(pdf))
    first = top_items(inter, spark.createDataFrame([("i0", "Hot")], "item_id string, title string"), k=1).first()
    assert (first.item_id, first.title) == ("i0", "Hot")


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_item_keep_first_is_partition_independent(spark, parts):
    meta = spark.range(600).select(
        F.col("id").alias("ordinal"),
        F.concat(F.lit("i"), (F.col("id") % 4).cast("string")).alias("parent_asin"),
        F.concat(F.lit("title "), F.col("id").cast("string")).alias("title")).repartition(parts)
    reviews = spark.createDataFrame([("i0",), ("i1",), ("i2",), ("i3",)], "item_id string")
    got = [(r.item_id, r.title) for r in clean_items(meta, reviews).collect()]
    assert got == [("i0", "title 0"), ("i1", "title 1"), ("i2", "title 2"), ("i3", "title 3")]


def test_hot_unknown_lookups_are_salted_and_still_unmatched(spark):
    from feedloom.operators.index import apply_index, fit_index, invert_index
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mapping = fit_index(spark.createDataFrame([(0, "a"), (1, "b")], "ordinal long, v string"), "v", ["ordinal"])
        df = spark.range(4000).select(
            F.when(F.col("id") % 3 == 0, F.lit("a")).otherwise(F.lit(None)).alias("v")).repartition(8)
        enc = apply_index(df, mapping, "v", "i")
        plan = enc._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
        got = {(r.v, r.i): r.n for r in enc.groupBy("v", "i").agg(F.count(F.lit(1)).alias("n")).collect()}
        assert got == {("a", 0): 1334, (None, -1): 2666}
        dec = invert_index(enc, mapping, "i", "back")
        assert dec.where("back is null").count() == 2666 and dec.where("back = 'a'").count() == 1334
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
