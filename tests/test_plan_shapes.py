"""Physical-plan checks for the scale properties the operators rely on."""

import re

from pyspark.sql import functions as F

from feedloom.operators.clean import clean_interactions
from feedloom.operators.dedup import keep_first
from feedloom.operators.explore import dataset_summary, top_items
from feedloom.operators.validate import validation_findings


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def _events(spark, n=2000):
    df = spark.range(n).select(
        F.col("id").alias("ordinal"),
        F.concat(F.lit("u"), (F.col("id") % 7).cast("string")).alias("user_id"),
        F.concat(F.lit("i"), (F.col("id") % 11).cast("string")).alias("item_id"),
        (F.col("id") % 5 + 1).cast("float").alias("rating"),
        (F.col("id") % 13).alias("timestamp_ms"))
    return df.withColumn("event_time", F.timestamp_millis("timestamp_ms"))


def test_keep_first_limits_groups_before_the_shuffle(spark):
    plan = _plan(keep_first(_events(spark), ["user_id", "item_id", "timestamp_ms"], ["ordinal"]))
    assert "Partial" in plan and "Final" in plan
    # the partial limit sits below (after, in the text) the hash exchange
    assert plan.rfind("Partial") > plan.find("Exchange hashpartitioning")


def test_contract_sort_breaks_ties_with_the_ordinal(spark):
    df = _events(spark).select("ordinal", "user_id", F.col("item_id").alias("parent_asin"), "rating",
                               F.col("timestamp_ms").alias("timestamp"))
    plan = _plan(clean_interactions(df))
    m = re.search(r"rangepartitioning\(([^)]*)\)", plan)
    assert m and "user_id" in m.group(1) and "ordinal" in m.group(1)


def test_validation_reads_each_table_once(spark, tmp_path):
    _events(spark).write.parquet(str(tmp_path / "i"))
    spark.range(5).selectExpr("concat('i', id) as item_id", "'t' as item_text").write.parquet(str(tmp_path / "t"))
    plan = _plan(validation_findings(spark.read.parquet(str(tmp_path / "i")), spark.read.parquet(str(tmp_path / "t"))))
    scans = re.findall(r"FileScan parquet [^\n]*Location: InMemoryFileIndex\(1 paths\)\[([^\]]*)\]", plan)
    assert len(scans) == 2, scans


def test_top_items_never_moves_the_item_table(spark, tmp_path):
    spark.range(50).selectExpr("concat('i', id) as item_id", "concat('t', id) as title").write.parquet(
        str(tmp_path / "items"))
    plan = _plan(top_items(_events(spark), spark.read.parquet(str(tmp_path / "items")), k=3))
    item_scan = [line for line in plan.split("\n") if "FileScan" in line and "title" in line]
    assert item_scan
    lines = plan.split("\n")
    idx = next(i for i, line in enumerate(lines) if "FileScan" in line and "title" in line)
    # nothing between the item scan and the semi join shuffles or broadcasts it
    above = [line for line in lines[:idx] if line.strip()]
    nearest = [line for line in reversed(above) if "Join" in line or "Exchange" in line][0]
    assert "LeftSemi" in nearest


def test_summary_branches_read_only_their_columns(spark, tmp_path):
    _events(spark).write.parquet(str(tmp_path / "i"))
    inter = spark.read.parquet(str(tmp_path / "i"))
    plan = _plan(dataset_summary(inter, inter.select("item_id")))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert "struct<user_id:string>" in schemas and "struct<item_id:string>" in schemas
    assert all("ordinal" not in s for s in schemas)
