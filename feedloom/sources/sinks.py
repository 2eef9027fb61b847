"""Sinks (S3-S6): contract tables to and from parquet, one-row summaries to JSON.

Row counts are gathered with ``Observation`` during the write itself, so no
second job re-reads what was just written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedloom.schemas import missing_columns


def write_observed(df: DataFrame, path: str, name: str, extra=None, partition_by=None) -> dict:
    obs = Observation(name)
    aggs = [F.count(F.lit(1)).alias("rows")] + list(extra or [])
    writer = df.observe(obs, *aggs).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return obs.get


def write_labeled(labeled: DataFrame, path: str) -> dict:
    """S5 (+ A11 counts observed while writing)."""
    return write_observed(labeled, path, "labeled",
                          [F.coalesce(F.sum("is_positive"), F.lit(0)).alias("positives")])


def read_table(spark: SparkSession, path: str, required=()) -> DataFrame:
    """S3 with the contract's required-column check."""
    df = spark.read.parquet(path)
    missing = missing_columns(df.columns, required)
    if missing:
        raise ValueError(f"{path}: missing columns: {', '.join(missing)}")
    return df


def write_summary(summary: DataFrame, path: str, single: bool = True) -> None:
    """A summary frame as JSON; ``single``: of a few rows, in one file."""
    (summary.coalesce(1) if single else summary).write.mode("overwrite").json(path)
