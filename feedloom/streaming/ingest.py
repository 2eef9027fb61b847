"""Incremental raw ingest: newly arrived JSON-lines files -> parsed records table.

The reference reads finite files; this is the same S1/S2 ingest run as a
Structured Streaming query, so a growing landing folder is parsed exactly once
per file (the file source tracks seen files in its checkpoint) and appended to
the table that ``ingest_records`` writes.  The ordinal gains the micro-batch
id in front, so files that arrive later sort after earlier ones and keep-first
dedup downstream keeps the earliest arrival.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedloom.sources.jsonl import parse_lines


def _append_batch(table_path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        lines = batch.select(
            F.col("value").alias("line"),
            F.col("_metadata.file_path").alias("file"),
            F.struct(
                F.lit(batch_id).cast("bigint").alias("batch"),
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("row"),
            ).alias("ordinal"),
        )
        parsed = parse_lines(lines).where(~F.col("blank")).select("ordinal", "line", "v", "malformed")
        # Each micro-batch owns one partition folder and overwrites it, so a
        # batch replayed after a failure replaces its own output instead of
        # appending a second copy (the sink is idempotent per batch id).
        parsed.write.mode("overwrite").partitionBy("malformed").parquet(f"{table_path}/batch={batch_id}")
    return write


def start_raw_ingest(spark: SparkSession, landing_dir: str, table_path: str, checkpoint_location: str,
                     available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(landing_dir).select("value", "_metadata")
    writer = (stream.writeStream.foreachBatch(_append_batch(table_path))
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_ingested(spark: SparkSession, table_path: str) -> DataFrame:
    """Good records of the ingested table (``ordinal``, ``line``, ``v``)."""
    stored = (spark.read.option("basePath", table_path).parquet(table_path)
              .withColumn("malformed", F.col("malformed").cast("boolean")))
    return stored.where(~F.col("malformed")).select("ordinal", "line", "v")
