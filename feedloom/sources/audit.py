"""Source audit (S8, re-aimed): one row per input file.

The single-machine check "first line must be a non-blank record, gzip must
decode" becomes a distributed job: the file listing (``binaryFile`` with only
``path`` and ``length`` selected, so contents are never loaded) left-joined to
per-file line statistics.  Unreadable files are skipped by the text scan
(``ignoreCorruptFiles`` is set on this reader only) and show up with bytes but
no lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.sources.jsonl import parse_lines, read_lines


def source_audit(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    listing = (spark.read.format("binaryFile").load(paths if isinstance(paths, list) else [paths])
               .select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("bytes")))
    parsed = parse_lines(read_lines(spark, paths, ignore_corrupt=True))
    stats = parsed.groupBy("file").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if("blank").alias("blank_lines"),
        F.count_if("malformed").alias("malformed_lines"),
        # Undecodable lines are malformed as well; they name the file's status.
        F.count_if(~F.is_valid_utf8("line")).alias("invalid_utf8_lines"),
        F.count_if(~F.col("blank") & ~F.col("malformed")).alias("records"),
        F.min_by("blank", "ordinal").alias("first_line_blank"),
    )
    audit = listing.join(stats, on="file", how="left")
    lines = F.coalesce(F.col("lines"), F.lit(0))
    status = (F.when((F.col("bytes") > 0) & F.col("lines").isNull(), F.lit("unreadable_or_empty"))
              .when(lines == 0, F.lit("empty"))
              .when(F.col("invalid_utf8_lines") > 0, F.lit("invalid_utf8"))
              .when(F.col("first_line_blank"), F.lit("first_line_blank"))
              .otherwise(F.lit("ok")))
    return audit.select(
        "file", "bytes",
        lines.alias("lines"),
        F.coalesce("records", F.lit(0)).alias("records"),
        F.coalesce("blank_lines", F.lit(0)).alias("blank_lines"),
        F.coalesce("malformed_lines", F.lit(0)).alias("malformed_lines"),
        F.coalesce("invalid_utf8_lines", F.lit(0)).alias("invalid_utf8_lines"),
        status.alias("status"),
        (status == "ok").alias("valid"),
    )
