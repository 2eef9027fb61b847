"""Raw JSON-lines source (S1, S2) and record projections (P1 inputs).

* Lines are read with ``spark.read.text`` (gzip is decoded transparently; a
  gzip file is one split, so large raw inputs should arrive as many files).
* Input order (S2) is ``struct(file_path, file_block_start, row id)``: the
  split start orders blocks of one file, and ``monotonically_increasing_id``
  orders lines inside a split.  It is computed once, at ingest, and persisted.
* Each non-blank line is parsed once with ``try_parse_json`` into a VARIANT.
  A line that is not a JSON object is *malformed*: ``mode="failfast"`` raises
  ``ValueError("Invalid JSON at <file>:<line>")`` naming the first one;
  ``mode="permissive"`` keeps going and ``quarantine()`` returns those lines.
"""

from __future__ import annotations

import os
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import messages
from feedloom.functions.text import has_text


def read_lines(spark: SparkSession, paths: str | list[str], ignore_corrupt: bool = False) -> DataFrame:
    reader = spark.read
    if ignore_corrupt:
        reader = reader.option("ignoreCorruptFiles", "true")
    raw = reader.text(paths if isinstance(paths, list) else [paths])
    return raw.select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("ordinal"),
    )


def parse_lines(lines: DataFrame) -> DataFrame:
    """Add ``blank``, ``v`` (VARIANT) and ``malformed`` to a line frame."""
    blank = ~has_text(F.col("line"))
    v = F.when(~blank, F.try_parse_json(F.col("line")))
    parsed = lines.select("*", blank.alias("blank"), v.alias("v"))
    is_object = F.coalesce(F.schema_of_variant(F.col("v")).startswith("OBJECT"), F.lit(False))
    readable = is_object & F.is_valid_utf8("line")  # the text reader passes undecodable bytes through
    return parsed.select("*", (~F.col("blank") & ~readable).alias("malformed"))


def first_bad_line(spark: SparkSession, file: str) -> int | None:
    """1-based number of the first malformed line of one file (blank lines count).

    Only that file is read, in one plan: ordinals of another job may number the
    same lines otherwise.  Lines of a block are numbered without gaps, so a row
    per block (file size / split size of them) tells where the line is.
    """
    parsed = parse_lines(read_lines(spark, unquote(file)))
    blocks = parsed.groupBy(F.col("ordinal.block").alias("block")).agg(
        F.count(F.lit(1)).alias("lines"), F.min("ordinal.row").alias("first"),
        F.min(F.when(F.col("malformed"), F.col("ordinal.row"))).alias("bad"))
    before = 0
    for b in blocks.orderBy("block").collect():
        if b["bad"] is not None:
            return before + b["bad"] - b["first"] + 1
        before += b["lines"]
    return None


def _raise_malformed(spark: SparkSession, ordinal) -> None:
    file = ordinal["file"]
    raise ValueError(messages.INVALID_JSON.format(file=os.path.basename(unquote(file)), line=first_bad_line(spark, file)))


def first_malformed(parsed: DataFrame):
    row = parsed.where("malformed").agg(F.min("ordinal").alias("o")).first()
    return row["o"] if row else None


def read_records(spark: SparkSession, paths: str | list[str], mode: str = "failfast") -> DataFrame:
    """One row per JSON object line: ``ordinal``, ``line``, ``v``.

    ``failfast`` runs one check job before returning (the lazy frame is then
    safe to plan on); ``permissive`` returns immediately.
    """
    if mode not in ("failfast", "permissive"):
        raise ValueError("mode must be 'failfast' or 'permissive'")
    parsed = parse_lines(read_lines(spark, paths))
    if mode == "failfast":
        bad = first_malformed(parsed)
        if bad is not None:
            _raise_malformed(spark, bad)
    return parsed.where(~F.col("blank") & ~F.col("malformed")).select("ordinal", "line", "v")


def ingest_records(spark: SparkSession, paths: str | list[str], out_path: str,
                   mode: str = "failfast") -> DataFrame:
    """Parse the raw files once and persist them (the lineage cut for later jobs).

    One pass writes every non-blank line, partitioned by ``malformed``; the
    check then reads only the (small) malformed partition.  Returns the good
    records read back from storage.
    """
    parsed = parse_lines(read_lines(spark, paths)).where(~F.col("blank")).select("ordinal", "line", "v", "malformed")
    parsed.write.mode("overwrite").partitionBy("malformed").parquet(out_path)
    stored = spark.read.parquet(out_path).withColumn("malformed", F.col("malformed").cast("boolean"))
    if mode == "failfast":
        bad = first_malformed(stored)
        if bad is not None:
            _raise_malformed(spark, bad)
    return stored.where(~F.col("malformed")).select("ordinal", "line", "v")


def quarantine(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Malformed non-blank lines with their file and ordinal."""
    return parse_lines(read_lines(spark, paths)).where("malformed").select("file", "ordinal", "line")


def _field(name: str) -> Column:
    """A top-level field as VARIANT, with JSON null turned into SQL NULL."""
    x = F.try_variant_get(F.col("v"), f"$.{name}", "variant")
    return F.when(~F.is_variant_null(x), x)


def _text_field(name: str) -> Column:
    return F.try_variant_get(_field(name), "$", "string")


def review_records(records: DataFrame) -> DataFrame:
    """Review record frame (see ``feedloom.schemas``) from parsed JSON records."""
    ts = _field("timestamp")
    return records.select(
        "ordinal",
        _text_field("user_id").alias("user_id"),
        _text_field("parent_asin").alias("parent_asin"),
        _field("rating").alias("rating"),
        # The rating as written in the line ('5.0' and '5' stay apart).
        F.get_json_object(F.col("line"), "$.rating").alias("rating_text"),
        ts.alias("timestamp"),
        F.when(F.schema_of_variant(ts) == "BIGINT", F.try_variant_get(ts, "$", "bigint")).alias("timestamp_int"),
        F.to_json(ts).alias("timestamp_key"),
        _field("verified_purchase").alias("verified_purchase"),
        _field("helpful_vote").alias("helpful_vote"),
        _field("helpful_votes").alias("helpful_votes"),
    )


def metadata_records(records: DataFrame) -> DataFrame:
    """Metadata record frame from parsed JSON records (content fields stay VARIANT)."""
    return records.select(
        "ordinal",
        _text_field("parent_asin").alias("parent_asin"),
        *[_field(f).alias(f) for f in ("title", "description", "features", "store", "categories",
                                        "price", "average_rating", "rating_number")],
    )
