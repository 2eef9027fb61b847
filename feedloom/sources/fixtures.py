"""Record views over the driver tables in ``/root/testdata/sf*/``.

They turn the star-schema tables into the shapes this toolkit ingests, using
only deterministic expressions over whole tables (no rows are dropped):

* ``raw_events``  - review records from ``events`` (ordinal ``event_id``);
  blank user ids, null ratings and missing helpful votes are injected by value
  rules so cleaning and profiling have real work; ``timestamp`` is the day of
  ``ts`` so (user, item, timestamp) repeats occur naturally.  Error events
  point at retired catalogue ids (``r<k>``), so join coverage is below 1.
* ``raw_items``   - metadata records from ``part``: padded titles with Unicode
  spaces, list descriptions with empty parts, some null stores and titles.
* ``raw_lines``   - review records from ``lineitem`` joined to ``orders``
  (bench size); ordinal ``(l_orderkey, l_linenumber, l_partkey, l_suppkey)``.
* ``dirty_interactions`` / ``dirty_items`` - uncleaned contract-shaped tables
  with out-of-range ratings, zero timestamps, null and duplicate item ids and
  blank texts, for the validation rules.

The same views are written in DuckDB SQL in ``feedloom.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.time import event_time_from_ms

# Fixed mapping from event type to a star rating for the review view.
EVENT_RATING = {"purchase": 5, "signup": 4, "click": 3, "view": 2, "error": 1}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _epoch_ms(ntz: Column) -> Column:
    return F.unix_millis(ntz.cast("timestamp"))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events")
    event_id = F.col("event_id")
    kind = F.col("event_type")
    rating = None
    for name, stars in EVENT_RATING.items():
        rating = (F.when(kind == name, F.lit(float(stars))) if rating is None
                  else rating.when(kind == name, F.lit(float(stars))))
    rating = F.when(event_id % 97 == 0, F.lit(None).cast("double")).otherwise(rating)
    ts = _epoch_ms(F.date_trunc("day", F.col("ts").cast("timestamp")))
    k = F.get_json_object("props", "$.k")
    return e.select(
        event_id.alias("ordinal"),
        F.when(event_id % 101 == 0, F.lit("")).otherwise(F.concat(F.lit("u"), F.col("user_id").cast("string")))
        .alias("user_id"),
        F.concat(F.when(kind == "error", F.lit("r")).otherwise(F.lit("i")), k).alias("parent_asin"),
        rating.alias("rating"),
        rating.cast("string").alias("rating_text"),
        ts.alias("timestamp"),
        ts.alias("timestamp_int"),
        ts.alias("timestamp_key"),
        (kind == "purchase").alias("verified_purchase"),
        F.when(kind == "error", F.lit(None).cast("int")).otherwise((event_id % 7).cast("int")).alias("helpful_vote"),
    )


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part")
    key = F.col("p_partkey")
    padded = F.concat(F.lit("\u3000 "), F.replace(F.col("p_name"), F.lit(" "), F.lit(" \u00a0")), F.lit("\n"))
    return p.select(
        key.alias("ordinal"),
        F.concat(F.lit("i"), key.cast("string")).alias("parent_asin"),
        F.when(F.col("p_size") == 1, F.lit("")).otherwise(padded).alias("title"),
        F.array(F.col("p_type"), F.lit(""), F.col("p_brand")).alias("description"),
        F.array(F.col("p_name")).alias("features"),
        F.when(key % 10 == 0, F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("store"),
        F.when(F.col("p_size") > 25, F.array(F.col("p_type"))).otherwise(F.array().cast("array<string>"))
        .alias("categories"),
        F.col("p_retailprice").alias("price"),
        F.lit(None).cast("double").alias("average_rating"),
        F.col("p_size").alias("rating_number"),
    )


def items_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_items`` and, of every third part, a later copy with another title and a price that is no number."""
    items = raw_items(spark, sf_dir).withColumn("price", F.col("price").cast("string"))
    copies = items.where(F.col("ordinal") % 3 == 0).withColumns({
        "ordinal": F.col("ordinal") + 10**12, "title": F.lit("a later copy"), "price": F.lit("on request")})
    return items.unionByName(copies)


def bare_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_items`` in which the smallest parts have no text at all."""
    bare = F.col("rating_number") <= 5
    none = F.array().cast("array<string>")
    return raw_items(spark, sf_dir).withColumns({
        "title": F.when(~bare, F.col("title")), "store": F.when(~bare, F.col("store")),
        "description": F.when(bare, F.array(F.lit(" \u00a0"))).otherwise(F.col("description")),
        "features": F.when(bare, none).otherwise(F.col("features"))})


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    rating = F.ceil(F.col("l_quantity") / 10).cast("double")
    ts = _epoch_ms(F.col("l_shipdate"))
    return j.select(
        F.struct(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("n"),
                 F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s")).alias("ordinal"),
        F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("user_id"),
        F.concat(F.lit("i"), F.col("l_partkey").cast("string")).alias("parent_asin"),
        rating.alias("rating"),
        rating.cast("string").alias("rating_text"),
        ts.alias("timestamp"),
        ts.alias("timestamp_int"),
        ts.alias("timestamp_key"),
        (F.col("o_orderstatus") == "F").alias("verified_purchase"),
        F.col("l_linenumber").cast("int").alias("helpful_vote"),
    )


def dirty_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract-shaped but uncleaned: nulls, blanks, copies, bad ratings and times."""
    r = raw_events(spark, sf_dir)
    o = F.col("ordinal")
    ts = F.when(o % 83 == 0, F.lit(0).cast("bigint")).otherwise(F.col("timestamp"))
    return r.select(
        "user_id",
        F.col("parent_asin").alias("item_id"),
        F.when(o % 89 == 0, F.lit(6.0)).otherwise(F.col("rating")).cast("float").alias("rating"),
        ts.alias("timestamp_ms"),
        event_time_from_ms(ts).alias("event_time"),
    )


def dirty_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item table with null ids (p_size 50), and blank text (p_size <= 2)."""
    p = _read(spark, sf_dir, "part")
    return p.select(
        F.when(F.col("p_size") == 50, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("i"), F.col("p_partkey").cast("string"))).alias("item_id"),
        F.when(F.col("p_size") <= 2, F.lit("\u3000")).otherwise(F.col("p_type")).alias("item_text"),
    )


def write_dirty_jsonl(spark: SparkSession, sf_dir: str, path: str) -> str:
    """One folder per event type, with blank lines, cut-off objects and lines that are no object by value rule."""
    e = _read(spark, sf_dir, "events")
    event_id = F.col("event_id")
    line = (F.when(event_id % 53 == 0, "").when(event_id % 59 == 0, '{"user_id": ').when(event_id % 61 == 0, "[1, 2]")
            .otherwise(F.to_json(F.struct("event_id", "user_id"))))
    (e.select(line.alias("value"), "event_type").write.mode("overwrite").partitionBy("event_type")
     .option("compression", "gzip").text(path))
    return path


def write_jsonl(records: DataFrame, path: str) -> str:
    """Write a record view as gzip JSON lines in ordinal order (raw-file shape).

    Null fields are omitted, as in the upstream files.  The range-partitioned
    sort makes part-file order equal ordinal order, so the ordinal rebuilt on
    ingest (file, block, row) orders the records exactly as the view did.
    """
    body = [c for c in records.columns
            if c not in ("ordinal", "rating_text", "timestamp_int", "timestamp_key")]
    (records.orderBy("ordinal")
     .select(F.to_json(F.struct(*body)).alias("value"))
     .write.mode("overwrite").option("compression", "gzip").text(path))
    return path


def untitled_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_items`` in which every other part has no title."""
    return raw_items(spark, sf_dir).withColumn("title", F.when(F.col("ordinal") % 2 == 0, F.lit(" ")).otherwise(F.col("title")))


def write_mixed_timestamps(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Events as gzip JSON lines whose timestamps are fractions, texts or whole numbers by value rule."""
    r = raw_events(spark, sf_dir)
    at = F.col("timestamp").cast("string")
    shown = (F.when(F.col("ordinal") % 7 == 0, F.concat(at, F.lit(".5"))).when(F.col("ordinal") % 11 == 0, F.concat(F.lit('"'), at, F.lit('"')))
             .otherwise(at))
    line = F.concat(F.lit('{"user_id":"'), "user_id", F.lit('","parent_asin":"'), "parent_asin", F.lit('","rating":4.0,"timestamp":'), shown, F.lit("}"))
    r.select(line.alias("value")).write.mode("overwrite").option("compression", "gzip").text(path)
    return path
