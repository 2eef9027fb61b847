"""Leakage-safe integer indices (E1-E6, S7) as mapping tables.

A mapping is a DataFrame ``(value STRING, idx INT)``: contiguous 0-based
indices in first-seen order of the fitting table.  ``StringIndexer`` orders by
frequency or alphabet, and ``row_number() over (order by ...)`` without a
partition funnels every id through one task, so E1 is built in two passes:

1. one row per id with its first position (a partial aggregate, so a hot id
   is combined map-side), range-partitioned and sorted by that position, with
   ``monotonically_increasing_id`` recording (partition, offset-in-partition);
   the result is checkpointed so those ids can never move on recomputation;
2. per-partition counts (one row per partition, a proven small bound) become
   prefix offsets that are broadcast back: ``idx = offset[pid] + position``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom import messages
from feedloom.schemas import missing_columns
from feedloom.session import checkpoint_dir

UNKNOWN_INDEX = -1
_POS_BITS = 33


#: Row order of a contract interactions table, the default for fitting on one.
CONTRACT_ORDER = ["user_id", "timestamp_ms", "ordinal"]


def _first_positions(df: DataFrame, column: str, order: list[str]) -> tuple[DataFrame, list[Column]]:
    if order[0] == column:
        # The caller orders rows by the id itself: first appearance order is id order.
        firsts = df.select(F.col(column).alias("value")).distinct()
        return firsts, [F.col("value")]
    firsts = df.groupBy(F.col(column).alias("value")).agg(
        F.min(F.struct(*[F.col(c) for c in order])).alias("_first"))
    return firsts, [F.col("_first"), F.col("value")]


def fit_index(df: DataFrame, column: str, order: list[str], partitions: int | None = None) -> DataFrame:
    """Fit a first-seen index of ``column`` over rows ordered by ``order``.

    ``order`` lists the columns that define the fitting table's row order, e.g.
    ``["user_id", "timestamp_ms", "ordinal"]`` for a contract interactions
    table.  There is no order to fall back to: a DataFrame has none of its own,
    so an empty ``order`` raises.  A null id raises, as fitting on a null
    identifier is an error, and so does a mapping beyond INT.
    """
    if not order:
        raise ValueError(messages.NO_ROW_ORDER)
    spark = df.sparkSession
    checkpoint_dir(spark)
    firsts, sort_key = _first_positions(df, column, list(order))
    # Without an explicit count AQE may coalesce the range partitions; it only
    # merges neighbours, so partition order still follows the sort key.
    ranged = (firsts.repartitionByRange(partitions, *sort_key) if partitions
              else firsts.repartitionByRange(*sort_key))
    placed = (ranged.sortWithinPartitions(*sort_key)
              .select("value", F.monotonically_increasing_id().alias("_mid")))
    frozen = placed.checkpoint(eager=True)
    if frozen.where(F.col("value").isNull()).limit(1).count():
        raise ValueError(messages.NULL_IDENTIFIERS)
    with_pid = frozen.select(
        "value",
        F.shiftright("_mid", _POS_BITS).alias("_pid"),
        (F.col("_mid") - F.shiftleft(F.shiftright("_mid", _POS_BITS), _POS_BITS)).alias("_pos"),
    )
    counts = with_pid.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_offset"))
    offsets = offsets.select("_pid", F.coalesce("_offset", F.lit(0)).alias("_offset"))
    # One row per range partition: bounded by ``n``, so broadcasting it is safe.
    return with_pid.join(F.broadcast(offsets), "_pid").select(
        F.col("value").cast("string").alias("value"),
        _int_index(F.col("_offset") + F.col("_pos")).alias("idx"))


def _int_index(position: Column) -> Column:
    """INT bound of the contract, checked whatever the session's ANSI mode."""
    return F.when(position > 2**31 - 1, F.raise_error(F.lit(messages.INDEX_TOO_LARGE))).otherwise(position).cast("int")


def fit_encoders(training: DataFrame, order: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """User and item mappings from the training table only.

    ``order`` may be left out only for a table that carries the contract's row
    order (``CONTRACT_ORDER``); anything else has no first-seen order and raises.
    """
    missing = missing_columns(training.columns, {"user_id", "item_id"})
    if missing:
        raise ValueError(messages.ENCODER_MISSING_COLUMNS.format(columns=", ".join(missing)))
    if order is None:
        if missing_columns(training.columns, set(CONTRACT_ORDER)):
            raise ValueError(messages.NO_ROW_ORDER)
        order = CONTRACT_ORDER
    return fit_index(training, "user_id", order), fit_index(training, "item_id", order)


def require_fitted(mapping: DataFrame) -> None:
    if not mapping.limit(1).count():
        raise ValueError(messages.NOT_FITTED)


def _spread(cannot_match: Column) -> Column:
    """Salt for rows that can never match: their map partition id, else 0.

    A null id (or a -1 index) may be a third of a table; hashed alone it would
    land on one reducer of a sort-merge join.  Salting only those rows spreads
    them as evenly as the input is spread, and they still match nothing.
    """
    return F.when(cannot_match, F.spark_partition_id() + 1).otherwise(F.lit(0))


def apply_index(df: DataFrame, mapping: DataFrame, column: str, out: str) -> DataFrame:
    """Add ``out`` = index of ``column``; unseen (and null) ids get -1.

    A left join keeps every row.  The planner broadcasts the mapping only when
    its measured size is under the threshold; otherwise it is a sort-merge
    join in which AQE splits skewed partitions of a hot *known* id, and null
    ids (which match nothing) are salted across reducers.
    """
    left = df.withColumn("_salt", _spread(F.col(column).isNull()))
    m = mapping.select(F.col("value").alias(column), F.col("idx").alias(out), F.lit(0).alias("_salt"))
    joined = left.join(m, on=[column, "_salt"], how="left")
    cols = [F.coalesce(F.col(out), F.lit(UNKNOWN_INDEX)).cast("int").alias(out) if c == out else F.col(c)
            for c in df.columns + [out]]
    return joined.select(*cols)


def encode_interactions(df: DataFrame, users: DataFrame, items: DataFrame, check: bool = True) -> DataFrame:
    """Both indices added; ids and every row kept."""
    if check:
        require_fitted(users)
        require_fitted(items)
    return apply_index(apply_index(df, users, "user_id", "user_idx"), items, "item_id", "item_idx")


def invert_index(df: DataFrame, mapping: DataFrame, idx_column: str, out: str) -> DataFrame:
    """Index -> id; -1 and unknown indices give null.

    Negative and null indices match nothing, so they are salted across
    reducers (a cold-start-heavy split can make -1 a third of the rows).
    """
    idx = F.col(idx_column)
    left = df.withColumn("_salt", _spread(idx.isNull() | (idx < 0)))
    m = mapping.select(F.col("idx").alias(idx_column), F.col("value").alias(out), F.lit(0).alias("_salt"))
    return left.join(m, on=[idx_column, "_salt"], how="left").select(*df.columns, out)


def index_size(mapping: DataFrame) -> DataFrame:
    """Number of fitted ids (one-row frame)."""
    return mapping.agg(F.count(F.lit(1)).alias("size"))


def save_mapping(mapping: DataFrame, path: str) -> None:
    """Persist a mapping as parquet."""
    mapping.write.mode("overwrite").parquet(path)


def load_mapping(spark, path: str) -> DataFrame:
    """Restore a mapping, coercing the index to INT."""
    m = spark.read.parquet(path)
    return m.select(F.col("value").cast("string"), F.col("idx").cast("int"))
