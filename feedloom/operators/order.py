"""Row positions of an ordered table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.session import materialize

_POS_BITS = 33


def with_position(ordered: DataFrame, name: str = "position") -> DataFrame:
    """``ordered`` and, in ``name``, the place from 0 that each row really has in it.

    Rows are marked with partition and place as they come out of the sort and written; a row a partition then
    gives the places before it (broadcast: its size is the number of partitions).  No task sees the whole table."""
    marked = materialize(ordered.withColumn("_mid", F.monotonically_increasing_id()), "ordered")
    placed = marked.select(*ordered.columns, F.shiftright("_mid", _POS_BITS).alias("_pid"), F.col("_mid").bitwiseAND((1 << _POS_BITS) - 1).alias("_at"))
    counts = placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_pid", before.alias("_before"))
    return placed.join(F.broadcast(offsets), "_pid").select(*ordered.columns, (F.col("_before") + F.col("_at")).alias(name))
