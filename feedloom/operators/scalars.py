"""Combine one-row aggregates computed in separate branches without a join.

Each branch scans only the columns it needs (parquet prunes the rest), so
three narrow branches cost about one wide scan, and no branch multiplies rows
the way ``Expand`` does for several exact distinct counts in one aggregate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def combine_one_row(*frames: DataFrame) -> DataFrame:
    """Union one-row frames with disjoint columns and fold them into one row."""
    columns: list[str] = []
    for f in frames:
        columns.extend(c for c in f.columns if c not in columns)
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in columns])
