"""Leakage-free splits (D1) and held-out relevance.

``chronological_split`` cuts the whole table at two instants, so that nothing in a
part is later than anything in the next.  The instants are exact quantiles, found
without sorting the table: a histogram over the leading digits of the time tells in
which range the wanted row lies, and the next round looks only there.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.operators.label import LabelPolicy, positive_flag
from feedloom.schemas import ORDINAL

TRAIN, VALIDATION, TEST = "train", "validation", "test"
DIGIT_BITS = 14  # a round's histogram has at most 2**14 rows a wanted value


def values_at(df: DataFrame, column: str, shares: list[float]) -> list[int | None]:
    """For each share s of the n non-null integers in ``column``, the one with floor(s * n) smaller or equal
    ones before it in ascending order (the largest for s = 1; None for an empty table).  The integers span
    less than 2**62.

    Every round is a partial aggregate over one narrow column; what comes to the driver is a histogram of
    a fixed number of rows."""
    values = df.select(F.col(column).cast("bigint").alias("v")).where(F.col("v").isNotNull())
    n, least, most = values.agg(F.count(F.lit(1)), F.min("v"), F.max("v")).first()
    if not n:
        return [None] * len(shares)
    shift = max(0, (most - least).bit_length() - DIGIT_BITS)
    low, span = [least] * len(shares), 1 << (shift + DIGIT_BITS)
    rank = [min(n - 1, math.floor(Fraction(str(s)) * n)) for s in shares]
    while True:
        # what two shares look at is the same range, or apart: a row counts once
        where = F.coalesce(*[F.when(F.col("v").between(a, min(a + span, 1 << 63) - 1), F.lit(a).cast("bigint")) for a in sorted(set(low))])
        found = values.select("v", where.alias("low")).where(F.col("low").isNotNull())
        found = found.groupBy("low", F.shiftright(F.col("v") - F.col("low"), shift).alias("digit")).agg(F.count(F.lit(1)).alias("rows"))
        counts = sorted(found.collect())
        for k in range(len(shares)):
            for _, d, rows in (c for c in counts if c[0] == low[k]):
                if rank[k] < rows:
                    low[k] += d << shift
                    break
                rank[k] -= rows
        if not shift:
            return low
        shift, span = max(0, shift - DIGIT_BITS), 1 << shift


def time_cuts(interactions: DataFrame, validation: float = 0.1, test: float = 0.2) -> tuple[int | None, int | None]:
    """First instants of the validation and of the test part."""
    if not (validation >= 0 and test > 0 and validation + test < 1):
        raise ValueError("shares must leave something to train on and something to test")
    parts = [Fraction(str(validation)), Fraction(str(test))]
    return tuple(values_at(interactions, "timestamp_ms", [1 - sum(parts), 1 - parts[1]]))


def chronological_split(interactions: DataFrame, validation: float = 0.1, test: float = 0.2) -> DataFrame:
    """``split`` added: train strictly before the first cut, validation strictly before the second, then test.

    Rows of one instant are never parted, so the first parts may be smaller than their shares.  A row
    without a time belongs to no part (null); an empty table stays empty."""
    first, second = time_cuts(interactions, validation, test)
    at = F.col("timestamp_ms")
    part = F.when(at < F.lit(first), TRAIN).when(at < F.lit(second), VALIDATION).when(at.isNotNull(), TEST)
    return interactions.withColumn("split", part)


def leave_last_out(interactions: DataFrame, n: int = 1, order: list[str] | None = None) -> DataFrame:
    """D1, by user: the last ``n`` events of every user with more than ``n`` are test, all others train.

    ``order`` (default: time, then ordinal) places a user's events; it should be unique, and events equal to the
    first one left out are left out with it.  Only n + 1 rows a user leave a map task, so a user with a large part of all rows
    costs no more than another; the cut then meets the rows in a join whose hot keys adaptive execution splits."""
    if n < 1:
        raise ValueError("n must be at least 1")
    order = order or ["timestamp_ms", *([ORDINAL] if ORDINAL in interactions.columns else [])]
    place = F.struct(*[F.col(c) for c in order])
    last = interactions.select("user_id", place.alias("_place"))
    last = last.withColumn("_rn", F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("_place")))).where(F.col("_rn") <= n + 1)
    cuts = last.groupBy("user_id").agg(F.max(F.when(F.col("_rn") == n, F.col("_place"))).alias("_cut"), F.max("_rn").alias("_rows"))
    cuts = cuts.where(F.col("_rows") > n).select("user_id", "_cut")
    joined = interactions.withColumn("_place", place).join(cuts, "user_id", "left")
    part = F.when(F.col("_place") >= F.col("_cut"), TEST).otherwise(TRAIN)
    return joined.select(*[F.col(f"`{c}`") for c in interactions.columns], part.alias("split"))


def held_out_relevance(split: DataFrame, part: str = TEST, policy: LabelPolicy = LabelPolicy(),
                       known: tuple[str, ...] = (TRAIN,)) -> DataFrame:
    """Distinct (user_id, item_id) with a positive event in ``part`` and no event at all in the ``known`` parts.

    Recommendations are of unseen items, so a pair that was trained on, liked or not, is never relevant."""
    held = split.where((F.col("split") == part) & (positive_flag(split, policy.positive_rating_threshold) == 1))
    seen = split.where(F.col("split").isin(*known)).select("user_id", "item_id")
    return held.select("user_id", "item_id").distinct().join(seen, ["user_id", "item_id"], "left_anti")
