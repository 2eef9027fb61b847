"""Pairs of rows that share a key, with hot keys dealt in blocks, and lists made from neighbours."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.operators.index import fit_index
from feedloom.session import materialize

BLOCK = 512  # rows of one key that meet one another in one cell, about
PAIRS = 1 << 20  # of rows that share a key, made in one task, about
LIKES = 1 << 16  # likes whose neighbours are added up in one task, about
UNIT = 10**9  # similarities are added up in whole units of 1 / UNIT: sums do not depend on their order


def pairs_sharing(rows: DataFrame, key: str, item: str, block: int = BLOCK) -> DataFrame:
    """(key, i, j), i < j: all pairs of different ``item`` values under one ``key`` of ``rows`` (key, item; distinct).

    A key with many rows is dealt into lots of about ``block`` rows; pairs of lots are cells, and a cell is what the join
    works on.  Every pair comes from exactly one cell, and no cell grows with the key; tasks are as many as the pairs ask for,
    as the rows before the join do not tell its size."""
    rows = rows.select(F.col(key).alias("key"), F.col(item).alias("item"))
    lots = materialize(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.ceil(F.count(F.lit(1)) / block).cast("int").alias("lots")), "lots")
    tasks = max(1, math.ceil((lots.agg(F.sum(F.col("n") * F.col("n") / 2)).first()[0] or 0) / PAIRS))
    lots = lots.drop("n")
    dealt = rows.join(lots, "key").select("key", "item", "lots", F.pmod(F.xxhash64("item"), F.col("lots")).cast("int").alias("lot"))
    zero = F.lit(0)
    left = dealt.select("key", F.col("item").alias("a"), F.col("lot").alias("x"), F.explode(F.sequence("lot", F.col("lots") - 1)).alias("y"))
    right = dealt.select("key", F.col("item").alias("b"), F.explode(F.sequence(zero, F.col("lot"))).alias("x"), F.col("lot").alias("y"))
    left, right = (side.repartition(tasks, "key", "x", "y") for side in (left, right))
    both = left.join(right, ["key", "x", "y"]).where((F.col("x") < F.col("y")) | (F.col("a") < F.col("b")))
    return both.select("key", F.least("a", "b").alias("i"), F.greatest("a", "b").alias("j"))


def top_neighbours(similar: DataFrame, n: int) -> DataFrame:
    """The ``n`` most similar others of every item: ``similar`` (item_id, other_id, similarity), ties by other_id."""
    order = Window.partitionBy("item_id").orderBy(F.desc("similarity"), "other_id")
    return similar.select("*", F.row_number().over(order).alias("rank")).where(F.col("rank") <= n)


def recommend_by_neighbours(likes: DataFrame, neighbours: DataFrame, seen: DataFrame, users: DataFrame, k: int = 10) -> DataFrame:
    """(user_id, item_id, rank, score): of every user of ``users``, the k items with the largest sum of similarities to
    the liked ones, none of them in ``seen``; ties by item id.

    ``likes`` and ``seen`` are (user_id, item_id), ``neighbours`` (item_id, other_id, similarity).  A liked item brings its
    list of neighbours as one row of codes and whole units, what a user has seen comes as lists without units, and both meet
    once, by user, in tasks of about ``LIKES`` likes; reruns agree to the last digit.  Codes follow the order of the ids."""
    who = users.select("user_id").where(F.col("user_id").isNotNull()).distinct()
    own = materialize(likes.select("user_id", "item_id").join(who, "user_id", "left_semi").distinct(), "own")
    codes = materialize(fit_index(neighbours.where(F.col("other_id").isNotNull()), "other_id", ["other_id"]), "codes")
    units = F.floor(F.col("similarity") * UNIT).cast("bigint").alias("units")
    coded = neighbours.join(codes, F.col("other_id") == F.col("value")).select("item_id", "idx", units)
    lists = coded.groupBy("item_id").agg(F.collect_list(F.struct("idx", "units")).alias("list"))
    met = own.join(lists.select("item_id", F.col("list.idx").alias("others"), F.col("list.units").alias("units")), "item_id").select("user_id", "others", "units")
    known = seen.select("user_id", F.col("item_id").alias("value")).join(who, "user_id", "left_semi").join(codes, "value")
    known = known.select("user_id", F.array("idx").alias("others"), F.array(F.lit(None).cast("bigint")).alias("units"))
    dealt = met.unionByName(known).repartition(max(1, -(-own.count() // LIKES)), "user_id")
    each = dealt.select("user_id", F.inline(F.arrays_zip("others", "units")).alias("idx", "units"))
    sums = each.groupBy("user_id", "idx").agg(F.sum("units").alias("units"), F.count_if(F.col("units").isNull()).alias("seen"))
    order = Window.partitionBy("user_id").orderBy(F.desc("units"), "idx")
    fresh = sums.where((F.col("seen") == 0) & F.col("units").isNotNull())
    best = fresh.select("user_id", "idx", "units", F.row_number().over(order).alias("rank")).where(F.col("rank") <= k)
    return best.join(codes, "idx").select("user_id", F.col("value").alias("item_id"), "rank", (F.col("units") / UNIT).alias("score"))
