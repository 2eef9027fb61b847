import math
import random
from fractions import Fraction

import pytest

from feedloom.recommend import split

SCHEMA = "user_id string, item_id string, rating float, timestamp_ms long, ordinal long"


def made_rows(n=400, seed=3):
    r = random.Random(seed)
    return [(f"u{r.choice([0, 0, 0, *range(20)])}", f"i{r.randrange(30)}", float(r.randint(1, 5)), r.choice([5, 10**12, 10**12 + r.randrange(10**9)]), k)
            for k in range(n)]


@pytest.mark.parametrize("values", [[7], [3, 3, 3], [-5, 0, 5], list(range(100)), [0, 2**61, -2**61, 1], [10**12 + k * k for k in range(300)]])
def test_values_at_equal_a_sort(spark, values):
    shares = [0.0, 0.1, 0.5, 0.9, 1.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v long").repartition(3)
    want = [sorted(values)[min(len(values) - 1, math.floor(Fraction(str(s)) * len(values)))] for s in shares]
    assert split.values_at(df, "v", shares) == want


def test_nothing_later_is_trained_on(spark):
    df = split.chronological_split(spark.createDataFrame(made_rows(), SCHEMA)).collect()
    times = {p: [r.timestamp_ms for r in df if r.split == p] for p in ("train", "validation", "test")}
    assert len(df) == 400 and all(times.values())
    assert max(times["train"]) < min(times["validation"]) and max(times["validation"]) < min(times["test"])
    assert len(times["train"]) <= 0.7 * 400 and len(times["test"]) >= 0.2 * 400


def test_rows_of_one_instant_stay_together(spark):
    rows = [("u", f"i{k}", 5.0, 1 if k < 9 else 2, k) for k in range(10)]
    got = split.chronological_split(spark.createDataFrame(rows, SCHEMA), 0.1, 0.5).collect()
    assert {(r.timestamp_ms, r.split) for r in got} == {(1, "test"), (2, "test")}


def test_no_time_no_part_and_empty_tables(spark):
    df = spark.createDataFrame([("u", "i", 5.0, None, 1), ("u", "i", 5.0, 4, 2)], SCHEMA)
    assert {(r.ordinal, r.split) for r in split.chronological_split(df).collect()} == {(1, None), (2, "test")}
    assert split.chronological_split(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("shares", [(0.5, 0.5), (-0.1, 0.2), (0.1, 0.0)])
def test_shares_must_leave_both_ends(spark, shares):
    with pytest.raises(ValueError):
        split.time_cuts(spark.createDataFrame([], SCHEMA), *shares)


@pytest.mark.parametrize("n", [1, 3])
def test_last_events_of_every_user(spark, n):
    rows = made_rows() + [("one", "i1", 5.0, 9, 1000), ("same", "i1", 4.0, 9, 1001), ("same", "i1", 4.0, 9, 1002), (None, "i2", 3.0, 1, 1003)]
    got = {r.ordinal: r.split for r in split.leave_last_out(spark.createDataFrame(rows, SCHEMA), n).collect()}
    assert len(got) == len(rows)
    for u in {x[0] for x in rows}:
        own = [x[4] for x in sorted((x for x in rows if x[0] == u), key=lambda x: (x[3], x[4]))]
        test = own[-n:] if u is not None and len(own) > n else []
        assert [k for k in own if got[k] == "test"] == test


def test_last_events_leave_a_limit_before_the_shuffle(spark):
    plan = split.leave_last_out(spark.createDataFrame(made_rows(), SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_relevance_is_positive_unseen_and_distinct(spark):
    rows = [("a", "i1", 5.0, 1, "train"), ("a", "i1", 5.0, 9, "test"),   # trained on
            ("a", "i2", 1.0, 1, "train"), ("a", "i2", 5.0, 9, "test"),   # trained on, though not liked
            ("a", "i3", 4.0, 9, "test"), ("a", "i3", 5.0, 10, "test"),   # twice
            ("a", "i4", 3.0, 9, "test"), ("a", "i5", float("nan"), 9, "test"), ("b", "i1", 4.0, 9, "validation"), ("b", "i6", 4.0, 9, "test")]
    df = spark.createDataFrame(rows, "user_id string, item_id string, rating float, timestamp_ms long, split string")
    assert sorted(map(tuple, split.held_out_relevance(df).collect())) == [("a", "i3"), ("b", "i6")]
    assert sorted(map(tuple, split.held_out_relevance(df, "validation").collect())) == [("b", "i1")]
