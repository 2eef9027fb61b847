import math
import random

import pytest

from feedloom.operators.index import fit_index
from feedloom.recommend import coldstart, hybrid
from feedloom.recommend.pairs import UNIT

LISTS = "user_id string, item_id string, rank int, score double"


def made(seed):
    r = random.Random(seed)
    out = {}
    for name in "abc":
        rows = []
        for u in r.sample(range(8), 6):
            for k, i in enumerate(r.sample(range(12), r.randint(1, 7)), 1):
                rows.append((f"u{u}", f"i{i}", k, r.choice([1.0, 5.0 / k, 0.1])))
        out[name] = rows
    return out


def brute(lists, weights, k, method):
    units = {}
    for name, rows in lists.items():
        for u, i, rank, score in rows:
            own = [s for v, _, _, s in rows if v == u]
            if method == "scores":
                part = (score - min(own)) / (max(own) - min(own)) if max(own) > min(own) else 1.0
            else:
                part = 1 / (60 + rank)
            n, s = units.get((u, i), (0, 0))
            units[u, i] = n + math.floor(part * weights[name] * UNIT), s + 1
    out = []
    for u in {u for u, _ in units}:
        best = sorted((-n, i, s) for (v, i), (n, s) in units.items() if v == u)[:k]
        out += [(u, i, rank, -n / UNIT, s) for rank, (n, i, s) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("method", ["scores", "ranks"])
@pytest.mark.parametrize("seed", [1, 2])
def test_fused_lists(spark, method, seed):
    lists, weights = made(seed), {"a": 0.5, "b": 0.3, "c": 1}
    got = hybrid.fuse({n: spark.createDataFrame(x, LISTS).repartition(2) for n, x in lists.items()}, weights, 4, method)
    assert sorted(map(tuple, got.collect())) == brute(lists, weights, 4, method)


def test_an_item_twice_in_a_list_counts_once(spark):
    df = spark.createDataFrame([("u", "i", 1, 3.0), ("u", "i", 2, 1.0), ("u", "j", 3, 2.0)], LISTS)
    got = hybrid.fuse({"a": df}, {"a": 1.0}, 5)
    assert [tuple(r) for r in got.collect()] == [("u", "i", 1, 1.0, 1), ("u", "j", 2, 0.0, 1)]


def test_weights_belong_to_lists(spark):
    df = spark.createDataFrame([], LISTS)
    for weights in ({}, {"a": 0.0}, {"a": 1.0, "b": 1.0}):
        with pytest.raises(ValueError):
            hybrid.fuse({"a": df}, weights)
    with pytest.raises(ValueError):
        hybrid.fuse({"a": df}, {"a": 1.0}, method="votes")


def test_every_user_is_served(spark):
    own = spark.createDataFrame([("a", "x", 1, 9.0), ("a", "y", 2, 8.0), ("b", "p1", 1, 9.0)], LISTS)
    popular = spark.createDataFrame([(u, f"p{k}", k, 1.0) for u in ("a", "b", "new") for k in (1, 2, 3)], LISTS)
    got = sorted(map(tuple, coldstart.fill_up([own, popular], 3).collect()))
    assert got == [("a", "p1", 3, 1), ("a", "x", 1, 0), ("a", "y", 2, 0), ("b", "p1", 1, 0), ("b", "p2", 2, 1), ("b", "p3", 3, 1),
                   ("new", "p1", 1, 1), ("new", "p2", 2, 1), ("new", "p3", 3, 1)]


def test_segments_and_their_metrics(spark):
    train = spark.createDataFrame([("a", f"i{k}", k) for k in range(5)] + [("b", "i1", 9), ("b", "i1", 10)], "user_id string, item_id string, t int")
    users, items = (fit_index(train, c, ["t"]) for c in ("user_id", "item_id"))
    relevant = spark.createDataFrame([("a", "i9"), ("a", "i1"), ("b", "i2"), ("new", "i1"), (None, "i1")], "user_id string, item_id string")
    who = coldstart.user_segments(relevant, users, train)
    assert sorted(map(tuple, who.collect())) == [("a", "active"), ("b", "sparse"), ("new", "cold")]
    what = coldstart.item_segments(relevant, items)
    assert sorted(map(tuple, what.collect())) == [("i1", "known"), ("i2", "known"), ("i9", "cold")]
    lists = spark.createDataFrame([("a", "i9", 1, 1.0), ("new", "i1", 2, 1.0)], LISTS)
    by_user = {r.segment: (r.users, r.recall) for r in coldstart.metrics_by_user_segment(lists, relevant, who, (2,)).collect()}
    assert by_user == {"active": (1, 0.5), "sparse": (1, 0.0), "cold": (1, 1.0)}
    by_item = {r.segment: (r.users, r.recall) for r in coldstart.metrics_by_item_segment(lists, relevant, what, (2,)).collect()}
    assert by_item == {"cold": (1, 1.0), "known": (3, 1 / 3)}
