import math
import random
from itertools import combinations

import pytest

from feedloom.recommend import item_item, pairs

PAIR = "user_id string, item_id string"


def made(seed=2):
    r = random.Random(seed)
    likes = {(f"u{r.randrange(40)}", f"i{int(r.triangular(0, 30, 4))}") for _ in range(260)}
    likes |= {("hot", f"i{k}") for k in range(30)} | {("hotter", f"i{k}") for k in range(5, 60)} | {("third", f"i{k}") for k in range(40, 60)}
    return sorted(likes)


def brute(likes, n=20, min_common=2, t=0.05):
    of = {}
    for u, i in likes:
        of.setdefault(i, set()).add(u)
    near = {i: [] for i in of}
    for a, b in combinations(sorted(of), 2):
        c = len(of[a] & of[b])
        if c >= min_common and c * c >= t * t * len(of[a]) * len(of[b]):
            s = c / math.sqrt(len(of[a]) * len(of[b]))
            near[a].append((-s, b, c))
            near[b].append((-s, a, c))
    return {i: [(b, c, -s) for s, b, c in sorted(x)[:n]] for i, x in near.items()}


def flat(near):
    return sorted((i, b, c, s, r) for i, x in near.items() for r, (b, c, s) in enumerate(x, 1))


@pytest.mark.parametrize("heavy,block", [(1000, 512), (8, 4), (0, 7), (25, 3)])
@pytest.mark.parametrize("common,t", [(2, 0.05), (1, 0.0), (3, 0.5)])
def test_equals_all_pairs(spark, heavy, block, common, t):
    likes = made()
    got = item_item.item_neighbours(spark.createDataFrame(likes, PAIR).repartition(3), 6, common, t, heavy, block)
    assert sorted(map(tuple, got.select("item_id", "other_id", "common", "similarity", "rank").collect())) == flat(brute(likes, 6, common, t))


def test_every_pair_comes_from_one_cell(spark):
    rows = [("hot", k) for k in range(200)] + [("a", 1), ("a", 2), ("b", 9)]
    got = pairs.pairs_sharing(spark.createDataFrame(rows, "k string, x int"), "k", "x", 16).collect()
    want = [("hot", a, b) for a, b in combinations(range(200), 2)] + [("a", 1, 2)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_weak_items_of_heavy_users_make_no_pairs(spark):
    """Items that only a heavy user holds cannot have two common users."""
    likes = [("hot", f"i{k}") for k in range(300)] + [("too", "i1"), ("too", "i2")]
    got = item_item.item_neighbours(spark.createDataFrame(likes, PAIR), 5, 2, 0.05, heavy=10).collect()
    assert sorted((r.item_id, r.other_id, r.common) for r in got) == [("i1", "i2", 2), ("i2", "i1", 2)]


def test_lists_are_sums_over_liked_items_without_the_seen(spark):
    rows = [(u, i, 5.0) for u, i in made()] + [("u1", "i59", 1.0), ("cold", "i3", 2.0), (None, "i1", 5.0), ("u2", None, 5.0)]
    train = spark.createDataFrame(rows, "user_id string, item_id string, rating float")
    users = spark.createDataFrame([("u1",), ("u2",), ("hot",), ("cold",), ("new",), (None,)], "user_id string")
    got = {}
    for r in item_item.recommend_collaborative(train, users, 4).collect():
        got.setdefault(r.user_id, {})[r.rank] = (r.item_id, r.score)
    near, want = brute(made()), {}
    for u in ("u1", "u2", "hot"):
        sums = {}
        for i in {i for v, i, s in rows if v == u and s >= 4 and i}:
            for b, _, s in near[i]:
                sums[b] = sums.get(b, 0) + math.floor(s * pairs.UNIT)
        fresh = sorted((-x, b) for b, x in sums.items() if (u, b) not in {(v, i) for v, i, _ in rows})[:4]
        want[u] = {k: (b, -x / pairs.UNIT) for k, (x, b) in enumerate(fresh, 1)}
    assert got == {u: x for u, x in want.items() if x}


def test_empty_and_bad_bounds(spark):
    none = spark.createDataFrame([], PAIR)
    assert item_item.item_neighbours(none).collect() == []
    with pytest.raises(ValueError):
        item_item.co_occurrence(none, 0)
