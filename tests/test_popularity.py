import random
from collections import Counter

import pytest

from feedloom.recommend import popularity

PAIR = "user_id string, item_id string"


def brute(train, users, k):
    n = Counter(i for _, i in train)
    ranked = sorted(n, key=lambda i: (-n[i], i))
    seen = {}
    for u, i in train:
        seen.setdefault(u, set()).add(i)
    out = []
    for u in {u for u in users if u is not None}:
        free = [i for i in ranked if i not in seen.get(u, ())][:k]
        out += [(u, i, r, n[i]) for r, i in enumerate(free, 1)]
    return sorted(out)


def made(seed=1):
    r = random.Random(seed)
    items = [f"i{k}" for k in range(90)]
    train = [(f"u{r.randrange(25)}", items[min(int(r.expovariate(0.06)), 89)]) for _ in range(600)]
    train += [("hot", i) for i in items if i not in ("i7", "i88")]          # has seen all but two
    train += [("all", i) for i in items]                                     # has seen everything
    train += [("head", i) for i in sorted(items)[:40]] + [("twice", "i1")] * 3 + [("tail", i) for i in items[50:]]
    users = [f"u{k}" for k in range(27)] + ["hot", "all", "head", "twice", "tail", "new", "new", None]
    return train, users


@pytest.mark.parametrize("k,block,head", [(1, 1, 2), (5, 5, 7), (7, 16, 1 << 16), (10, 4096, 1 << 16), (200, 4096, 3)])
def test_equals_the_list_without_the_seen(spark, k, block, head):
    train, users = made()
    got = popularity.recommend_popular(spark.createDataFrame(train, PAIR).repartition(4), spark.createDataFrame([(u,) for u in users], "user_id string"),
                                       k, block, head)
    assert sorted(map(tuple, got.select("user_id", "item_id", "rank", "score").collect())) == brute(train, users, k)


def test_a_hot_user_opens_few_blocks(spark):
    """A user with nearly all places taken is opened only where a place is free."""
    places = [("hot", p) for p in range(5000) if p not in (17, 2600, 4000, 4001)] + [("cold", 3)]
    held, who = spark.createDataFrame(places, "user_id string, place int"), spark.createDataFrame([("hot",), ("cold",), ("new",)], "user_id string")
    got = popularity._free_places(held, who, 5000, 3, 50).collect()
    assert sorted((r.user_id, r.rank, r.place) for r in got) == [
        ("cold", 1, 0), ("cold", 2, 1), ("cold", 3, 2), ("hot", 1, 17), ("hot", 2, 2600), ("hot", 3, 4000), ("new", 1, 0), ("new", 2, 1), ("new", 3, 2)]


def test_nothing_to_recommend(spark):
    none, users = spark.createDataFrame([], PAIR), spark.createDataFrame([("u",)], "user_id string")
    assert popularity.recommend_popular(none, users).collect() == []
    assert popularity.recommend_popular(spark.createDataFrame([("u", "i")], PAIR), users.where("false")).collect() == []
    with pytest.raises(ValueError):
        popularity.recommend_popular(none, users, 0)


def test_large_ids_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(popularity, "BROADCAST_BYTES", 10)
    train, users = made()
    df = popularity.recommend_popular(spark.createDataFrame(train, PAIR), spark.createDataFrame([(u,) for u in users], "user_id string"), 5)
    assert "SortMergeJoin" in df._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, df.select("user_id", "item_id", "rank", "score").collect())) == brute(train, users, 5)
