import math
import random

import pytest

from feedloom.recommend import ranking

LISTS, PAIR = "user_id string, item_id string, rank int", "user_id string, item_id string"


def brute(lists, truth, ks):
    rel = {}
    for u, i in truth:
        if u is not None and i is not None:
            rel.setdefault(u, set()).add(i)
    out = {}
    for u, own in rel.items():
        first = {}
        for v, i, r in lists:
            if v == u:
                first[i] = min(r, first.get(i, r))
        hits = sorted(r for i, r in first.items() if i in own)
        for k in ks:
            at = [r for r in hits if 1 <= r <= k]
            best = sum(1 / math.log2(r + 1) for r in range(1, min(len(own), k) + 1))
            out[u, k] = (len(own), len(at), len(at) / k, len(at) / len(own), sum(n / r for n, r in enumerate(at, 1)) / min(len(own), k),
                         sum(1 / math.log2(r + 1) for r in at) / best, float(bool(at)))
    return out


def made(seed):
    r = random.Random(seed)
    lists = [(f"u{u}", i, k) for u in range(12) for k, i in enumerate(r.sample([f"i{x}" for x in range(20)], 12), 1)]
    truth = [(f"u{r.randrange(15)}", f"i{r.randrange(20)}") for _ in range(50)]
    return lists + [("u1", "i3", 2), ("u1", "i3", 9)], truth + [(None, "i1"), ("u1", None), ("alone", "i1")]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_the_formulas(spark, seed):
    lists, truth = made(seed)
    ks = (1, 3, 10)
    got = ranking.user_metrics(spark.createDataFrame(lists, LISTS).repartition(3), spark.createDataFrame(truth, PAIR), ks).collect()
    want = brute(lists, truth, ks)
    assert {(r.user_id, r.k) for r in got} == set(want)
    for r in got:
        assert tuple(r)[2:] == pytest.approx(want[r.user_id, r.k], abs=1e-12)
    means = {r.k: r for r in ranking.ranking_metrics(spark.createDataFrame(lists, LISTS), spark.createDataFrame(truth, PAIR), ks).collect()}
    for k in ks:
        own = [v for (_, j), v in want.items() if j == k]
        assert means[k].users == len(own)
        assert [means[k][m] for m in ranking.METRICS] == pytest.approx([sum(c) / len(own) for c in list(zip(*own))[2:]], abs=1e-12)


def test_a_perfect_list_scores_one(spark):
    truth = [("u", f"i{k}") for k in range(4)]
    row = ranking.ranking_metrics(spark.createDataFrame([("u", f"i{k}", k + 1) for k in range(4)], LISTS), spark.createDataFrame(truth, PAIR), (4,)).first()
    assert (row.precision, row.recall, row.map, row.ndcg, row.hit_rate) == (1, 1, 1, 1, 1)


def test_nothing_relevant_no_rows(spark):
    lists, none = spark.createDataFrame([("u", "i", 1)], LISTS), spark.createDataFrame([], PAIR)
    assert ranking.ranking_metrics(lists, none).collect() == []
    row = ranking.ranking_metrics(lists.where("false"), spark.createDataFrame([("u", "i")], PAIR), (5,)).first()
    assert (row.users, row.precision, row.ndcg) == (1, 0, 0)
    with pytest.raises(ValueError):
        ranking.ranking_metrics(lists, none, ())


def test_coverage(spark):
    lists = spark.createDataFrame([("u", "i1", 1), ("v", "i1", 1), ("v", "gone", 2)], LISTS)
    items = spark.createDataFrame([("i1",), ("i2",), ("i2",), (None,)], "item_id string")
    assert tuple(ranking.catalogue_coverage(lists, items).first()) == (1, 2, 0.5)
    assert tuple(ranking.catalogue_coverage(lists, items.where("false")).first()) == (0, 0, None)
