import math
import random
import re
from collections import Counter

import pytest

from feedloom.recommend import content

ITEM = "item_id string, item_text string"


def made(seed=3):
    r = random.Random(seed)
    words = ["the", "for"] * 12 + [f"w{k}" for k in range(25)] + [f"rare{k}" for k in range(60)]
    rows = [(f"i{k:03d}", " ".join(r.choices(words, k=r.randint(1, 9)))) for k in range(90)]
    rows += [(f"c{k}", "The same, COPY of w1!") for k in range(9)] + [(f"d{k}", "copy of w1 the same") for k in range(4)]
    return rows + [("blank", " - "), ("null", None), (None, "w1 w2"), ("é1", "crème w1"), ("é2", "Crème w1"), ("long", "w1 " * 500 + "rare1")]


def brute(rows, n, t):
    tf = {i: Counter(re.findall(r"[^\W_]+", (x or "").lower())) for i, x in rows if i is not None}
    tf = {i: c for i, c in tf.items() if c}
    df = Counter(w for c in tf.values() for w in c)
    vec = {}
    for i, c in tf.items():
        raw = {w: k * (math.log((1 + len(tf)) / (1 + df[w])) + 1) for w, k in c.items()}
        size = math.sqrt(sum(x * x for x in raw.values()))
        vec[i] = {w: math.floor(x / size * content.SCALE) for w, x in raw.items()}
    out = []
    for i in vec:
        dots = [(-sum(x * vec[j].get(w, 0) for w, x in vec[i].items()), j) for j in vec if j != i]
        best = sorted(x for x in dots if -x[0] >= t * content.SCALE**2)[:n]
        out += [(i, j, -d / content.SCALE**2, r) for r, (d, j) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("n,t,block", [(5, 0.3, 512), (3, 0.05, 5), (20, 0.7, 3), (2, 1.0, 512)])
def test_equals_all_pairs(spark, n, t, block):
    df = spark.createDataFrame(made(), ITEM).repartition(4)
    got = content.content_neighbours(df, n, t, block)
    assert sorted(map(tuple, got.select("item_id", "other_id", "similarity", "rank").collect())) == brute(made(), n, t)


def test_common_terms_are_not_indexed(spark):
    _, vectors = content.item_vectors(spark.createDataFrame(made(), ITEM))
    row = content.index_reach(vectors, 0.5).first()
    assert row.indexed < 0.8 * row.entries
    common = {r.term for r in content.indexed_terms(vectors.where("rep like 'i%'"), 0.9).collect()}
    assert "rare1" in common


def test_unmet_items_are_candidates(spark):
    items = spark.createDataFrame([("old", "red cotton shirt"), ("new", "red cotton shirt xl"), ("other", "steel pan")], ITEM)
    train = spark.createDataFrame([("u", "old", 5.0), ("v", "old", 1.0)], "user_id string, item_id string, rating float")
    users = spark.createDataFrame([("u",), ("v",), ("w",)], "user_id string")
    got = content.recommend_by_content(train, items, users, 5).collect()
    assert [(r.user_id, r.item_id, r.rank) for r in got] == [("u", "new", 1)]


def test_empty_and_bad_threshold(spark):
    none = spark.createDataFrame([], ITEM)
    assert content.content_neighbours(none).collect() == []
    with pytest.raises(ValueError):
        content.content_neighbours(none, threshold=0)
