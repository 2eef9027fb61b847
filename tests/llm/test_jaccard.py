import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedloom.llm import jaccard_join as jj
from feedloom.llm.components import components

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, percent=85):
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[a + 1:]:
            if i is not None and j is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return sorted(repr((i, len(s), None if i is None else find(i))) for i, s in sets)


def got(df):
    return sorted(repr(tuple(r)) for r in jj.jaccard_components(df, words=4, percent=85).collect())


@pytest.mark.parametrize("table", ["hostile", "clashing", "nothing"])
def test_odd_rows(request, table):
    df = request.getfixturevalue(table)
    assert got(df) == brute([tuple(r) for r in df.select("doc_id", "text").collect()])


def near_copies(groups, members, words, seed, edits):
    r = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"w{r.randint(0, 5000)}" for _ in range(words)]
        for _ in range(members):
            w = list(base)
            for _ in range(r.randint(0, edits)):
                w[r.randrange(words)] = f"x{r.randint(0, 5000)}"
            rows.append((len(rows) * 3 % 1009 + len(rows) * 1009, " ".join(w)))
    return rows


@pytest.mark.parametrize("blocks", [8, 1024])
def test_near_copies_chains_and_large_groups(spark, monkeypatch, blocks):
    monkeypatch.setattr(jj, "BLOCK_CLASSES", blocks)  # clusters of many blocks, both rounds
    rows = near_copies(6, 40, 120, 1, 5) + [(10**7 + i, t) for i, t in near_copies(30, 3, 60, 2, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(df) == brute(rows)


def test_a_hot_group_of_copies_is_one_class(spark):
    rows = [(i, "same words in every one of these texts here") for i in range(500)] + [(600, "other words are in this one text here")]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_threshold_is_exact(spark):
    words = [f"t{k}" for k in range(203)]  # 200 shingles
    rows = [(1, " ".join(words))]
    for k in range(10, 50):
        rows.append((k, " ".join(words[:-k] + [f"e{k}_{j}" for j in range(k)])))
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.integers(0, 60), min_size=1, max_size=40), min_size=1, max_size=40), st.sampled_from([50, 70, 85]))
def test_tree_loses_no_link(sets, percent):
    own = [np.unique(np.array(s, np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for s in sets]
    sizes = np.array([len(s) for s in own])
    points = np.stack([jj.count_vector(s, 32) for s in own])
    tree = jj.CountTree(points, sizes)
    for q, s in enumerate(own):
        found = set(tree.reachable(points[q], int(sizes[q]), percent).tolist())
        for p, t in enumerate(own):
            both = len(np.intersect1d(s, t))
            if sizes[p] <= sizes[q] and 100 * both >= percent * (sizes[p] + sizes[q] - both):
                assert p in found


def test_edges_of_runs_across_batches():
    r = np.random.default_rng(0)
    key = np.sort(r.integers(0, 40, 600))
    key[100:160] = key[100]
    key = np.sort(key)
    rep, n = r.permutation(600).astype(np.int64), np.full(600, 50, np.int64)
    for size in (1, 7, 64, 600):
        batches = [pa.RecordBatch.from_arrays([pa.array(x[k:k + size]) for x in (key, rep, n)], ["key", "rep", "n"]) for k in range(0, 600, size)]
        root = {x: x for x in rep.tolist()}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for b in jj._edges(85)(iter(batches)):
            for e in b.to_pylist():
                root[find(e["u"])] = find(e["v"])
        for k in np.unique(key):
            assert len({find(x) for x in rep[key == k].tolist()}) == 1


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(0, 60)] + [(100, x) for x in range(101, 140)] + [(140, 139), (300, 200), (5, 5)]
    rows = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert rows == {**{k: 0 for k in range(61)}, **{k: 100 for k in range(100, 141)}, 300: 200, 200: 200}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_sets_do_not_depend_on_slices_and_take_memory_of_a_small_one():
    r = random.Random(3)
    pool = [f"w{k}" for k in range(3000)]
    texts = [" ".join(r.choices(pool, k=r.choice([0, 1, 2, 3, 400]))) for _ in range(6000)]
    column = pa.array(texts, pa.large_string())
    assert len("".join(texts)) > 2 * jj.tx.SLICE_BYTES
    jj.tx.powers(jj.tx.SLICE_BYTES)  # a table that workers keep
    tracemalloc.start()
    grams, begin = jj.shingle_sets(column, 4)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 20 * column.nbytes
    assert len(begin) == len(texts) + 1 and begin[0] == 0 and begin[-1] == len(grams)
    for k in (0, 1, 2999, 5999):
        alone, _ = jj.shingle_sets(column.slice(k, 1), 4)
        assert alone.tolist() == grams[begin[k]:begin[k + 1]].tolist()
    nothing, first = jj.shingle_sets(column.slice(0, 0), 4)
    assert not len(nothing) and first.tolist() == [0]
