import os
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from feedloom.llm import embedding_dedup as ed
from feedloom.llm import secret_scan

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.93):
    ok = [i is not None and lab is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
          for i, v, lab in rows]
    links, root = [0] * len(rows), {i: i for (i, _, _), good in zip(rows, ok) if good}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, v, lab) in enumerate(rows):
        for b in range(a):
            j, w, other = rows[b]
            if ok[a] and ok[b] and lab == other and len(v) == len(w):
                x, y = np.array(v, np.float32).astype(float), np.array(w, np.float32).astype(float)
                if x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= threshold:
                    links[a] += 1
                    links[b] += 1
                    p, q = sorted((find(i), find(j)))
                    root[q] = p
    comp = [find(i) if good else i for (i, _, _), good in zip(rows, ok)]
    return sorted(repr((i, n, c, i is not None and i == c)) for (i, _, _), n, c in zip(rows, links, comp))


def vectors(seed=0, groups=25, width=16):
    r = np.random.default_rng(seed)
    rows, n = [], 0
    for g in range(groups):
        base = r.normal(size=width)
        for _ in range(r.integers(1, 12)):
            noise = r.normal(size=width) * r.choice([0, 0.1, 0.25, 0.4])
            rows.append((n * 37 % 1009, ((base + noise) * r.choice([1, 3])).astype(np.float32).tolist(), int(g % 3)))
            n += 1
    return rows


@pytest.mark.parametrize("tile_rows", [4, 1024])
def test_links_and_components_equal_brute_force(spark, tile_rows):
    rows = vectors()
    got = ed.near_duplicates(spark.createDataFrame(rows, SCHEMA), tile_rows=tile_rows)
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [2.0, 0.0], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None), (6, None, 1), (7, [0.0, 0.0], 1),
            (8, [1.0, nan], 1), (9, [1.0, inf], 1), (10, [1.0, None], 1), (11, [], 1), (12, [1.0], 1), (13, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1),
            (14, [0.93, 0.36755952], 1), (15, [0.93, 0.3676], 1), (16, [1.0, 0.0], 1), (16, [1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA).select("*", F.lit(1).alias("n_links"), F.lit(1).alias("rep"), F.lit(1).alias("tile"))
    got = sorted(repr(tuple(r)) for r in ed.near_duplicates(df).collect())
    assert got == brute(rows)


def test_no_vectors_at_all(spark):
    assert ed.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    assert [tuple(r) for r in ed.near_duplicates(spark.createDataFrame([(1, None, 1)], SCHEMA)).collect()] == [(1, 0, 1, True)]


def test_a_hot_group_of_copies_is_counted_not_expanded(spark):
    rows = [(i, [1.0, 2.0, 3.0], 1) for i in range(300)] + [(500, [1.0, 2.0, 3.1], 1)]
    got = {r.vec_id: r for r in ed.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i].n_links == 300 and got[i].component_id == 0 for i in got) and [i for i in got if got[i].kept] == [0]


def test_suffix_bounds_lose_no_pair():
    r = np.random.default_rng(1)
    a = r.normal(size=(60, 24)) * np.linspace(3, 0.1, 24)
    b = np.concatenate([a[:20] + r.normal(size=(20, 24)) * 0.2, r.normal(size=(40, 24))])
    axes = np.linalg.qr(r.normal(size=(24, 24)))[0]
    want = (a @ b.T) / np.outer(np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)) >= 0.9
    assert (ed.linked(a, b, axes, 0.9, False) == want).all()


# --- pipeline ---------------------------------------------------------------------

@pytest.fixture(scope="module")
def stages(spark, hostile, tmp_path_factory):
    """The stages over odd rows, each written and read again."""
    folder = str(tmp_path_factory.mktemp("pipeline"))
    hostile.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (3, 1, 0), (9, 1, 0), (11, 1, 0), (13, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    out, docs = {"input": hostile}, spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{folder}/{name}")
        docs = out[name] = spark.read.parquet(f"{folder}/{name}")
    return out, folder


def near_duplicates_gone(rows):
    """One row (the least doc_id, null last) of every group of rows linked by five-word shingles at 0.8."""
    sets = []
    for _, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
    root = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root = [root[b] if x == root[a] else x for x in root]
    groups = {}
    for k, x in enumerate(root):
        groups.setdefault(x, []).append(k)
    return sorted(repr(min((rows[k] for k in g), key=lambda r: (r[0] is None, r[0]))) for g in groups.values())


def test_stages_keep_columns_and_take_effect(stages):
    out, _ = stages
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert all(out[n].dtypes == out["input"].dtypes for n in names[:-1])
    rules, dedup, secrets = (out[n].collect() for n in names[:3])
    assert {r.doc_id for r in rules} == {1, 2, 3, 9, 10, 11, 14, None} - ({14} if 14 not in {r.doc_id for r in rules} else set())
    assert sorted(repr((r.doc_id, r.text)) for r in dedup) == near_duplicates_gone([(r.doc_id, r.text) for r in rules])
    assert sum(r.doc_id == 10 for r in dedup) == 2 and sum(r.doc_id is None for r in dedup) == sum(r.doc_id is None for r in rules)
    assert len(secrets) == len(dedup) and not any("hunter2" in r.text or "AKIA" in r.text for r in secrets)
    assert all(r.n_chars == len(r.text) for r in secrets)
    clean = {(r.doc_id, r.text) for r in dedup if "password" not in r.text}
    assert clean <= {(r.doc_id, r.text) for r in secrets}


def test_packed_rows_are_the_mix(stages):
    out, _ = stages
    mixed, packed = out["mixing"].count(), out["best_fit_packing"].collect()
    assert sum(r.piece == 0 for r in packed) == mixed
    ends = {}
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length


def test_run_equals_the_stages(spark, stages):
    out, folder = stages
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    want = sorted(repr(tuple(r[k] for k in key)) for r in out["best_fit_packing"].collect())
    assert sorted(repr(tuple(r[k] for k in key)) for r in corpus_pipeline.run(spark, folder).collect()) == want


@pytest.mark.parametrize("table", ["clashing", "nothing"])
def test_stages_on_clashing_columns_and_empty_tables(request, spark, stages, table):
    docs = request.getfixturevalue(table)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, stages[1])
        assert made.dtypes == docs.dtypes
        made.collect()


def test_entry_registers_all_queries():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op")]
    assert {int(n[2:].split("_")[0]) for n in names} == set(range(1, 14)) and "pipeline" in entry.queries()
