"""Spelling variants against all pairs of words, one by one."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedloom.llm import spelling_variants as sv


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def counts(rows, least_points=6, least_count=5):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= least_points and k >= least_count}


def brute(words, ratio=5):
    out = {}
    for w, n in words.items():
        near = sorted((x for x in words if one_edit(w, x)), key=lambda x: (-words[x], x))
        form = near[0] if near and words[near[0]] >= ratio * n else None
        out[w] = (form, n, len(near), words[form] if form else None)
    rows = []
    for w, (form, n, near, form_n) in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        rows.append((w, form, root, n, near, form_n))
    return sorted(map(repr, rows))


def made_words(seed=1, count=260):
    r = random.Random(seed)
    words = {}
    for _ in range(count // 8):
        base = "".join(r.choices("abcé", k=r.randint(6, 12)))
        words[base] = r.choice([5, 30, 700, 90000])
        for _ in range(7):
            k = r.randrange(len(base))
            base = r.choice([base[:k] + base[k + 1:], base[:k] + r.choice("abcéÿ÷") + base[k:], base[:k] + r.choice("abcé") + base[k + 1:]])
            if len(base) >= 6:
                words.setdefault(base, r.choice([5, 6, 25, 125, 3000]))
    return words


@pytest.mark.parametrize("block_words", [sv.BLOCK_WORDS, 40, 6])
def test_equals_all_pairs_at_every_depth_of_blocks(spark, block_words, monkeypatch):
    words = made_words() | {"x" * 300: 5, "x" * 301: 900, "x" * 299 + "y": 40, "aaaaaa": 6, "aaaaaaa": 31, "aaaaab": 6}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = sv.variants(df, block_words=block_words)
    assert sorted(repr(tuple(r)) for r in got.select("word", "form", "root", "n", "n_near", "form_n").collect()) == brute(words)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abé", min_size=1, max_size=9), min_size=1, max_size=150, unique=True))
def test_bit_sliced_recurrences(words):
    index = sv.BitSliced(words)
    for m in {len(w) for w in words}:
        own = [w for w in words if len(w) == m]
        letters = np.array([[ord(c) for c in w] for w in own], np.int64)
        among = index.range(np.zeros(len(own), np.int64), np.full(len(own), len(words)))
        hits = index.near(letters, among)
        bits = np.unpackbits(hits.view(np.uint8), axis=1, bitorder="little")
        for w, row in zip(own, bits):
            near = {words[k] for k in np.flatnonzero(row)}
            assert near - {w} == {x for x in words if one_edit(w, x)}


def test_words_and_their_drawn_deletions(spark):
    r = random.Random(7)
    pool = ["Spelling", "spelling", "SPELLINGS", "ÀÉtrange", "àétrange", "x×÷yzw", "short", "longer-word", "it's", "naïveté"]
    rows = [(k, " ".join(r.choices(pool, k=60))) for k in range(150)] + [(None, "spelling " * 6), (None, None), (5, ""), (6, "spelling123spelling")]
    got = sv.word_counts(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    want = counts(rows)
    assert {x.word: x.n for x in got.collect()} == want
    assert any(w not in {"spelling", "spellings", "longer", "naïveté"} and "spelling".startswith(w[:2]) for w in want)


@pytest.mark.parametrize("name", ["hostile", "clashing", "nothing"])
def test_defined_results(request, name):
    df = request.getfixturevalue(name)
    want = brute(counts([(r.doc_id, r.text) for r in df.collect()])) if name == "nothing" else None
    words = sv.word_counts(df)
    got = {r.word: r.n for r in words.collect()}
    assert got == counts([(r.doc_id, r.text) for r in df.collect()])
    rows = sv.variants(words)
    assert rows.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert rows.count() == len(got) and (want is None or want == [])


def test_a_ratio_of_one_would_go_round(spark):
    with pytest.raises(ValueError):
        sv.variants(spark.createDataFrame([], "word string, n long"), ratio=1)
