import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feedloom.llm import quality_classifier, quality_rules
from feedloom.llm import text as tx

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[k:k + 3]) for k in range(len(words) - 2))
    covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k:k + 3])] > 1 for j in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed)


@pytest.mark.parametrize("table", ["hostile", "clashing"])
def test_base_counts_equal_brute_force(request, table):
    df = request.getfixturevalue(table)
    got = quality_rules.quality_rules(df, df.limit(0)).collect()
    want = [(r.doc_id, *base_counts(r.text)) for r in df.select("doc_id", "text").collect()]
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, *(r[n] for n in BASE))) for r in got)
    assert all(r.log_ratio == 0 and r.kept == (not r.base_failed) for r in got)  # no trusted text: the model says nothing


def test_lines_and_symbols(spark):
    texts = ["a b\na b\n\n\na b \nc", "#*$%&|<>", "x\ny\nx", "é é é\né é é", "\n", "a\r\na\r\na"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r[n] for n in BASE) for r in quality_rules.quality_rules(df, df.limit(0)).collect()}
    assert got == {i: base_counts(t) for i, t in enumerate(texts)}


def corpus(n, seed=0):
    r = random.Random(seed)
    good = ["g" + str(k) for k in range(300)]
    bad = [w.upper() + "!!" for w in good]
    rows = []
    for i in range(n):
        junk = i % 6 == 5
        rows.append((i, " ".join(r.choices(bad if junk else good, k=r.randint(60, 200))), int(not junk)))
    return rows


def test_ratio_rejects_unlike_documents_and_keeps_clean_ones(spark):
    rows = corpus(240)
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    trusted = df.where("quality = 1 and doc_id % 3 = 0")
    got = {r.doc_id: r for r in quality_rules.quality_rules(df, trusted).collect()}
    for i, _, q in rows:
        if not got[i].base_failed:
            assert got[i].kept == bool(q)
    again = {r.doc_id: r.log_ratio for r in quality_rules.quality_rules(df.repartition(7), trusted).collect()}
    assert all(abs(again[i] - got[i].log_ratio) < 1e-9 for i in again)


def cell(words, cells):
    """The hashed cell of one n-gram, made on its own."""
    data, offsets = tx.raw(pa.array([" ".join(words)], pa.large_string()))
    starts, ends, first = tx.word_spans(data, offsets)
    grams, _ = tx.gram_hashes(tx.word_hashes(data, starts, ends), first, len(words))
    return int(grams[0]) % cells


def grams(text, sizes):
    words = WORD.findall(text or "")
    return [tuple(words[k:k + n]) for n in sizes for k in range(len(words) - n + 1)]


def test_ratio_and_verdict_equal_brute_force(spark):
    rows = corpus(60, 4) + [(60, None, 0), (61, "", 0), (62, "g1 g2 " * 40, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int").repartition(3)
    got = {r.doc_id: r for r in quality_rules.quality_rules(df, df.where("quality = 1 and doc_id % 3 = 0")).collect()}
    memo = {}
    held = {i: Counter(memo.setdefault(g, cell(g, quality_rules.BUCKETS)) for g in grams(t, quality_rules.GRAMS)) for i, t, _ in rows}
    raw, target = Counter(), Counter()
    for i, _, q in rows:
        raw.update(held[i])
        target.update(held[i] if q == 1 and i % 3 == 0 else {})
    scale = sum(target.values()) / sum(raw.values())
    for i, t, _ in rows:
        parts = [n * math.log((target[c] + quality_rules.PSEUDO) / (max(raw[c] - n, 0) * scale + quality_rules.PSEUDO)) for c, n in held[i].items()]
        want = sum(parts) / max(sum(held[i].values()), 1)
        assert got[i].log_ratio == pytest.approx(want, abs=1e-9)
        assert got[i].kept == (not base_counts(t)[-1] and got[i].log_ratio >= quality_rules.THRESHOLD)


def test_rules_on_empty_table(nothing):
    assert quality_rules.quality_rules(nothing, nothing).collect() == []


def test_classifier_held_out_accuracy(spark):
    rows = corpus(600, 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int").select("doc_id", "text")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    out = quality_classifier.held_out(F.col("doc_id"))
    model = quality_classifier.fit(docs, labels.where(~out))
    got = quality_classifier.score(docs, model).withColumn("out", out).collect()
    truth = {i: q for i, _, q in rows}
    held = [r for r in got if r.out]
    assert {r.doc_id for r in held} == {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_sample_bound_is_a_parameter(spark):
    rows = corpus(300, 2)
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int").select("doc_id", "text")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(None, 1), (3, 7)], "doc_id long, quality int")
    model = quality_classifier.fit(docs, labels, sample_rows=60)
    got = quality_classifier.score(docs, model).collect()
    assert np.mean([r.predicted == rows[r.doc_id][2] for r in got]) > 0.95


def test_scores_equal_brute_force(spark):
    rows = corpus(120, 3) + [(120, None, 1), (121, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int").select("doc_id", "text").repartition(3)
    model = quality_classifier.fit(docs, spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int"))
    memo, held = {}, {i: set() for i, _, _ in rows}
    for i, t, _ in rows:
        held[i] = {memo.setdefault(g, cell(g, quality_classifier.CELLS)) for g in grams(t, (1, 2))}
    counts = [Counter(c for i, _, q in rows if q == k for c in held[i]) for k in (0, 1)]
    totals = [sum(c.values()) + quality_classifier.CELLS * quality_classifier.SMOOTHING for c in counts]
    for i, _, _ in rows:
        square = sum((math.log((counts[1][c] + 1) / totals[1]) - math.log((counts[0][c] + 1) / totals[0])) ** 2 for c in held[i])
        margin = sum(model.weights[c] for c in held[i]) / math.sqrt(max(square, 1e-12)) + model.bias
        want = 1 / (1 + math.exp(-quality_classifier.SHARPNESS * margin))
        got = quality_classifier.score(docs.where(F.col("doc_id") == i), model).first() if i % 17 == 0 or i > 119 else None
        assert got is None or (got.score == pytest.approx(want, abs=1e-9) and got.predicted == int(want >= 0.5))


def test_repeated_labels_and_long_texts_keep_the_sample_bounded(spark, monkeypatch):
    rows = corpus(80, 6)
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int").select("doc_id", "text")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(0, 1)] * 300 + [(5, 0)] * 200, "doc_id long, quality int")
    seen = []
    descent = quality_classifier.dual_coordinate_descent
    monkeypatch.setattr(quality_classifier, "dual_coordinate_descent", lambda r, *a: seen.append(r) or descent(r, *a))
    quality_classifier.fit(docs, labels, sample_rows=100)
    monkeypatch.setattr(quality_classifier, "SAMPLE_CELLS", 4000)
    quality_classifier.fit(docs, labels.limit(80), sample_rows=100)
    assert len(seen[0]) <= 100 and 1 < len(seen[1]) < 80 and sum(map(len, seen[1])) <= 4000


@pytest.mark.parametrize("table", ["hostile", "clashing", "nothing"])
def test_scores_of_odd_rows(request, spark, table):
    df = request.getfixturevalue(table)
    labels = spark.createDataFrame([(1, 1), (12, 0), (13, 0), (10, 1)], "doc_id long, quality int")
    got = quality_classifier.score(df, quality_classifier.fit(df, labels)).collect()
    assert sorted(map(repr, (r.doc_id for r in got))) == sorted(map(repr, (r.doc_id for r in df.select("doc_id").collect())))
    assert all(r.score == r.score and 0 <= r.score <= 1 for r in got)


def test_dual_coordinate_descent_separates():
    rows = [np.array(x, np.int32) for x in ([0, 1], [0, 2], [3, 4], [3, 5])]
    w, b = quality_classifier.dual_coordinate_descent(rows, np.ones(6), np.array([1.0, 1, -1, -1]), np.ones(4))
    margins = [w[r].sum() / np.sqrt(2) + b for r in rows]
    assert margins[0] > 0.5 and margins[1] > 0.5 and margins[2] < -0.5 and margins[3] < -0.5
