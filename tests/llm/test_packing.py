import gc
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from feedloom.llm import packing
from feedloom.llm import text as tx

PATH = public_tokenizers.path("word_bpe_49k.json")


def check_packed(rows, capacity):
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)  # gapless from 0
        ends[r.sequence_id] = r.offset + r.length
    assert all(e <= capacity for e in ends.values())
    return len(ends)


@pytest.mark.parametrize("table", ["hostile", "clashing"])
def test_pieces_have_the_tokenizers_ids_and_fill_sequences(request, table):
    df = request.getfixturevalue(table)
    rows = packing.pack_documents(df, PATH).collect()
    encoder, want = Tokenizer.from_file(PATH), []
    for r in df.select("doc_id", "text").collect():
        ids = np.array(encoder.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
        for k in range(0, len(ids), 4096):
            part = ids[k:k + 4096]
            want.append((r.doc_id, k // 4096, k, len(part), zlib.crc32(part.tobytes())))
    assert sorted(map(repr, want)) == sorted(repr(tuple(r[:5])) for r in rows)
    total = sum(r.length for r in rows)
    assert check_packed(rows, 4096) <= -(-total // 4096) + 1


def test_special_tokens_in_a_text_are_what_the_tokenizer_makes_of_them(spark):
    text = "a <|endoftext|>b <|startoftext|> ć ́d"
    (row,) = packing.token_pieces(spark.createDataFrame([(1, text)], "doc_id long, text string"), PATH, with_ids=True).collect()
    ids = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids + [1]
    assert np.frombuffer(row.ids, "<u4").tolist() == ids


def test_empty_table(nothing):
    assert packing.pack_documents(nothing, PATH).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 30), min_size=1, max_size=25))
def test_plans_hold_every_piece_once(histogram):
    plan = packing.rounded_plan(histogram, packing.fractional_plan(histogram, 60, 40), 60)
    used = {}
    for found, times in plan:
        assert sum(x * n for x, n in found.items()) <= 60 and times > 0
        for x, n in found.items():
            used[x] = used.get(x, 0) + n * times
    assert used == histogram
    table = packing.slots(plan)
    seen = set()
    for length, n in histogram.items():
        own = table[table[:, 0] == length]
        for rank in range(n):
            row = own[np.searchsorted(own[:, 1], rank, "right") - 1]
            k = rank - row[1]
            place = (row[2] + k // row[3], row[4] + k % row[3] * length)
            assert place not in seen
            seen.add(place)


def test_knapsack_finds_the_best_configuration():
    lengths, prices = np.array([3, 5, 7]), np.array([3.0, 5.5, 7.1])
    found = packing.best_configuration(lengths, prices, 17)
    best = max((a * 3.0 + b * 5.5 + c * 7.1) for a in range(6) for b in range(4) for c in range(3) if 3 * a + 5 * b + 7 * c <= 17)
    assert sum(prices[list(lengths).index(x)] * n for x, n in found.items()) == pytest.approx(best)


def test_few_large_lengths_pack_as_well_as_can_be(spark):
    rows = [(i, x) for i, x in enumerate([60] * 10 + [40] * 10 + [30] * 10 + [70] * 10)]
    df = spark.createDataFrame(rows, "k long, length long")
    assert check_packed(packing.pack(df, ["k"], 100).collect(), 100) == 20


def test_thousands_of_lengths_are_covered_by_the_program():
    lengths = np.clip(np.random.default_rng(1).lognormal(6.2, 1.1, 20000), 1, 4096).astype(int)
    histogram = dict(zip(*(v.tolist() for v in np.unique(lengths, return_counts=True))))
    plan = packing.fractional_plan(histogram, 4096)
    covered = {4096: histogram[4096]}
    for found, times in plan:
        for x, n in found.items():
            covered[x] = covered.get(x, 0) + n * times
    assert len(histogram) > 2500 and covered == histogram
    sequences = sum(times for _, times in packing.rounded_plan(histogram, plan, 4096))
    assert sequences <= 1.002 * -(-int(lengths.sum()) // 4096)


def made_histograms():
    r = np.random.default_rng(3)
    yield np.clip(r.lognormal(6.2, 1.1, 40000), 1, 4096)
    yield r.integers(1366, 2200, 20000)
    yield r.integers(1800, 2400, 20000)
    yield r.choice([700, 900, 1100, 1300, 1500, 1900, 2500], 20000)
    yield r.integers(1000, 1700, 20000)


@pytest.mark.parametrize("lengths", list(made_histograms()), ids=["lognormal", "thirds", "halves", "seven", "thirds-and-quarters"])
def test_never_more_sequences_than_best_fit(lengths):
    histogram = dict(zip(*(v.tolist() for v in np.unique(lengths.astype(int), return_counts=True))))
    used = sum(times for _, times in packing.best_plan(histogram, 4096))
    assert used <= sum(times for _, times in packing.rounded_plan(histogram, [], 4096))
    assert packing.sequences_needed(histogram, 4096) <= used


@settings(max_examples=30, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 6), min_size=1, max_size=5))
def test_the_bound_is_one(histogram):
    assert packing.sequences_needed(histogram, 40) <= sum(times for _, times in packing.best_plan(histogram, 40))


def words_of(text):
    data, offsets = tx.raw(pa.array([text], pa.large_string()))
    starts, ends, _ = tx.word_spans(data, offsets)
    return data, starts, ends


def test_runs_met_again_are_not_encoded_again_when_others_are_forgotten(monkeypatch):
    monkeypatch.setattr(packing, "MEMO", 64)
    memo, asked = packing.WordIds(PATH), []
    encode = memo._run_ids
    monkeypatch.setattr(memo, "_run_ids", lambda data, starts, ends: asked.extend(
        data[a:b].tobytes().decode() for a, b in zip(starts, ends)) or encode(data, starts, ends))
    common = "The QUICK é, brown fox."
    letters = "abcdefghijklmnopqrst"
    for n in range(12):
        text = " ".join([common] + [f"{letters[n]}{x}{y}" for x in letters[:4] for y in letters[:5]])
        ids, edges = memo.encode(*words_of(text))
        assert ids.tolist() == Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
        assert edges[-1] == len(ids) and len(edges) == len(text.split()) + 1
        assert len(memo.known) <= 64
    assert [asked.count(w) for w in ("the", "quick", "é", ",", "brown", "fox", ".")] == [1] * 7  # parts of words, lower-cased


def test_a_known_run_takes_few_bytes():
    r = random.Random(5)
    runs = {"".join(r.choices("abcdefghij", k=9)) for _ in range(30000)}
    memo = packing.WordIds(PATH)
    given = words_of(" ".join(sorted(runs)))
    tracemalloc.start()
    memo.encode(*given)
    gc.collect()
    kept, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert kept < 100 * len(runs)


@pytest.mark.parametrize("direct", [True, False])
def test_runs_have_the_ids_of_the_whole_text(direct, monkeypatch):
    text = ("İx É × ÷a À-b ß ẞ éÀÞ. THE. the, <|ENDOFTEXT|>x DON'T a'b a<b x1 1x é\u0301 E\u0301 ...ñ ¿qué? «x» Ã Â Ã© )a a) "
            "語 héLLO—wörld ÿŸ ... .a. a.b ,, ")
    memo = packing.WordIds(PATH)
    assert memo.spelled is not None
    if not direct:
        memo.spelled = None
    ids, _ = memo.encode(*words_of(text))
    assert ids.tolist() == Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
