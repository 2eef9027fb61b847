"""Cross-tokenizer alignment against whole texts, encoded and compared one by one."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedloom.llm import text as tx
from feedloom.llm import tokenizer_alignment as ta

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def ends(ids, pieces):
    out, at = [], 0
    for i in ids:
        at += len(pieces[i])
        out.append(at)
    return out


_plain = []


def plain():
    if not _plain:
        _plain.append((ta.ByteLevel(A), ta.Pieces(B)))
    return _plain[0]


def read(text):
    """(ids of A, ids of B, groups, links) of one whole text."""
    first, second = plain()
    none = ([], [], [], [])
    if not text:
        return none
    want = (" " + text).encode()
    a, b = first.tokenizer.encode(" " + text, add_special_tokens=False).ids, second.model.encode(text)
    if any(b"".join(t.pieces[i] for i in ids) != want for t, ids in ((first, a), (second, b))):
        return none
    a_ends, b_ends = ends(a, first.pieces), ends(b, second.pieces)
    at_a, at_b = ({e: k for k, e in enumerate(x)} for x in (a_ends, b_ends))
    groups, links, i, j = [], [], 0, 0
    for e in sorted(set(a_ends) & set(b_ends)):
        links.append((a[at_a[e]], b[at_b[e]]))
        groups.append(",".join(map(str, a[i:at_a[e] + 1])) + "|" + ",".join(map(str, b[j:at_b[e] + 1])))
        i, j = at_a[e] + 1, at_b[e] + 1
    return a, b, groups, links


def brute(rows):
    found = [(i, *read(t)) for i, t in rows]
    count = Counter(x for *_, links in found for x in links)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    out = [(i, len(a), len(b), len(groups), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "") for i, a, b, groups, links in found]
    documents = Counter(x for *_, links in found for x in set(links))
    return out, {(*x, n, documents[x]) for x, n in count.items()}


STRANGE = ["<|endoftext|> <s> </s> <unk>", "two  spaces", " leads", "trails ", "a\n b\n\n  c", "tab\tand nbsp 　wide", "▁mark", "x▁ y", "語の 長い文 です。 もう一つ",
           "it's we'll 'tis 'S", "1234567 8 9,10", "emoji 👩‍👩‍👧 ok", "\x00 nul \x1c sep \x85 nel", " ogham ᠎mvs ​zw", "é combining", "\n", "\n\n", "a\n", "a \n b", "ends  line",
           "<0x41> <0x0A>", "x" * 3000, "﻿bom �", "é è ’quote’ —dash– …", "a" + " b" * 300]


def made_rows():
    r = random.Random(4)
    words = ["the", "The", "tokenizer", "aligns", "été", "naïve,", "x9", "...", "don't", "(see", "below)", "\n", "語"]
    rows = [(k, " ".join(r.choices(words, k=r.randint(1, 80))).strip()) for k in range(60)]
    return rows + [(100 + k, t) for k, t in enumerate(STRANGE)] + [(200, None), (201, ""), (None, "the the"), (3, "the The"), rows[5]]


def same(df, rows):
    result = ta.align(df, A, B)
    docs, pairs = brute(rows)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(repr, docs)) == sorted(repr(tuple(r)) for r in result.documents.select(*names).collect())
    assert pairs == {tuple(r) for r in result.pairs.select("a", "b", "links", "documents").collect()}
    return result


def test_equals_whole_texts(spark):
    rows = made_rows()
    same(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows)


def test_small_chunks_slices_and_memory(spark, monkeypatch):
    first, second = plain()
    rows = [(k, t) for k, (_, t) in enumerate(made_rows()) if t and "\x00" not in t]
    aligner = ta.Aligner(A, B)
    column = pa.array([t for _, t in rows], pa.large_string())
    whole = ta._slice(aligner, column)
    monkeypatch.setattr(ta, "MEMO", 8)
    small = ta.Aligner(A, B)
    for k in range(len(rows)):
        one = ta._slice(small, column.slice(k, 1))
        assert [x[0] for x in one[:4]] == [x[k] for x in whole[:4]]


@pytest.mark.parametrize("name", ["hostile", "clashing", "nothing"])
def test_defined_results(request, name):
    df = request.getfixturevalue(name)
    same(df, [(r.doc_id, r.text) for r in df.collect()])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([" ", "\n", "a", "Bc", "'s", "7", " ", "é", "語", "—", "　", "!", "\t", " ", "👍"]), min_size=1, max_size=14).map("".join))
def test_units_are_never_crossed(text):
    first, second = plain()
    data, offsets = tx.raw(pa.array([" " + text], pa.large_string()))
    starts, _ = ta.units(data, offsets)
    a, b, groups, links = read(text)
    if a:
        assert set(starts[1:].tolist()) <= set(ends(a, first.pieces)) & set(ends(b, second.pieces))
    whole = first.encode(" " + text)
    assert set(starts[1:].tolist()) <= set(ends(whole, first.pieces))


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 300), st.lists(st.tuples(st.integers(0, 5), st.integers(0, 299)), max_size=400))
def test_postings_round_trip(rows, links):
    links = [(p, d % rows) for p, d in links]
    found = ta.postings(np.array([p for p, _ in links], np.int64), np.array([d for _, d in links], np.int64), rows)
    count = Counter(links)
    got = Counter()
    pair = found["pair"].to_pylist()
    for posting, doc, times in ta.planes_of(found["planes"], found["bits"], rows):
        for p, d, n in zip(posting.tolist(), doc.tolist(), times.tolist()):
            got[pair[p], d] += n
    assert got == count
    assert dict(zip(pair, found["links"].to_pylist())) == Counter(p for p, _ in links)
    assert dict(zip(pair, found["documents"].to_pylist())) == Counter(p for p, _ in count)
