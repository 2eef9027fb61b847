import hashlib
import random
import re
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedloom.llm import mixing, secret_scan, suffix_dedup, token_counts
from feedloom.llm.induced_sort import Sorter

TABLES = ["hostile", "clashing", "nothing"]


def same_rows(df, want):
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in df.collect())


# --- mixing --------------------------------------------------------------------

def test_capped_shares_reshare_until_none_is_above():
    sizes, weights = [100, 10, 50, 0], [3, 1, 2, 3]
    got = mixing.capped_shares(Fraction(240), sizes, weights)
    assert sum(got) == 240 and all(t <= 2 * s for t, s in zip(got, sizes))
    free = [t / w for t, w, s in zip(got, weights, sizes) if t < 2 * s]
    assert len(set(free)) <= 1 and all(2 * s <= w * free[0] for t, w, s in zip(got, weights, sizes) if t == 2 * s and free)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 200), st.lists(st.integers(0, 50), min_size=1, max_size=8))
def test_seats_go_to_the_highest_quotients(seats, weights):
    got = mixing.sainte_lague(seats, [Fraction(w) for w in weights])
    want = [0] * len(weights)
    if any(weights):
        for _ in range(seats):
            best = max(range(len(weights)), key=lambda i: (Fraction(weights[i], 2 * want[i] + 1), -i))
            want[best] += 1
    assert got == want


def test_shard_quotas_equal_the_sequential_rule(spark):
    r = random.Random(3)
    rows = [(s, k, r.randint(0, 4000), 300 + s) for s in range(4) for k in range(12)]
    got = mixing._shard_quotas(spark.createDataFrame(rows, "m_source int, m_shard long, shard_size long, seats long")).collect()
    for s in range(4):
        sizes = [x[2] for x in rows if x[0] == s]
        want = mixing.sainte_lague(300 + s, [Fraction(x) for x in sizes])
        own = {x.m_shard: x.quota for x in got if x.m_source == s}
        assert [own.get(k, 0) for k in range(12)] == want


def big_mix(spark):
    r = random.Random(5)
    rows = [(i, " ".join(["w"] * r.randint(0, 700)), r.choice(["a", "a", "a", "b", "c", "é", None])) for i in range(400)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_taken_words_meet_targets(spark):
    df = big_mix(spark)
    rows = mixing.mix(df, shard_words=5000).join(df.select("doc_id", "source"), "doc_id").collect()
    total = sum(r.size for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
        assert 0 <= r.taken <= 2 * r.size
    names = sorted(s for s in by if s is not None) + [None]
    want = mixing.capped_shares(Fraction(3, 2) * total, [by[s][0].source_size for s in names], [3, 1, 2, 3, 1][:len(names)])
    for s, t in zip(names, want):
        assert by[s][0].target == pytest.approx(float(t)) and by[s][0].source_size == sum(r.size for r in by[s])
        assert abs(sum(r.taken for r in by[s]) - t) <= 64 * (3 + by[s][0].source_size // 5000)  # a block a shard
    again = mixing.mix(df.repartition(9), shard_words=5000)
    same_rows(again, [(r.doc_id, r.size, r.source_size, r.target, r.taken) for r in rows])


def test_texts_hold_the_words_that_are_taken(spark):
    df = big_mix(spark)
    words = mixing.mixed_texts(df).select("doc_id", F.size(F.split(F.trim("text"), r"\s+")).alias("n")).groupBy("doc_id").agg(F.sum("n"))
    got = {r[0]: r[1] for r in words.collect()}
    assert {r.doc_id: r.taken for r in mixing.mix(df).collect() if r.taken} == got


@pytest.mark.parametrize("table", TABLES)
def test_mix_of_odd_rows(request, table):
    df = request.getfixturevalue(table)
    sizes = sorted(repr((r.doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")))) for r in df.select("doc_id", "text").collect())
    rows = mixing.mix(df).collect()
    assert sorted(repr((r.doc_id, r.size)) for r in rows) == sizes
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    assert mixing.mixed_texts(df).dtypes == df.dtypes and mixing.mixed_texts(df).count() >= bool(sizes)


# --- token counts ---------------------------------------------------------------

BEGIN, INSIDE = ["a", "ab", "abc", "b", "bcd", "é", "語"], ["a", "b", "c", "cd", "bc", "bcda", "é"]


def greedy(word, begin=frozenset(BEGIN), inside=frozenset(INSIDE)):
    at = n = 0
    while at < len(word):
        pieces = begin if not at else inside
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return 0
        at, n = end, n + 1
    return n


@settings(max_examples=300, deadline=None)
@given(st.text("abcdé語x", min_size=1, max_size=12))
def test_automaton_equals_greedy_longest_match(word):
    assert token_counts.LongestMatch(BEGIN, INSIDE).pieces(word) == greedy(word)


def test_real_vocabulary_equals_greedy_longest_match():
    import public_tokenizers

    begin, inside = token_counts.sentencepiece_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    automaton, sets, r = token_counts.LongestMatch(begin, inside), (frozenset(begin), frozenset(inside)), random.Random(1)
    for _ in range(3000):
        word = "".join(r.choices("abcdefghilmnorstuéñ.,1", k=r.randint(1, 15)))
        assert automaton.pieces(word) == greedy(word, *sets)


def whole_greedy(word, pieces, by_bytes=True):
    """Longest match over the word with its mark in front; uncovered characters are bytes."""
    word, at, n = "▁" + word, 0, 0
    while at < len(word):
        end = next((e for e in range(min(len(word), at + 40), at, -1) if word[at:e] in pieces), None)
        n, at = (n + 1, end) if end else (n + len(word[at].encode()), at + 1)
    return n


@settings(max_examples=300, deadline=None)
@given(st.text("abcdé語x▁", min_size=1, max_size=12), st.booleans())
def test_automaton_with_lone_start_and_bytes_equals_greedy(word, lone):
    pieces = ["▁" + p for p in BEGIN] + INSIDE + ["xab", "▁▁"] + ["▁"] * lone
    begin = [p[1:] for p in pieces if p[0] == "▁" and len(p) > 1]
    assert token_counts.LongestMatch(begin, pieces, lone, True).pieces(word) == whole_greedy(word, frozenset(pieces))


def test_whole_vocabulary_covers_every_word():
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = frozenset(model.id_to_piece(i) for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    automaton, r = token_counts.LongestMatch(*token_counts.whole_vocabulary(path)), random.Random(2)
    assert automaton.pieces("2024") == 5 == len(model.encode("2024"))
    for _ in range(3000):
        word = r.choice("1한我語é😀▁a") + "".join(r.choices("abcdeinorstué.,127我们語한국𓀀😀▁", k=r.randint(0, 15)))
        assert automaton.pieces(word) == whole_greedy(word, pieces)


@pytest.mark.parametrize("table", TABLES)
def test_counts_of_odd_rows(request, table):
    df = request.getfixturevalue(table)
    want = []
    for r in df.select("doc_id", "text").collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        pieces = [greedy(w) for w in words]
        want.append((r.doc_id, len(words), sum(p or 1 for p in pieces), sum(not p for p in pieces)))
    same_rows(token_counts.token_counts(df, (BEGIN, INSIDE)), want)


# --- suffix sorting and removal ---------------------------------------------------

@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=30).map(lambda b: bytes(x % 3 + 97 for x in b)), min_size=1, max_size=8),
       st.sampled_from([(3, 2), (7, 5), (1 << 17, 1 << 13)]), st.integers(2, 12))
def test_induced_sort_equals_sorting(tmp_path_factory, segments, sizes, depth):
    from feedloom.llm import induced_sort

    old = induced_sort.CHUNK, induced_sort.RANGE, induced_sort.HELD
    induced_sort.CHUNK, induced_sort.RANGE, induced_sort.HELD = sizes[0], sizes[1], 4 * sizes[0]
    try:
        n = len(segments)
        x = np.concatenate([np.append(np.frombuffer(s, np.uint8).astype(np.int64) + n, k) for k, s in enumerate(segments)])
        out = [(p.tolist(), c.tolist()) for p, c in Sorter(x, n, str(tmp_path_factory.mktemp("s") / "a")).falling(depth)]
    finally:
        induced_sort.CHUNK, induced_sort.RANGE, induced_sort.HELD = old
    order, shared = (sum((v[k] for v in out), []) for k in (0, 1))
    assert order == sorted((i for i in range(len(x)) if x[i] >= n), key=lambda i: x[i:].tolist(), reverse=True)
    for a, b, c in zip(order, order[1:], shared[1:]):
        same = 0
        while same < depth and max(a, b) + same < len(x) and x[a + same] == x[b + same]:
            same += 1
        assert c == same


def removed(rows, length):
    """Places ordered by (id, start), null ids last; equal places are not earlier than each other."""
    first = {}
    key = lambda i: (i is None, i or 0)
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - length + 1):
            w = b[k:k + length]
            first[w] = min(first.get(w, (key(i), k)), (key(i), k))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 2, bool)
        for k in range(len(b) - length + 1):
            if first[b[k:k + length]] < (key(i), k):
                gone[k + 1:k + 1 + length] = True
        kept = bytes(x for x, g in zip(b, gone[1:]) if not g)
        out.append((i, len(b), int(gone.sum()), int((np.diff(gone.astype(int)) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("table", TABLES)
def test_removal_on_odd_rows(request, table):
    df = request.getfixturevalue(table)
    same_rows(suffix_dedup.remove_repeats(df), removed([tuple(r) for r in df.select("doc_id", "text").collect()], 100))


def test_removal_of_passages_copies_and_periods(spark):
    r = random.Random(9)
    passage = " ".join(str(r.randint(0, 9999)) for _ in range(60))
    rows = []
    for i in range(150):
        own = " ".join(str(r.randint(0, 9999)) for _ in range(r.randint(0, 120)))
        cut = r.randint(0, len(passage) // 2)
        rows.append((i * 7 % 151, own[:r.randint(0, len(own))] + passage[cut:cut + r.randint(50, 300)] + own))
    rows += [(500 + i, rows[i][1]) for i in range(20)] + [(600, "abc" * 200), (601, "xabc" * 100), (602, " " * 400), (603, "é" * 120)]
    rows += [(700, passage), (700, passage + "!"), (701, None)]
    same_rows(suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)), removed(rows, 100))


def test_remaining_bytes_and_other_lengths(spark):
    rows = [(1, "0123456789" * 3), (2, "xx0123456789yy"), (3, "0123456789yy")]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), length=10, with_text=True)
    assert {r.doc_id: bytes(r.kept) for r in got.collect()} == {1: b"0123456789", 2: b"xxyy", 3: b""}  # what is left of 3 stands in 2
    same_rows(got.drop("kept"), removed(rows, 10))


def test_lengths_with_many_windows_a_segment(spark):
    r = random.Random(6)
    passage = "".join(r.choices("abcdefghij ", k=3000))
    rows = []
    for i in range(30):
        cut = r.randint(0, 1500)
        rows.append((i, f"{r.random()} " * 30 + passage[cut:cut + r.randint(400, 1500)] + f" {r.random()}" * 30))
    same_rows(suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), length=400), removed(rows, 400))
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), length=70000)


# --- secrets -----------------------------------------------------------------------

PATTERNS = [("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
            ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24)]


def base_spans(text):
    found = []
    for no, (kind, pattern, group, least) in enumerate(PATTERNS):
        found += [(m.start(), no, m.end(), kind) for m in re.finditer(pattern, text or "") if len(m.group(group)) >= least]
    return sorted(found)


def check_scan(df):
    rows = secret_scan.scan(df, owner=F.col("source"), repository=F.col("lang")).collect()
    want = []
    for r in df.select("doc_id", "text").collect():
        spans = base_spans(r.text)
        text = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
        want.append((r.doc_id, *(sum(s[3] == k for s in spans) for k in ("assign", "access", "hex")), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)[:5]) for r in rows)
    return rows


@pytest.mark.parametrize("table", TABLES)
def test_base_spans_of_odd_rows(request, table):
    check_scan(request.getfixturevalue(table))


def test_spans_count_code_points_and_failing_matches_consume(spark):
    texts = ["語é password='abcdef12' x", "secret=token: abcdefgh", "secret=token=abcdefgh", "token=ab token=abcdef", "API_KEY : \"k-1.2=/+_\"",
             "apikey=12345", "AKIA" + "Z" * 15, "AKIA" + "Z" * 16, "AKIAAKIA" + "9" * 16, "f" * 23, "g" + "0f" * 12 + "F", "PassWord=PASSWORD=secret",
             "tOkEn\"  =  'abcdefg", "password==abcdef", "password = \"\"abcdef", None, "😀" * 5 + "secret:sssssss😀token:ttttttt"]
    df = spark.createDataFrame([(i, t, "l", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    check_scan(df)


def test_ownership_tells_live_from_copied(spark):
    live, copied = "aB3dE6gH9jK2mN5pQ8sT1vW4yZ7bC0eF", "Zx9Yw8Vu7Ts6Rq5Po4Nm3Lk2Ji1Hg0Fe"
    rows = [(i, f"key {copied} here", "en", f"owner{i}") for i in range(10)] + [(20, f"my {live} é", "en", "me"), (21, "x " + "a" * 40, "en", "me")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in check_scan(df)}
    assert got[20].spans == "opaque:3:35" and got[20].n_live == 1
    assert all(got[i].spans == "" and got[i].n_copied == 1 for i in range(10))
    assert got[21].spans.startswith("hex:")
    clean = {r.doc_id: r.text for r in secret_scan.redact(df, owner=F.col("source"), repository=F.col("lang")).collect()}
    assert clean[20] == "my [secret] é" and clean[0] == rows[0][1] and clean[21] == "x [secret]"


@pytest.mark.parametrize("table", TABLES)
def test_redaction_leaves_other_rows_alone(request, table):
    df = request.getfixturevalue(table)
    out = secret_scan.redact(df, owner=F.col("source"))
    assert out.dtypes == df.dtypes
    clean = [tuple(r) for r in df.select("doc_id", "text").collect() if not base_spans(r.text)]
    got = [tuple(r) for r in out.select("doc_id", "text").collect()]
    assert len(got) == df.count() and all(got.count(r) >= clean.count(r) for r in clean)
    assert not any(t and "hunter2" in t for _, t in got)


def pem_forms(body, name="RSA PRIVATE KEY"):
    """A key as it lies in a file, in JSON, indented in YAML, with headers and cut off."""
    lines = [body[k:k + 64] for k in range(0, len(body), 64)]
    begin, end = f"-----BEGIN {name}-----", f"-----END {name}-----"
    whole = [begin, *lines, end]
    heads = ["Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,0123ABCD", ""]
    return ["\n".join(whole), "\\n".join(whole), "\n    ".join(whole), "\r\n".join([begin, *heads, *lines, end]),
            "\\n".join([begin, *heads, *lines, end]), "\n".join(f"-{x}" for x in whole)[1:], "\n  ".join(whole[:-1])]


def test_private_keys_are_whole_spans_known_by_their_bodies(spark):
    r = random.Random(4)
    key = lambda: "MII" + "".join(r.choices("ABCDEFGHabcdefgh0123456789+/", k=1 + 64 * 5)) + "=="
    copied = key()
    rows, want = [], {}
    for i in range(42):  # each of its own source: a live key in every form, and one example that all hold
        live, example = pem_forms(key())[i % 7], pem_forms(copied)[i % 7]
        text = f"é key: {live}" + (" . and " if i % 7 == 6 else "\" and ") + example + "\n... done"
        rows.append((i, text, "en", f"source{i}"))
        want[i] = "é key: [secret]" + text[7 + len(live):]
    rows += [(100 + i, "first line -----BEGIN PRIVATE KEY----- of it", "en", f"source{i}") for i in range(20)]
    want.update({100 + i: "first line [secret] of it" for i in range(20)})
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    clean = {r.doc_id: r.text for r in secret_scan.redact(df, owner=F.col("source"), repository=F.col("lang")).collect()}
    for i, text in want.items():
        assert clean[i] == text, i
    for x in secret_scan.scan(df, owner=F.col("source"), repository=F.col("lang")).collect():
        assert "pem:" in x.spans and x.n_live >= 1, x.doc_id


def test_a_long_text_after_a_begin_line_is_no_key(spark):
    tail = "a - b\n" * 200000
    df = spark.createDataFrame([(1, "-----BEGIN PRIVATE KEY-----  " + tail, "s")], "doc_id long, text string, source string")
    (row,) = secret_scan.redact(df, owner=F.col("source")).collect()
    assert row.text == "[secret]  " + tail


def test_logins_of_any_length(spark):
    token = "é.b~" * 23
    rows = [(1, f"at https://{'u' * 80}:{token}@host/x and", "a"), (2, f"git://me:{token[:90]}@host", "b"), (3, "http://u:short@h http://u:sixsix@h", "c")]
    got = {r.doc_id: r.spans for r in secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string, source string"), owner=F.col("source")).collect()}
    assert got == {1: "login:8:185", 2: "login:3:100", 3: "login:21:33"}


def test_a_text_with_many_secrets(spark):
    """Work grows with the matches, and places and marks hold over all chunks of a scan."""
    for n in (1, 63, 64, 65, 129, 20_000):
        text = "é" + " ".join(f"password = hunter{k:08d} ok" for k in range(n)) + " end"
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        row = secret_scan.scan(df).first()
        want = [m.span() for m in re.finditer(r"password = hunter[0-9]{8}", text)]
        assert row.n_assign == n and row.spans == ",".join(f"assign:{a}:{b}" for a, b in want)
        assert secret_scan.redact(df).first().text == re.sub(r"password = hunter[0-9]{8}", "[secret]", text)
