"""Property checks against brute-force Python equivalents of the reference rules."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedloom.functions.text import join_text, normalise_ws
from feedloom.operators.clean import clean_interactions
from feedloom.operators.index import fit_index

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))

spaces = st.sampled_from([" ", "\t", "\n", " ", "　", "\u0085", " ", "\u001c", " ", "\x0b"])
text = st.lists(st.one_of(spaces, st.sampled_from(["a", "b", "é", "字", "-", "0"])), max_size=12).map("".join)


@SETTINGS
@given(st.lists(text, min_size=1, max_size=20))
def test_normalise_matches_python_split(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = [r.n for r in df.select("i", normalise_ws(F.col("s")).alias("n")).orderBy("i").collect()]
    assert got == [" ".join(v.split()) for v in values]


@SETTINGS
@given(st.lists(st.lists(st.one_of(st.none(), text), max_size=5), min_size=1, max_size=10))
def test_join_text_on_string_lists_matches_reference_rule(spark, lists):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lists)], "i int, arr array<string>")
    got = [r.t for r in df.select("i", join_text(df, "arr").alias("t")).orderBy("i").collect()]
    assert got == [" ".join(" ".join(str(p) for p in v if p).split()) for v in lists]


rows = st.lists(st.tuples(st.sampled_from(["u1", "u2", "u3"]), st.sampled_from(["a", "b", "c"]),
                          st.integers(1, 5), st.integers(0, 4)), min_size=1, max_size=40)


@SETTINGS
@given(rows, st.sampled_from([1, 3, 7]))
def test_clean_matches_pandas_keep_first_and_stable_sort(spark, data, parts):
    records = [(i, u, it, float(r), ts) for i, (u, it, r, ts) in enumerate(data)]
    df = spark.createDataFrame(records, "ordinal long, user_id string, parent_asin string, rating double, "
                                        "timestamp long").repartition(parts)
    got = [(r.user_id, r.item_id, r.rating, r.timestamp_ms) for r in clean_interactions(df).collect()]
    p = pd.DataFrame(records, columns=["o", "user_id", "item_id", "rating", "timestamp_ms"])
    p = p.drop_duplicates(subset=["user_id", "item_id", "timestamp_ms"], keep="first")
    p = p.sort_values(["user_id", "timestamp_ms"], kind="stable")
    assert got == list(zip(p.user_id, p.item_id, p.rating, p.timestamp_ms))


@SETTINGS
@given(st.lists(st.sampled_from([f"id{i}" for i in range(30)]), min_size=1, max_size=60), st.sampled_from([1, 2, 5]))
def test_fit_index_matches_first_seen_dict(spark, values, parts):
    df = spark.createDataFrame(list(enumerate(values)), "ordinal long, v string").repartition(parts)
    expected = {}
    for v in values:
        expected.setdefault(v, len(expected))
    got = {r.value: r.idx for r in fit_index(df, "v", ["ordinal"], partitions=parts).collect()}
    assert got == expected
