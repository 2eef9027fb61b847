import sys

from pyspark.sql import functions as F

from feedloom.functions.text import join_text, normalise_ws
from feedloom.sources.jsonl import metadata_records, read_records


def test_whitespace_class_matches_python_split(spark):
    samples = ["a b", "　x　", "a\u0085b", "a b ", "a\u001cb\u001f",
               "\t tab\r\n", "no-break thin", "᠎", "x​y", "  "]
    got = spark.createDataFrame([(s,) for s in samples], "s string").select(normalise_ws(F.col("s")).alias("n"))
    assert [r.n for r in got.collect()] == [" ".join(s.split()) for s in samples]


def test_every_python_space_char_collapses(spark):
    chars = "".join(chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace())
    s = "a" + chars + "b"
    assert spark.range(1).select(normalise_ws(F.lit(s)).alias("n")).first().n == "a b"


def test_join_text_on_json_shapes(spark, write_jsonl_gz):
    path = write_jsonl_gz("m.jsonl.gz", [
        {"parent_asin": "1", "title": " a  b "},
        {"parent_asin": "2", "title": ["x", "", None, 0, "0", " y "]},
        {"parent_asin": "3", "title": {"k": "v"}},
        {"parent_asin": "4"},
        {"parent_asin": "5", "title": None},
        {"parent_asin": "6", "title": 17},
        {"parent_asin": "7", "title": [[], {}, [1], False, True, 2.5]},
    ])
    meta = metadata_records(read_records(spark, path))
    got = {r.parent_asin: r.t for r in meta.select("parent_asin", join_text(meta, "title").alias("t")).collect()}
    assert got == {"1": "a b", "2": "x 0 y", "3": "", "4": "", "5": "", "6": "", "7": "[1] true 2.5"}


def test_join_text_on_typed_columns(spark):
    df = spark.createDataFrame([(["a", "", None, " b "], None), ([], "　s t ")],
                               "arr array<string>, s string")
    got = df.select(join_text(df, "arr").alias("a"), join_text(df, "s").alias("b"), join_text(df, "nope").alias("c"))
    assert [tuple(r) for r in got.collect()] == [("a b", "", ""), ("", "s t", "")]
