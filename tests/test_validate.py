import pytest
from pyspark.sql import functions as F

from feedloom.operators.validate import (ValidationError, gate, referential_orphans, validation_findings,
                                         validation_report)


def _interactions(spark, rows):
    df = spark.createDataFrame(rows, "user_id string, item_id string, rating float, timestamp_ms long")
    return df.withColumn("event_time", F.timestamp_millis("timestamp_ms"))


def _items(spark, rows):
    return spark.createDataFrame(rows, "item_id string, item_text string")


def test_clean_tables_have_an_empty_report(spark):
    f = validation_findings(_interactions(spark, [("kim", "mug", 1.0, 7), ("kim", "mug", 1.0, 8), ("lee", "jar", 4.5, 7)]),
                            _items(spark, [("jar", "a jar"), ("mug", "."), ("tin", "unreviewed")]))
    assert f.collect() == [] and validation_report(f).first().asDict() == {"is_valid": True, "errors": 0, "warnings": 0}


def test_warnings_alone_leave_tables_valid_and_errors_do_not(spark):
    good = _interactions(spark, [("kim", "mug", 5.0, 7)])
    warned = validation_findings(good, _items(spark, [("mug", " \n"), ("jar", "")]))
    assert [(r.check, r.severity, r.affected_rows) for r in warned.collect()] == [("missing_item_text", "warning", 2)]
    assert validation_report(warned).first().asDict() == {"is_valid": True, "errors": 0, "warnings": 1}
    bad = validation_findings(_interactions(spark, [("kim", "cup", 0.5, 7), ("lee", "cup", 5.5, 7)]), _items(spark, [("mug", "m")]))
    assert {r.check: r.affected_rows for r in bad.collect()} == {"rating_range": 2, "interaction_item_join": 2}
    assert not validation_report(bad).first().is_valid


def test_every_rule_and_null_semantics(spark):
    inter = _interactions(spark, [
        ("u", "a", float("nan"), 1), ("u", "a", 3.0, 1), (None, "a", None, 0), ("v", None, 2.0, -5)])
    items = _items(spark, [("a", " 　 "), ("a", "x"), (None, None), (None, "y")])
    got = [(r.dataset, r.check, r.affected_rows) for r in validation_findings(inter, items).collect()]
    assert got == [
        ("interactions", "null_required_values", 3),
        ("interactions", "rating_range", 2),
        ("interactions", "timestamp_range", 2),
        ("interactions", "duplicate_events", 1),
        ("items", "null_item_ids", 2),
        ("items", "duplicate_item_ids", 2),
        ("items", "missing_item_text", 2),
    ]


def test_missing_columns_short_circuit_but_cross_check_runs(spark):
    inter = spark.createDataFrame([("x",)], "item_id string")
    items = _items(spark, [("y", "t")])
    got = [(r.check, r.message, r.affected_rows) for r in validation_findings(inter, items).collect()]
    assert got[0] == ("required_columns",
                      "Missing required columns: event_time, rating, timestamp_ms, user_id.", 0)
    assert ("interaction_item_join", "Every interaction item must exist in the item dataset.", 1) in got


def test_referential_orphans_null_matches_null(spark):
    inter = _interactions(spark, [("u", None, 4.0, 1), ("u", "b", 4.0, 2), ("u", "c", 4.0, 3)])
    items = _items(spark, [(None, "t"), ("b", "t")])
    assert [r.item_id for r in referential_orphans(inter, items).collect()] == ["c"]


def test_gate_raises_after_writing(spark, tmp_path):
    inter = _interactions(spark, [("u", "a", 9.0, 1)])
    f = validation_findings(inter, _items(spark, [("a", "t")]))
    with pytest.raises(ValidationError):
        gate(f, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report" / "issues")).count() == 1
